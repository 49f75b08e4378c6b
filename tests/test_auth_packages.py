"""Authentication and package logs."""

from pyspark.sql import functions as F

import oslogs
from oslogs import sinks
from oslogs.operators import auth, bars, filters, packages, parse
from oslogs.sources.tables import read_counts
from oslogs.sources.text import log_lines

T = "2024-11-09T10:00:0"
FAIL = "+00:00 h sshd[1]: pam: authentication failure; logname= ruser=eve user=root"
SUDO = "+00:00 h sudo[1]: ann : PWD=/home/ann ; USER=root ; COMMAND=/bin/ls -l]"


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def _log(log):
    return log(
        f"{T}0.1{FAIL}",
        f"{T}1.1+00:00 h su[1]: authentication failure; logname=ann ruser=ann",
        f"{T}2.1{SUDO}",
        f"{T}3.1+00:00 h sudo[1]: USER=ann] ; PWD=/srv ; COMMAND=/usr/bin/apt]]",
        f"{T}4.1+00:00 h cron[1]: session opened for user root",
        f"{T}5.1+00:00 h cron: session opened for user ann",
        f"{T}6.1+00:00 h sshd[1]: session closed",
        f"{T}7.1+00:00 h sshd[1]: session opened COMMAND=x",
        "2024-11-10T10:00:00.1+00:00 h sshd[1]: session closed",
    )


def test_auth_report(spark, log):
    rows = oslogs.analyze(spark, "auth", "2024-11-09", path=_log(log))
    tables = oslogs.report(rows, "auth")
    assert got(tables["auth_failures"], "log_time", "logname", "user") == [
        ("10:00:00", "N/A", "root"), ("10:00:01", "ann", ""),
    ]
    assert got(tables["sudo_commands"], "log_time", "sudo_user", "pwd", "command") == [
        ("10:00:02", "root", "/home/ann", "/bin/ls"), ("10:00:03", "ann", "/srv", "/usr/bin/apt"),
        ("10:00:07", "", "", "x"),
    ]
    assert got(tables["sessions_by_app"]) == [("cron", 2)]
    assert got(tables["other_events_by_app"]) == [("sshd", 1)]
    assert got(tables["auth_summary"]) == [(2, 3, 2, 1, 8)]
    assert [tuple(r) for r in tables["auth_bars"].collect()] == [
        ("auth_failures", 2, 33), ("sudo_commands", 3, 50), ("sessions", 2, 33), ("other_events", 1, 16),
    ]
    assert tables["auth_summary"].collect() == auth.auth_summary(rows).collect()


def test_older_auth_variant(spark, log):
    rows = oslogs.analyze(spark, "auth_t", "2024-11-09", path=_log(log))
    tables = oslogs.report(rows, "auth_t")
    assert got(tables["auth_failures"], "logname", "user") == [("", "root"), ("ann", "")]
    assert ("ann]", "/srv", "/usr/bin/apt]]") in got(tables["sudo_commands"], "sudo_user", "pwd", "command")
    # the line without "]: " has no message here
    assert got(tables["sessions_by_app"]) == [("cron", 1)]


def test_bsd_auth_lines_have_their_time(spark, log):
    path = log("Nov  9 10:00:00 h sshd[1]: authentication failure; logname= user=root")
    rows = oslogs.analyze(spark, "auth", "2024-11-09", path=path)
    assert got(auth.auth_failures(rows), "log_time", "logname", "user") == [("10:00:00", "N/A", "root")]


def test_unnamed_apps(spark):
    rows = spark.createDataFrame([("other", ""), ("other", "a"), ("session", "")], "event STRING, app_name STRING")
    assert got(auth.other_events_by_app(rows)) == [("a", 1)]
    assert got(auth.other_events_by_app(rows, keep_unnamed=True)) == [("", 1), ("a", 1)]
    assert got(auth.auth_summary(rows)) == [(0, 0, 0, 1, 1)]


def test_small_bars_are_lifted(spark):
    rows = spark.createDataFrame([("other", "a", 1000), ("session", "a", 1)], "event STRING, app_name STRING, n LONG")
    lengths = {r.category: r.bar_len for r in bars.auth_bars(auth.auth_summary(rows)).collect()}
    assert lengths == {"auth_failures": 0, "sudo_commands": 0, "sessions": 1, "other_events": 50}


def test_last_action_wins(spark, log):
    path = log(
        "2024-10-04 10:00:00 install a:amd64 <none> 1.0",
        "2024-10-04 10:00:00 status installed a:amd64 1.0",
        "2024-10-04 10:00:00 configure a:amd64 1.0 <none>",
        "2024-10-04 10:00:01 remove a:amd64 1.0 <none>",
        "2024-10-04 10:00:01 unpack b:amd64 1.0 <none>",
        "2024-10-05 10:00:01 upgrade b:amd64 1.0 <none>",
        "startup archives unpack",
    )
    rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=path)
    tables = oslogs.report(rows, "dpkg")
    assert got(tables["package_report"], F.col("log_date").cast("string"), "log_time", "package", "action") == [
        ("2024-10-04", "10:00:00", "a:amd64", "configure"),
        ("2024-10-04", "10:00:01", "a:amd64", "remove"),
        ("2024-10-04", "10:00:01", "b:amd64", "unpack"),
    ]
    assert [tuple(r) for r in tables["package_actions"].collect()] == [
        ("install", 0), ("upgrade", 0), ("remove", 1), ("configure", 1), ("unpack", 1),
    ]
    assert got(tables["package_bars"]) == [("configure", 1, 50), ("remove", 1, 50), ("unpack", 1, 50)]
    assert got(packages.package_action_totals(packages.latest_package_action(rows))) == [(1, 3)]
    version = got(parse.parse_dpkg(log_lines(spark, path)).where("action = 'install'"), "version")
    assert version == [("<none>",)]


def test_last_action_over_many_splits(spark, tmp_path):
    """File order holds although the file is read in several pieces."""
    lines = [f"2024-10-04 10:00:00 {('install', 'remove', 'configure')[i % 3]} p{i % 5}:amd64 1 2" for i in range(20000)]
    (tmp_path / "dpkg.log").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = parse.parse_dpkg(log_lines(spark, str(tmp_path / "dpkg.log")))
        assert rows.rdd.getNumPartitions() > 5
        last = {f"p{i % 5}:amd64": ("install", "remove", "configure")[i % 3] for i in range(20000)}
        assert dict(got(packages.latest_package_action(rows), "package", "action")) == last
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bsd_package_lines(spark, log):
    path = log("Oct  4 10:00:00 install a:amd64 1.0", "Oct 14 10:00:00 install a:amd64 1.0")
    rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=path)
    assert got(rows, "log_time", "action", "package", "version") == [("10:00:00", "install", "a:amd64", "1.0")]


def test_supplied_sequence(spark):
    rows = spark.createDataFrame(
        [(3, "remove"), (1, "install"), (2, "configure")], "seq LONG, action STRING"
    ).selectExpr("*", "date'2024-10-04' as log_date", "'10:00:00' as log_time", "'a' as package")
    assert got(packages.latest_package_action(rows, "seq"), "action") == [("remove",)]


def test_nothing_recorded(spark, log):
    rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=log("2024-10-04 10:00:00 status x a:amd64 1"))
    latest = packages.latest_package_action(rows)
    filled = packages.package_actions_filled(latest)
    assert [r.n for r in filled.collect()] == [0] * 5
    assert packages.nonzero_guard(filled, label="action", n="n").count() == 0
    assert bars.package_bars(latest).count() == 0
    assert got(packages.package_action_totals(latest)) == [(1, 0)]


def test_guard_may_ignore_a_label(spark):
    counts = spark.createDataFrame([("install", 3), ("remove", 0)], "category STRING, count LONG")
    assert packages.nonzero_guard(counts).count() == 2
    assert packages.nonzero_guard(counts, ignore=("install",)).count() == 0


def test_exported_counts(spark, log, tmp_path):
    rows = oslogs.analyze(spark, "auth", "2024-11-09", path=_log(log))
    sinks.write_auth_events(rows, str(tmp_path / "auth"))
    assert got(read_counts(spark, str(tmp_path / "auth"), header=True)) == [
        ("Authentication Failures", 2), ("Other Events", 1), ("Session Openings", 2), ("Sudo Privileges", 3),
    ]
    dpkg = oslogs.analyze(spark, "dpkg", "2024-10-04", path=log("2024-10-04 10:00:00 install a 1", name="d"))
    sinks.write_dpkg_actions(packages.latest_package_action(dpkg), str(tmp_path / "dpkg"))
    files = list((tmp_path / "dpkg").glob("part-*"))
    assert [f.read_text() for f in files if f.stat().st_size] == ["install\t1\nupgrade\t0\nremove\t0\nconfigure\t0\nunpack\t0\n"]
    mem = oslogs.analyze(spark, "mem", "2024-11-09", path=log(f"{T}0.1+00:00 h a[1]: critical", name="m"))
    sinks.write_error_counts(mem, str(tmp_path / "mem"))
    files = [f for f in (tmp_path / "mem").glob("part-*") if f.stat().st_size]
    assert [f.read_text() for f in files] == [
        "Category\tCount\nSevere Errors\t1\nMild Errors\t0\nWarnings\t0\nSuccesses\t-1\n"
    ]


def test_package_filter(spark):
    rows = spark.createDataFrame([("install",), ("status",), ("",)], "action STRING")
    assert got(filters.package_actions_only(rows)) == [("install",)]
