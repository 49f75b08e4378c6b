"""Hot keys, hot days and rotated files: results stay whole and work stays split."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs import sinks
from oslogs.operators import errors, filters, packages, parse, severity
from oslogs.sources.tables import parsed_rows
from oslogs.sources.text import log_lines

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A syslog in which one application and one day hold a third of all lines or more."""
    path = str(tmp_path_factory.mktemp("hot") / "log")
    app = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("app"), (F.col("id") % 5000).cast("string")))
    day = F.when(F.col("id") % 2 == 0, "2024-01-15").otherwise(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).cast("string"))
    text = F.element_at(F.array(*map(F.lit, ("error", "critical", "warning", "ok", "malloc"))), (F.col("id") % 5 + 1).cast("int"))
    spark.range(ROWS).select(F.format_string("%sT10:00:%02d.5 h %s[1]: %s", day, F.col("id") % 60, app, text)).write.text(path)
    return path


def test_hot_application(spark, hot):
    rows = severity.classified(filters.nonempty_message(parse.parse_syslog(log_lines(spark, hot))), "mem")
    expected: dict[tuple, int] = {}
    kinds = {0: "mild_error", 1: "severe_error", 2: "warning"}
    for i in range(ROWS):
        if i % 5 in kinds:
            key = kinds[i % 5], "hot" if i % 3 == 0 else f"app{i % 5000}"
            expected[key] = expected.get(key, 0) + 1
    assert {(r.category, r.app_name): r.n for r in severity.severity_by_app(rows).collect()} == expected
    malloc = {r.app_name: r.n for r in errors.error_table(rows, "mem").where("error = 'malloc'").collect()}
    assert sum(malloc.values()) == ROWS // 5 and malloc["hot"] == ROWS // 15


def test_hot_day_is_written_in_pieces(spark, hot, tmp_path):
    """Rebalancing splits the hot day over files and gives each small day one file."""
    path = str(tmp_path / "landed")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        sinks.write_parsed(parse.parse_syslog(log_lines(spark, hot)), path, "hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    days = Path(path, "kind=mem").iterdir()
    files = {d.name: len(list(d.glob("batch=*/*.parquet"))) for d in days if d.is_dir()}
    assert files.pop("log_date=2024-01-15") > 1
    assert sum(n == 1 for n in files.values()) >= 0.8 * len(files)  # the others share the hot day's shuffle partition
    assert parsed_rows(spark, path).count() == ROWS


def test_hot_package_key(spark, tmp_path):
    """One key has a third of the lines; the last action of every key is kept."""
    actions = ("install", "remove", "configure", "status")
    lines = [f"2024-10-04 10:00:00 {actions[i % 4]} {'hot' if i % 3 == 0 else f'p{i % 997}'} 1 2" for i in range(30_000)]
    (tmp_path / "dpkg.log").write_text("\n".join(lines) + "\n")
    expected = {}
    for line in lines:
        _, _, action, package, *_ = line.split()
        if action != "status":
            expected[package] = action
    rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=str(tmp_path / "dpkg.log"))
    assert {r.package: r.action for r in packages.latest_package_action(rows).collect()} == expected


def test_rotated_files(spark, tmp_path):
    """By name the older ``dpkg.log.1`` comes last; by time of change it comes first."""
    for name, action, changed in (("dpkg.log", "configure", 2_000_000_000), ("dpkg.log.1", "install", 1_000_000_000)):
        (tmp_path / name).write_text(f"2024-10-04 10:00:00 {action} a:amd64 1 2\n")
        os.utime(tmp_path / name, (changed, changed))
    last = lambda newest_last: [r.action for r in packages.latest_package_action(oslogs.analyze(
        spark, "dpkg", "2024-10-04", path=str(tmp_path), newest_last=newest_last)).collect()]
    assert last(False) == ["install"] and last(True) == ["configure"]


def test_compressed_logs(spark, tmp_path):
    import gzip
    with gzip.open(tmp_path / "syslog.2.gz", "wt") as file:
        file.write("2024-11-09T10:00:00.1 h a[1]: fail\n")
    (tmp_path / "syslog").write_text("2024-11-09T10:00:00.1 h a[1]: fail\n")
    rows = oslogs.analyze(spark, "mem", "2024-11-09", path=str(tmp_path))
    assert [tuple(r) for r in severity.severity_by_app(rows).collect()] == [("mild_error", "a", 2)]


def test_landing_adds_to_the_table(spark, log, tmp_path):
    """Files, hosts and families of a day stand side by side; the same file again replaces its own rows."""
    path = str(tmp_path / "table")
    first, second = log("2024-11-09T10:00:00.1 h1 a[1]: one", name="x/1"), log("2024-11-09T11:00:00.1 h2 a[1]: two", name="x/2")
    sign_in = log("2024-11-09T12:00:00.1 h1 sshd[1]: session opened for user ann", name="x/auth")
    for kind, source in (("mem", first), ("mem", second), ("auth", sign_in), ("mem", first)):
        sinks.write_parsed(oslogs.parsed(spark, kind, source), path)
    assert sorted(r.log_time for r in oslogs.analyze(spark, "mem", "2024-11-09", path=path, landed=True).collect()) == ["10:00:00", "11:00:00"]
    assert [r.log_time for r in oslogs.analyze(spark, "auth", "2024-11-09", path=path, landed=True).collect()] == ["12:00:00"]
    for text, batch in (("three", "7"), ("four", "7"), ("five", "8")):
        source = log(f"2024-11-10T10:00:00.1 h1 a[1]: {text}", name=f"x/{text}")
        sinks.write_parsed(oslogs.parsed(spark, "mem", source), path, batch)
    assert sorted(r.message for r in oslogs.analyze(spark, "mem", "2024-11-10", path=path, landed=True).collect()) == ["five", "four"]
    yearless = log("Nov  9 10:00:00 h1 a[1]: one", name="x/old")
    with pytest.raises(Exception, match="without a year"):
        sinks.write_parsed(oslogs.parsed(spark, "mem", yearless), path)
    sinks.write_parsed(oslogs.parsed(spark, "mem", yearless, year=2023), path)
    assert oslogs.analyze(spark, "mem", "2023-11-09", path=path, landed=True).count() == 1


def test_log_passes_hash_aggregates_only(spark, tmp_path):
    """What is sorted is one row per key and block, never the log."""
    (tmp_path / "dpkg.log").write_text("2024-10-04 10:00:00 install a:amd64 1 2\n")
    rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=str(tmp_path))
    plan = packages.latest_package_action(rows)._jdf.queryExecution().sparkPlan().toString().splitlines()
    steps = [line.strip(" +-:").split("(")[0].split(" ")[0] for line in plan]
    assert steps.count("HashAggregate") >= 2
    first_hash = max(i for i, step in enumerate(steps) if step == "HashAggregate")
    assert all(i < first_hash for i, step in enumerate(steps) if "Sort" in step)  # the plan is printed from its end
