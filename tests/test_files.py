"""Facts of files and their order: equal times, layouts, early stops, compressed logs."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs.operators import filters, lookup, packages, parse
from oslogs.sources.host import sar_series
from oslogs.sources.text import log_lines
from oslogs.sources.windows import windows_system

PAGING = "12:00:01 pgpgin/s pgpgout/s fault/s majflt/s pgfree/s pgscank/s pgscand/s pgsteal/s %vmeff"
TURNED = "12:00:01 pgpgout/s pgpgin/s"
SYSTEM = "Level\tDate and Time\tSource\tEvent ID\tTask Category"
SHIFTED = "Event ID\tLevel\tDate and Time\tSource\tTask Category"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.collect()
    return physical(df).split("Initial Plan")[0]


@pytest.mark.parametrize("newest_last", [True, False])
def test_equal_times_resolve_by_name(spark, tmp_path, newest_last):
    """Thirty pairs of files of one time: whatever their names hash to, the second one's action stands."""
    expected = {}
    for i in range(30):
        for part, action in (("1", "install"), ("2", "remove")):
            name = tmp_path / f"log{i:02d}-part-{part}.log"
            name.write_text(f"2024-10-04 10:00:00 configure p{i}:amd64 1 2\n2024-10-04 10:00:00 {action} p{i}:amd64 1 2\n")
            os.utime(name, (1_700_000_000, 1_700_000_000))
        expected[f"p{i}:amd64"] = "remove"
    rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=str(tmp_path), newest_last=newest_last)
    assert {r.package: r.action for r in packages.latest_package_action(rows).collect()} == expected


def test_last_action_over_many_blocks(spark, tmp_path):
    """A file that many tasks read: a later block wins, whatever the positions in it."""
    lines = [f"2024-10-04 10:00:00 {('install', 'upgrade', 'remove')[i % 3]} p{i % 50}:amd64 1 {i:06d}" for i in range(20_000)]
    (tmp_path / "dpkg.log").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        rows = oslogs.analyze(spark, "dpkg", "2024-10-04", path=str(tmp_path))
        assert rows.select("line_no.block").distinct().count() > 10
        assert {r.package: r.action for r in packages.latest_package_action(rows).collect()} == {line.split()[3]: line.split()[2] for line in lines}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def series(spark, path, kind="paging"):
    return sar_series(spark, str(path), kind, date="2024-11-09")


def test_one_layout_needs_no_lookup(spark, log, tmp_path):
    log(PAGING, "12:10:01 1 2 3 4 5 6 7 8 9", name="s/a")
    log("12:20:01 1 2 3 4 5 6 7 8 9", name="s/b")  # a file without a header has the usual columns
    rows = series(spark, tmp_path / "s")
    assert "Join" not in physical(rows) and sorted(r.pgpgout for r in rows.collect()) == [2.0, 2.0]
    log(TURNED, "12:10:01 1 2", name="t/a")
    assert "Join" not in physical(series(spark, tmp_path / "t"))


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_two_layouts(spark, log, tmp_path, monkeypatch, bound):
    """A broadcast dictionary, or beyond the measured bound a join by file and part of the file: the same rows."""
    monkeypatch.setattr(lookup, "LOOKUP_BYTES", bound)
    monkeypatch.setattr(lookup, "PART_BYTES", 500)
    log(PAGING, "12:10:01 1 2 3 4 5 6 7 8 9", name="s/a")
    log(TURNED, *(f"12:{i:02d}:02 1 2" for i in range(10, 60)), name="s/b")
    log("12:10:03 1 2 3 4 5 6 7 8 9", name="s/c")
    rows = series(spark, tmp_path / "s")
    got = sorted((str(r.ts)[-8:], r.pgpgin, r.fault) for r in rows.collect())
    assert got[:3] == [("12:10:01", 1.0, 3.0), ("12:10:02", 2.0, None), ("12:10:03", 1.0, 3.0)] and len(got) == 52
    assert ("BroadcastHashJoin" in final(rows)) or bound == 0
    log(SYSTEM, "Error\t09-11-2024 10:00:00\tdisk\t7\tNone\tI/O error", name="w/a")
    log(SHIFTED, *(f"{i}\tError\t09-11-2024 10:00:00\tdisk\tNone\tI/O error {i}" for i in range(60)), name="w/b")
    events = windows_system(spark, str(tmp_path / "w"))
    assert sorted(int(r.event_id) for r in events.collect()) == sorted([7, *range(60)])
    assert {r.level for r in events.collect()} == {"Error"}
    log("Error\t09-11-2024 10:00:00\tdisk\t7\tNone\tI/O error", name="w/c")
    with pytest.raises(Exception, match="no header row in .*/w/c"):
        windows_system(spark, str(tmp_path / "w")).collect()


def test_one_large_file_among_two_layouts_is_read_by_many_tasks(spark, log, tmp_path):
    log(SHIFTED, *(f"{i}\tError\t09-11-2024 10:00:00\tdisk\tNone\tI/O error {i}" for i in range(20_000)), name="w/b")
    log(SYSTEM, "Error\t09-11-2024 10:00:00\tdisk\t7\tNone\tI/O error", name="w/a")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = windows_system(spark, str(tmp_path / "w"))
        assert rows.count() == 20_001 and rows.select(F.spark_partition_id()).distinct().count() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_stop_of_each_file(spark, log, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(lookup, "LOOKUP_BYTES", bound)
    monkeypatch.setattr(lookup, "PART_BYTES", 100)
    line = "2024-11-{:02d}T10:00:00.1 h a[1]: {}".format
    log(line(8, "one"), line(9, "two"), line(10, "late"), line(9, "after"), name="p/a")
    log(line(9, "three"), line(9, "four"), name="p/b")
    log(line(10, "late"), line(9, "after"), name="p/c")
    rows = parse.parse_iso_syslog(log_lines(spark, str(tmp_path / "p")))
    kept = filters.prefix_stop(rows, filters.late_for("2024-11-09", "23:59:59"), per_file=True)
    assert sorted(r.message for r in kept.collect()) == ["four", "one", "three", "two"] and kept.columns == rows.columns
    if bound:
        text = final(kept)
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text  # no line of the log is moved


def test_a_compressed_log_is_parsed_by_many_tasks(spark, tmp_path):
    """One task reads it, many parse it, and the order of its lines is kept; plain files are not shuffled."""
    actions = ("install", "upgrade", "remove")
    lines = [f"2024-10-04 10:00:00 {actions[i % 3]} p{i % 40}:amd64 1 {i}" for i in range(5000)]
    with gzip.open(tmp_path / "dpkg.log.1.gz", "wt") as file:
        file.write("\n".join(lines) + "\n")
    read = log_lines(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # Spark would join so few lines again
    try:
        assert read.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert log_lines(spark, str(tmp_path), spread=False).select(F.spark_partition_id()).distinct().count() == 1
    in_order = [r.value for r in sorted(read.collect(), key=lambda r: r.line_no)]
    assert in_order == lines
    latest = lambda: {r.package: r.action for r in packages.latest_package_action(parse.parse_dpkg(log_lines(spark, str(tmp_path)))).collect()}
    wanted = {line.split()[3]: line.split()[2] for line in lines}
    assert latest() == wanted
    (tmp_path / "dpkg.log.2").write_text("2024-10-04 10:00:00 configure p1:amd64 1 2\n")
    assert latest() == wanted | {"p1:amd64": "configure"}
    os.remove(tmp_path / "dpkg.log.1.gz")
    assert "Exchange" not in physical(log_lines(spark, str(tmp_path)))
