"""Host readings, exported series, processes, generated lines, bars."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs import sinks
from oslogs.functions.dates import check_recent
from oslogs.operators import bars, filters, host
from oslogs.sources import synthetic
from oslogs.sources.host import SAR_COLUMNS, host_snapshots, metric_name, sar_header, sar_series
from oslogs.sources.text import default_path, log_lines


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def readings(spark, *rows):
    return spark.createDataFrame(
        [("h", dt.datetime(2024, 10, 4, 10, i), *row) for i, row in enumerate(rows)],
        "host STRING, ts TIMESTAMP_NTZ, mem_used_mb INT, mem_total_mb INT, disk_pct STRING, swap_used_mb INT, swap_total_mb INT",
    )


def test_thresholds(spark):
    rows = readings(
        spark, (76, 100, "81%", 76, 100), (75, 100, "80%", 75, 100), (7501, 10000, "", 5, 0),
        (50, 100, "-", 0, 100), (5001, 10000, "0%", 2, 3), (1, 3, " 7%", 99, 100),
    )
    D = decimal.Decimal
    in_order = lambda df: [(r.pct, r.status) for r in df.orderBy("ts").collect()]
    assert in_order(host.memory_status(rows)) == [
        (D("76.00"), "High"), (D("75.00"), "Moderate"), (D("75.01"), "High"), (D("50.00"), "Normal"),
        (D("50.01"), "Moderate"), (D("33.33"), "Normal"),
    ]
    assert in_order(host.disk_status(rows)) == [
        (D("81.00"), "High"), (D("80.00"), "Normal"), (None, "Unavailable"), (None, "Unavailable"), (D("0.00"), "Normal"),
        (D("7.00"), "Normal"),
    ]
    assert in_order(host.swap_status(rows)) == [
        (D("76.00"), "High"), (D("75.00"), "Normal"), (D("0.00"), "Normal"), (D("0.00"), "Normal"),
        (D("66.66"), "Normal"), (D("99.00"), "High"),
    ]
    assert host.host_status(rows).count() == 18
    assert got(host.used_free_split(rows.limit(1)), "metric", "part", "value") == [
        ("disk", "Free", 19), ("disk", "Used", 81), ("memory", "Free", 24), ("memory", "Used", 76),
    ]


def test_exported_series(spark, tmp_path):
    day = tmp_path / "host=h1" / "log_date=2024-10-04"
    day.mkdir(parents=True)
    (day / "paging").write_text(
        "Linux 5.15.0 (h1) \t10/04/2024 \t_x86_64_\t(4 CPU)\n\n"
        "00:00:01     pgpgin/s pgpgout/s   fault/s\n"
        "00:10:01        10.00     20.50     30.00\n"
        "00:20:01        30.00      0.00     30.00\n"
        "12:40:01 PM      1.00      2.00      3.00\n"
        "12:50:01 AM      5.00      6.00      7.00\n"
        "13:00:00     LINUX RESTART\t(4 CPU)\n"
        "Average:        20.00     10.25     30.00\n"
    )
    path = str(tmp_path)
    assert sar_header(spark, path, "paging") == ("pgpgin/s", "pgpgout/s", "fault/s")
    series = sar_series(spark, path, "paging", sar_header(spark, path, "paging"))
    assert got(series, "host", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "pgpgin", "pgpgout", "fault") == [
        ("h1", "2024-10-04 00:10:01", 10.0, 20.5, 30.0), ("h1", "2024-10-04 00:20:01", 30.0, 0.0, 30.0),
        ("h1", "2024-10-04 00:50:01", 5.0, 6.0, 7.0), ("h1", "2024-10-04 12:40:01", 1.0, 2.0, 3.0),
    ]
    buckets = host.sar_interval(series.select("host", "ts", "pgpgin"))
    assert got(buckets, F.date_format("bucket", "HH:mm"), "pgpgin") == [("00:00", 20.0), ("00:30", 5.0), ("12:30", 1.0)]
    assert [(r.host, r.pgpgin) for r in host.paging_series(series).collect()] == [("h1", 10.0), ("h1", 30.0), ("h1", 5.0), ("h1", 1.0)]
    one = sar_series(spark, str(day / "paging"), "paging", date="2024-10-05")
    assert one.columns[:4] == ["host", "log_date", "ts", "pgpgin"] and one.count() == 4
    assert {r.log_date for r in one.collect()} == {dt.date(2024, 10, 5)}
    with pytest.raises(ValueError):
        sar_series(spark, str(day / "paging"), "paging")
    with pytest.raises(ValueError):
        sar_header(spark, path, "swapping")


def test_series_columns_follow_each_header(spark, tmp_path):
    for host_, head, row in (("a", "pgpgin/s pgpgout/s fault/s", "1 2 3"), ("b", "pgpgout/s  fault/s pgpgin/s", "2 3 1"), ("c", "", "1 2 3")):
        day = tmp_path / f"host={host_}" / "log_date=2024-10-04"
        day.mkdir(parents=True)
        (day / "paging").write_text((f"00:00:01  {head}\n" if head else "") + f"00:10:01  {row}\n")
    series = sar_series(spark, str(tmp_path), "paging")
    assert series.columns == ["host", "log_date", "ts", "pgpgin", "pgpgout", "fault"]
    assert got(series, "host", "pgpgin", "pgpgout", "fault") == [(h, 1.0, 2.0, 3.0) for h in "abc"]
    assert got(sar_series(spark, f"{tmp_path}/host=b", "paging"), "pgpgin", "pgpgout") == [(1.0, 2.0)]


def test_metric_names():
    assert [metric_name(c) for c in ("pgpgin/s", "%memused", "kbdirty")] == ["pgpgin", "pct_memused", "kbdirty"]
    assert all(len(set(map(metric_name, columns))) == len(columns) for columns in SAR_COLUMNS.values())


def processes(spark):
    rows = [("h1" if i % 2 else "h2", f"u{i}", float(i % 50), "cmd", dt.date(2024, 10, 4)) for i in range(200)]
    return spark.createDataFrame(rows, "host STRING, user STRING, pct_mem DOUBLE, command STRING, log_date DATE")


def test_top_processes_only_when_swap_is_high(spark):
    calm, busy = readings(spark, (1, 2, "1%", 75, 100)), readings(spark, (1, 2, "1%", 76, 100))
    top = host.top_memory_processes(processes(spark), snapshots=busy)
    assert [r.pct_mem for r in top.collect()] == [49.0] * 4 + [48.0] * 4 + [47.0] * 2
    assert host.top_memory_processes(processes(spark), snapshots=calm).count() == 0
    assert host.top_memory_processes(processes(spark)).count() == 10
    per_host = host.top_memory_processes(processes(spark), 3, busy.withColumn("host", F.lit("h1")), by=("host", "log_date"))
    assert got(per_host, "host", "pct_mem") == [("h1", 49.0)] * 3


def test_host_report_and_files(spark, tmp_path):
    snapshots = readings(spark, (60, 100, "90%", 80, 100), (10, 100, "10%", 1, 100))
    series = snapshots.select("host", F.to_date("ts").alias("log_date"), "ts", F.lit(1.0).alias("pgpgin"), F.lit(2.0).alias("pgpgout"))
    tables = oslogs.host_report(
        snapshots, "2024-10-04", "10:00:00", "10:00:59", {"paging": series}, processes(spark), as_of="2024-10-05")
    assert got(tables["host_status"], "metric", "status") == [("disk", "High"), ("memory", "Moderate"), ("swap", "High")]
    assert tables["paging_series"].count() == tables["paging_interval"].count() == 1
    assert got(tables["top_memory_processes"].groupBy("host").count()) == []  # none of the processes' hosts has high swap
    samples = processes(spark).withColumn("host", F.when(F.col("host") == "h1", "h").otherwise(F.col("host")))
    tables = oslogs.host_report(snapshots, "2024-10-04", "10:00:00", "10:00:59", samples=samples)
    assert got(tables["top_memory_processes"].groupBy("host").count()) == [("h", 10)]
    with pytest.raises(ValueError):
        oslogs.host_report(snapshots, "2024-10-04", as_of="2024-10-12")

    path = str(tmp_path / "status")
    sinks.write_host_status(snapshots, path)
    sinks.write_host_status(snapshots.withColumn("ts", F.expr("ts + interval 1 day")), path)  # another day is added
    sinks.write_host_status(snapshots, path)  # the same day is replaced
    sinks.write_host_status(snapshots.withColumn("host", F.lit("other")), path)  # another host is added
    days = spark.read.csv(path, sep="\t", header=True).where("metric = 'memory'")
    assert got(days.groupBy("host", "log_date").count(), "host", F.col("log_date").cast("string"), "count") == [
        ("h", "2024-10-04", 2), ("h", "2024-10-05", 2), ("other", "2024-10-04", 2)]
    assert days.columns == ["ts", "used", "total", "pct", "status", "metric", "log_date", "host"]
    path = str(tmp_path / "more")
    sinks.write_sar_dumps({"paging": series}, path)
    assert spark.read.csv(f"{path}/paging_sar", sep="\t", header=True).count() == 2
    sinks.write_top_processes(processes(spark), f"{path}/top", snapshots)
    assert spark.read.csv(f"{path}/top", sep="\t", header=True).count() == 10
    snapshots.write.csv(f"{path}/snap", sep="\t", header=True)
    assert host_snapshots(spark, f"{path}/snap", fmt="csv").count() == 2


def test_recent_days(spark):
    check_recent("2024-10-04", "2024-10-11"), check_recent("2024-10-11", "2024-10-11")
    for late in ("2024-10-03", "2024-10-12"):
        with pytest.raises(ValueError):
            check_recent(late, "2024-10-11")
    rows = spark.createDataFrame([(dt.date(2024, 10, d),) for d in (3, 4, 11, 12)], "log_date DATE")
    assert got(filters.recent_days(rows, "2024-10-11")) == [(dt.date(2024, 10, 4),), (dt.date(2024, 10, 11),)]


def test_small_filters(spark, log):
    lines = log_lines(spark, log("Memory Usage\t1", "Load\t2", "Swap Usage\t3", "9 x", "x 9"))
    assert got(filters.metric_rows(lines), "value") == [("Memory Usage\t1",), ("Swap Usage\t3",)]
    assert got(filters.data_rows_only(lines), "value") == [("9 x",)]


def test_generated_lines(spark):
    lines = [r.value for r in synthetic.synthetic_solaris(spark, seed=1, at="2024-11-09 12:00:00").collect()]
    assert len(lines) == 500 and sum("kern.success]" in line for line in lines) == 415
    assert all(line.startswith("Nov 09 12:00:00 solaris-host genunix: [ID ") for line in lines)
    again = [r.value for r in synthetic.synthetic_solaris(spark, seed=1, at="2024-11-09 12:00:00").collect()]
    other = [r.value for r in synthetic.synthetic_solaris(spark, seed=2, at="2024-11-09 12:00:00").collect()]
    assert lines == again != other
    assert len({line.split("] ", 1)[1] for line in lines if "kern.success" in line}) == 24
    assert synthetic.synthetic_solaris(spark, 10, 3).count() == 10


def test_default_paths():
    assert default_path("mem") == default_path("ubu", "nofile") == "/var/log/syslog"
    assert default_path("dpkg") == "/var/log/dpkg.log.1" and default_path("auth") == "/var/log/auth.log"
    assert default_path("mem", "/x") == "/x"
    with pytest.raises(ValueError):
        default_path("cbs")


@pytest.mark.parametrize("family,counts,lengths", [
    # severe, mild, warning, success as counted; the wide styles draw success less the others
    ("mem", (1, 3, 0, 4), (40, 121, 1, 1)), ("mac", (1, 3, 0, 4), (40, 121, 1, 0)), ("sol", (1, 3, 0, 9), (25, 73, 1, 100)),
    ("proc", (1, 3, 0, 4), (39, 120, 1, 1)), ("proc", (0, 0, 0, 7), (1, 1, 1, 100)), ("ubu", (0, 0, 0, 7), (1, 1, 1, 120)),
    ("mem", (0, 0, 0, 0), (1, 1, 1, 1)), ("mem", (5, 0, 0, 1), (121, 1, 1, 1)), ("mem", (1, 0, 0, 1000), (1, 1, 1, 101)),
    ("proc", (0, 0, 0, 0), ()), ("ubu", (0, 0, 0, 0), ()), ("cbs", (1, 3, 0, 0), (16, 50, 0, 0)), ("wsys", (1, 3, 0, 4), (12, 37, 0, 50)), ("cbs", (0, 0, 0, 0), (0, 0, 0, 0)),
])
def test_bars(spark, family, counts, lengths):
    severe, mild, warning, success = counts
    summary = spark.createDataFrame(
        [(severe, mild, warning, success, success - severe - mild - warning, sum(counts))],
        "severe LONG, mild LONG, warning LONG, success_count LONG, net_success LONG, total LONG",
    )
    assert tuple(r.bar_len for r in bars.severity_bars(summary, family).collect()) == lengths
