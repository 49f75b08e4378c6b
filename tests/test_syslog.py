"""Hand-written syslog lines with known answers."""

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs.operators import errors, filters, parse, severity
from oslogs.sources.text import log_lines

T = "2024-11-09T"


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_iso_lines(spark, log):
    path = log(
        T + "10:00:00.000001+00:00 h1 kernel[1]: kernel bug at mm",
        T + "10:00:00.000001+00:00 h1 kernel: [  12.3] Out of memory",
        T + "10:00:01.5+00:00 h1 app[2]: oom killer ran",
        T + "10:00:02.5+00:00 h1 app[2]: segfault error",
        T + "10:00:03.5+00:00 h1 app[2]: a]: b error",
        T + "10:00:04+00:00 h1 app[2]:   spaces around   ",
        "no date here: error",
        "",
    )
    rows = oslogs.analyze(spark, "mem", "2024-11-09", path=path)
    assert got(rows, "log_time", "app_name", "message", "category", F.array_join("error_types", ",")) == [
        ("10:00:00", "kernel", "kernel bug at mm", "severe_error", "kernel bug"),
        ("10:00:01", "app", "oom killer ran", "success", "oom"),
        ("10:00:02", "app", "segfault error", "mild_error", "segfault"),
        ("10:00:03", "app", "a", "success", ""),
        ("10:00:04", "app", "spaces around", "success", ""),
    ]
    assert got(parse.rejected_lines(log_lines(spark, path)), "value") == [("",), ("no date here: error",)]


def test_iso_date_anywhere_in_the_line(spark, log):
    path = log("<13>2024-11-09T10:00:00.1+00:00 h1 app[2]: error", "2024-13-45T10:00:00.1 h1 app[2]: error")
    rows = parse.parse_iso_syslog(log_lines(spark, path))
    assert got(rows, F.col("log_date").cast("string"), "log_time", "app_name") == [("2024-11-09", "10:00:00", "app")]


def test_bsd_lines(spark, log):
    path = log(
        "Nov  9 12:00:07 h1 sshd[812]: Failed password",
        "Nov  9 12:00:08 h1 error[5]: all is well",
        "Nov  9 12:00:09 h1 cron: ok: a:b",
        "Nov 09 12:00:10 h1 x]: y",
        "Nov 10 12:00:11 h1 app[1]: error",
        "Nov  9 no colons at all error",
        "Nov  9 one colon: only",
        "Foo  9 12:00:12 h1 app[1]: error",
    )
    rows = oslogs.analyze(spark, "mem", "2024-11-09", path=path)
    assert got(rows, "log_time", "app_name", "message", "category") == [
        ("12:00:07", "sshd", "07 h1 sshd[812]: Failed password", "success"),
        ("12:00:08", "error", "08 h1 error[5]: all is well", "mild_error"),
        ("12:00:09", "cron", "09 h1 cron: ok: a:b", "success"),
        ("12:00:10", "x", "10 h1 x]: y", "success"),
    ]
    no_window = oslogs.analyze(spark, "mem", "2024-11-09", "23:00:00", "23:30:00", path, bsd_time_filter=False)
    assert got(no_window, "app_name", "message") == [
        ("at", "Nov  9 no colons at all error"),  # the fifth word
        ("cron", "09 h1 cron: ok: a:b"),
        ("error", "08 h1 error[5]: all is well"),
        ("sshd", "07 h1 sshd[812]: Failed password"),
        ("x", "10 h1 x]: y"),
    ]


def test_bsd_year(spark, log):
    path = log("Feb 29 12:00:07 h1 a[1]: x", "Nov  9 12:00:07 h1 a[1]: x")
    lines = log_lines(spark, path)
    dates = lambda year: got(parse.parse_bsd_syslog(lines, year=year), "log_month", F.col("log_date").cast("string"))
    assert dates(None) == [(2, None), (11, None)]
    assert dates(2024) == [(2, "2024-02-29"), (11, "2024-11-09")]
    stamped = log_lines(spark, path, modified=True).withColumn("modified", F.lit("2024-06-01 00:00:00").cast("timestamp"))
    rows = parse.parse_bsd_syslog(stamped, year="modified")
    assert got(rows, F.col("log_date").cast("string")) == [("2023-11-09",), ("2024-02-29",)]


def test_solaris_severity_comes_from_the_tag(spark, log):
    path = log(
        "Nov 09 12:00:07 solaris-host genunix: [ID 7 kern.critical] ok",
        "Nov 09 12:00:08 solaris-host genunix: [ID 8 kern.success] Process started without errors",
        "Nov 09 12:00:09 solaris-host ftpd: [ID 9 kern.info] FTPD: IMPORT a, connection from h",
    )
    rows = oslogs.analyze(spark, "sol", "2024-11-09", path=path)
    assert got(rows, "log_time", "app_name", "category", F.array_join("error_types", ",")) == [
        ("12:00:07", "genunix", "severe_error", ""),
        ("12:00:08", "genunix", "mild_error", ""),
        ("12:00:09", "ftpd", "success", "connection issue,ftp"),
    ]
    table = got(errors.error_table(rows, "sol"), "error", "app_name", "n")
    assert ("connection issue", "ftpd", 1) in table and len(table) == 10
    assert not any(error == "ftp" for error, _, _ in table)


@pytest.mark.parametrize("start,end,kept", [
    ("10:00:00", "10:00:02", ["10:00:00", "10:00:01", "10:00:02"]),
    ("10:00:01", "10:00:01", ["10:00:01"]),
    ("11:00:00", "12:00:00", []),
])
def test_window_bounds_are_kept(spark, log, start, end, kept):
    path = log(*(f"{T}10:00:0{i}.9+00:00 h a[1]: m" for i in range(4)))
    rows = oslogs.analyze(spark, "mem", "2024-11-09", start, end, path)
    assert [t for (t,) in got(rows, "log_time")] == kept


def test_empty_window_keeps_complete_tables(spark, log):
    path = log(T + "10:00:00.1+00:00 h a[1]: error")
    for kind in ("mem", "proc", "ubu", "mac", "sol"):
        tables = oslogs.report(oslogs.analyze(spark, kind, "2024-11-10", path=path), kind)
        assert tables["severity_report"].count() == 0
        assert [tuple(r) for r in tables["analysis_summary"].collect()] == [(0, 0, 0, 0, 0, 0)]
        table = tables["error_table"].collect()
        assert table and {(r.app_name, r.n) for r in table} == {("N/A", 0)}
        assert [r.n for r in tables["severity_bars"].collect()] == ([] if kind in ("proc", "ubu") else [0, 0, 0, 0])


def test_parameters_are_checked(spark):
    for bad in (("2024-1-9", "00:00:00", "23:59:59"), ("2024-11-09", "24:00:00", "23:59:59"),
                ("2024-11-09", "00:00:00", "9:00:00")):
        with pytest.raises(ValueError):
            oslogs.analyze(spark, "mem", *bad, path="/nowhere")
    with pytest.raises(ValueError):
        oslogs.analyze(spark, "vms", "2024-11-09", path="/nowhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        oslogs.analyze(spark, "mem", "2024-11-09", path="/nowhere").count()


def test_report_reads_the_log_once(spark, log):
    path = log(
        T + "10:00:00.1+00:00 h a[1]: critical error", T + "10:00:00.1+00:00 h a[1]: critical again",
        T + "10:00:00.1+00:00 h b[1]: fail", T + "10:00:00.1+00:00 h b[1]: deprecated", T + "10:00:00.1+00:00 h b[1]: fine",
    )
    rows = oslogs.analyze(spark, "mem", "2024-11-09", path=path)
    tables = oslogs.report(rows, "mem")
    assert [tuple(r) for r in tables["severity_report"].collect()] == [
        ("Severe Error", "a", 2), ("Mild Error", "b", 1), ("Warning", "b", 1),
    ]
    assert tables["analysis_summary"].collect() == severity.analysis_summary(rows).collect()
    assert tables["error_table"].collect() == errors.error_table(rows, "mem").collect()
    for table in tables.values():
        assert "log" not in {f.rsplit("/", 1)[-1] for f in table.inputFiles()}


def test_rows_split_over_files_in_any_order_count_the_same(spark, log):
    lines = [f"{T}10:00:00.{i}+00:00 h app{i % 3}[1]: {m}" for i, m in enumerate(
        ["error", "critical", "warning", "ok", "oom", "malloc fail"] * 5)]
    whole = log(*lines, name="one/log")
    for i in range(3):
        log(*reversed(lines[i::3]), name=f"three/log{i}")
    tables = []
    for path in (whole, whole.replace("one/log", "three")):
        rows = oslogs.analyze(spark, "mem", "2024-11-09", path=path)
        tables.append((got(severity.severity_by_app(rows), "category", "app_name", "n"),
                       got(errors.error_table(rows, "mem"), "error", "app_name", "n")))
    assert tables[0] == tables[1]


def test_windows_line_ends(spark, log):
    path = log(T + "10:00:00.1+00:00 h a[1]: fail", newline="\r\n")
    assert got(oslogs.analyze(spark, "mem", "2024-11-09", path=path), "message") == [("fail",)]


def test_date_range(spark, log):
    iso = log(*(f"2024-11-{d:02}T10:00:00.1+00:00 h a[1]: d{d}" for d in range(7, 13)), name="iso")
    bsd = log(*(f"Nov {d:2} 10:00:00 h a[1]: d{d}" for d in range(7, 13)), name="bsd")
    days = lambda path, mode: [d for (d,) in got(oslogs.analyze(
        spark, "ubu", "2024-11-08", path=path, last="2024-11-10", inclusive=mode), "log_day")]
    assert days(iso, "both") == [8, 9, 10]
    assert days(iso, "neither") == [9]
    assert days(bsd, "both") == days(bsd, "neither") == [8, 9, 10]


def test_yearless_range_over_new_year(spark, log):
    path = log("Dec 30 10:00:00 h a[1]: x", "Dec 31 10:00:00 h a[1]: x", "Jan  1 10:00:00 h a[1]: x", "Jun  1 10:00:00 h a[1]: x")
    rows = oslogs.analyze(spark, "ubu", "2023-12-31", path=path, last="2024-01-02")
    assert got(rows, "log_month", "log_day") == [(1, 1), (12, 31)]


def test_prefix_stop_follows_line_order(spark, log):
    path = log(
        T + "10:00:00.1+00:00 h a[1]: one", T + "10:00:01.1+00:00 h a[1]: two", T + "12:00:00.1+00:00 h a[1]: late",
        T + "10:00:02.1+00:00 h a[1]: unsorted",
    )
    rows = parse.parse_iso_syslog(log_lines(spark, path))
    late = filters.late_for("2024-11-09", "11:00:00")
    assert got(filters.prefix_stop(rows, late), "message") == [("one",), ("two",)]
    assert got(filters.prefix_stop(rows, late, per_file=True), "message") == [("one",), ("two",)]
    assert filters.prefix_stop(rows, F.col("log_time") > "13:00:00").count() == 4


def test_every_line_is_parsed_or_rejected(spark, log):
    path = log("Foo  9 10:00:00 h a[1]: x", "2024-13-45T10:00:00.1 h a[1]: x", "junk", "2024-11-09T10:00:00.1 h a[1]: x", "Nov  9 10:00:00 h a[1]: x")
    lines = log_lines(spark, path)
    assert parse.parse_syslog(lines).count() == 2
    assert got(parse.rejected_lines(lines), "value") == [("2024-13-45T10:00:00.1 h a[1]: x",), ("Foo  9 10:00:00 h a[1]: x",), ("junk",)]
