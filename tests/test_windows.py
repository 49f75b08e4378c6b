"""Windows component-servicing, System and Security logs."""

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs.functions.dates import as_date, normalise_date
from oslogs.operators import errors, filters, parse, severity
from oslogs.sources.text import log_lines
from oslogs.sources.windows import system_header, windows_system

HEADER = "Level\tDate and Time\tSource\tEvent ID\tTask Category"


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_cbs(spark, log):
    path = log(
        "2016-09-28 04:30:31, Info                  CBS    Failed [HRESULT = 0x80004005 - E_FAIL]",
        "2016-09-28 04:30:31, Info                  CBS    Failed [HRESULT = 0x80004005]",
        "2016-09-28 04:30:32, Info                  CSI    Failed [HRESULT = 0x800f080d]",
        "2016-09-28 04:30:33, Info                  CBS    Loaded Stack",
        "2016-09-28 04:30:34, Warning  CBS  disk WARN",
        "2016-09-28 04:30:35, Info  CBS  ",
        "  2016-09-28 04:30:35, Info  CBS  indented",
        "2016-09-28 04:30:36 Info  CBS  no comma",
        "2016-09-29 04:30:31, Info                  CBS    other day Error",
    )
    rows = oslogs.analyze(spark, "cbs", "28-09-2016", path=path)
    assert got(rows, "log_time", "level", "app_name", "message", "category") == [
        ("04:30:31", "Info", "CBS", "Failed [HRESULT = 0x80004005 - E_FAIL]", "severe_error"),
        ("04:30:31", "Info", "CBS", "Failed [HRESULT = 0x80004005]", "mild_error"),
        ("04:30:32", "Info", "CSI", "Failed [HRESULT = 0x800f080d]", "mild_error"),
        ("04:30:33", "Info", "CBS", "Loaded Stack", "success"),
        ("04:30:34", "Warning", "CBS", "disk WARN", "warning"),
        ("04:30:35", "Info", "CBS", "", "success"),
    ]
    tables = oslogs.report(rows, "cbs")
    assert [tuple(r) for r in tables["error_table"].collect()] == [
        ("E_FAIL", "N/A", 2, "E_FAIL"), ("CBS_E_MANIFEST_INVALID_ITEM", "N/A", 1, "CBS_E_MANIFEST_INVALID_ITEM"),
    ]
    assert got(tables["analysis_summary"]) == [(1, 2, 1, 2, -2, 6)]
    assert [r.bar_len for r in tables["severity_bars"].collect()] == [25, 50, 25, 50]
    named = errors.hresult_lookup(errors.with_hresult(rows).groupBy("hresult_code").count())
    assert ("0x800f080d", 1, "CBS_E_MANIFEST_INVALID_ITEM") in got(named)
    bounds = filters.between_instants(parse.parse_cbs(log_lines(spark, path)), "2016-09-28 04:30:34", "2016-09-29 04:30:31")
    assert got(bounds, "log_time", "message") == [
        ("04:30:31", "other day Error"), ("04:30:34", "disk WARN"), ("04:30:35", ""),
    ]


def test_system_columns_follow_each_header(spark, log):
    log(
        HEADER,
        "Error\t28-11-2024 10:00:00\tNtfs\t55\tNone\tChkdsk must\trun",
        "Error\t28-11-2024 10:00:00\tNtfs",
        "",
        "Error\t29-11-2024 10:00:00\tNtfs\t55\tNone\tcritical",
        "Error\t28-11-2024 10:00:01\t\t55\tNone\tfail",
        name="win/a.txt",
    )
    path = log(
        "Source\tTask Category\tLevel\tEvent ID\tDate and Time",
        "Disk\tNone\tWarning\t7\t28-11-2024 11:00:00\tout of memory",
        "Disk\tNone\tWarning\t7\t28-11-2024 23:00:00",
        name="win/b.txt",
    )
    folder = path.rsplit("/", 1)[0]
    expected = [
        ("10:00:00", "Error", "Ntfs", "55", "None", "Chkdsk must run", "severe_error"),
        ("10:00:01", "Error", "", "55", "None", "fail", "mild_error"),
        ("11:00:00", "Warning", "Disk", "7", "None", "out of memory", "severe_error"),
    ]
    rows = oslogs.analyze(spark, "wsys", "2024-11-28", "10:00:00", "22:59:59", folder)
    assert got(rows, "log_time", "level", "app_name", "event_id", "task_category", "message", "category") == expected
    assert got(oslogs.analyze(spark, "wsys", "2024-01-01", path=folder, last="2024-12-31").where("app_name = 'Disk'"), "log_time") == [
        ("11:00:00",), ("23:00:00",)]
    table = errors.error_table(rows, "wsys").collect()
    assert [tuple(r) for r in table] == [
        ("Out of Memory", "Disk", 1, "Out of Memory"), ("Kernel Bug", "N/A", 0, "Kernel Bug"),
        ("Critical", "N/A", 0, "Critical Error"), ("Disk Failure", "Ntfs", 1, "Disk Failure / I/O Error"),
    ]
    names = system_header(spark, f"{folder}/b.txt")
    assert names == ["Source", "Task Category", "Level", "Event ID", "Date and Time"]
    for file, header in (("a.txt", HEADER.split("\t")), ("b.txt", names)):
        fixed = windows_system(spark, f"{folder}/{file}", header)
        assert got(fixed) == got(windows_system(spark, f"{folder}/{file}"))
    one_pass = oslogs.analyze(spark, "wsys", "2024-11-28", path=f"{folder}/b.txt", header=names)
    assert got(one_pass, "log_time", "message") == [("11:00:00", "out of memory"), ("23:00:00", "")]


def test_well_formed(spark, log):
    path = log(HEADER, "a\tb\tc\td", "\t\t\t\t", "a\t\t\t\t")
    assert got(filters.well_formed_windows(log_lines(spark, path)), "value") == [(HEADER,), ("a\t\t\t\t",)]


def test_security(spark, log):
    path = log(
        "Keywords\tDate and Time\tSource\tEvent ID\tAction",
        "Audit Success\t28-11-2024 10:00:00\tAuditing\t4624\tLogon",
        "Audit Success\t28-11-2024 10:00:00\tAuditing\t4624\tLogon",
        "Audit Success\t28-11-2024 11:00:00\tAuditing\t4634\tLogoff",
        "Audit Success\t28-11-2024 11:00:01\tAuditing\t4634\tLogoff",
        "Audit Success\t27-11-2024 10:00:00\tAuditing\t4624\tLogon",
        "Audit Success\t28-11-2024 10:30:00\tAuditing",
    )
    rows = oslogs.analyze(spark, "wsec", "2024-11-28", "10:00:00", "11:00:00", path)
    assert got(oslogs.report(rows, "wsec")["security_actions"]) == [("", 1), ("Logoff", 1), ("Logon", 2)]


def test_dates_of_both_spellings(spark):
    texts = ["2024-11-28", "28-11-2024", "2024-02-30", "30-02-2024", "28.11.2024", "", "2024-1-2"]
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", normalise_date(F.col("t")).alias("d"))
    dates = {t: d for t, d in frame.collect()}
    assert dates["2024-11-28"] == dates["28-11-2024"] == as_date("28-11-2024") == as_date("2024-11-28")
    assert [t for t in texts if dates[t] is None] == texts[2:]


def test_summary_of_system_log(spark, log):
    path = log(HEADER, *(f"Error\t28-11-2024 10:00:0{i}\tS\t1\tNone\t{m}" for i, m in enumerate(["error", "fail", "ok"])))
    rows = oslogs.analyze(spark, "wsys", "2024-11-28", path=path)
    assert got(severity.raw_total(rows)) == [(3,)]
    assert got(severity.severity_totals(rows)) == [("mild_error", 2), ("severe_error", 0), ("success", 1), ("warning", 0)]


def test_no_file_is_lost_for_want_of_a_header(spark, log):
    row = "Error\t28-11-2024 10:00:00\tNtfs\t55\tNone\t"
    log(HEADER, row + "first", name="win/a.txt")
    folder = log(row + "second", name="win/b.txt").rsplit("/", 1)[0]
    assert got(oslogs.analyze(spark, "wsys", "2024-11-28", path=folder), "message") == [("first",), ("second",)]
    log("\t".join(reversed(HEADER.split("\t"))), name="win/c.txt")
    with pytest.raises(Exception, match="no header row in .*b.txt"):
        oslogs.analyze(spark, "wsys", "2024-11-28", path=folder).collect()
    assert oslogs.analyze(spark, "wsys", "2024-11-28", path=folder, header=HEADER.split("\t")).count() == 2
    with pytest.raises(ValueError, match="no header row"):
        windows_system(spark, f"{folder}/b.txt")
