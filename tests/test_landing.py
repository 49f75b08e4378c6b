"""Tables of landings and stored daily summaries: bounded directories, replacement, failures, reports without the log."""

import os

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs import sinks
from oslogs.__main__ import main
from oslogs.operators import severity
from oslogs.sources import tables
from oslogs.sources.tables import daily_summaries, parsed_rows

LINE = "2024-11-{:02d}T{:02d}:00:00.1 h{} a[1]: {}".format


def files(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def folders(path):
    return sum(len(names) for _, names, _ in os.walk(path))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_files_of_a_day_share_one_directory(spark, tmp_path):
    """Every file is a batch of its own; directories and files follow days and rows, not batches."""
    os.mkdir(tmp_path / "x")
    for i in range(300):
        (tmp_path / "x" / f"{i}.log").write_text(LINE(9, i % 24, i, "one") + "\n")
    path = str(tmp_path / "t")
    sinks.write_parsed(oslogs.parsed(spark, "mem", str(tmp_path / "x")), path)
    assert folders(path) <= 6 and files(path) <= 20
    assert parsed_rows(spark, path).count() == 300 and "Join" not in physical(parsed_rows(spark, path))
    (tmp_path / "x" / "7.log").write_text(LINE(9, 1, 7, "again") + "\n")
    sinks.write_parsed(oslogs.parsed(spark, "mem", str(tmp_path / "x" / "7.log")), path)
    assert folders(path) <= 6
    rows = parsed_rows(spark, path)
    assert rows.count() == 300 and [r.message for r in rows.where("message = 'again'").collect()] == ["again"]
    assert "BroadcastHashJoin" in physical(rows)


@pytest.mark.parametrize("named, bound", [(500, 1 << 26), (0, 0)])
def test_a_batch_replaces_its_own_days(spark, log, tmp_path, monkeypatch, named, bound):
    monkeypatch.setattr(tables, "NAMED_LANDINGS", named)
    monkeypatch.setattr(tables, "LOOKUP_BYTES", bound)
    path = str(tmp_path / "t")
    for batch, *lines in (("a", LINE(9, 1, 1, "a9"), LINE(10, 1, 1, "a10")), ("b", LINE(9, 1, 1, "b9")), ("a", LINE(9, 2, 1, "A9"), LINE(9, 3, 1, "A9"))):
        sinks.write_parsed(oslogs.parsed(spark, "mem", log(*lines, name=f"x/{lines[0][8:13]}{batch}")), path, batch)
    assert sorted(r.message for r in parsed_rows(spark, path).collect()) == ["A9", "A9", "a10", "b9"]
    assert sorted(r.message for r in parsed_rows(spark, path, "mem", ("2024-11-09", "2024-11-09")).collect()) == ["A9", "A9", "b9"]


def test_a_failed_landing_is_not_seen(spark, log, tmp_path, monkeypatch):
    """Rows that were written without their manifest, as by a driver that was lost, are no part of the table."""
    path = str(tmp_path / "t")
    first, second = (oslogs.parsed(spark, "mem", log(LINE(9, h, 1, text), name=f"x/{text}")) for h, text in ((1, "one"), (2, "two")))
    sinks.write_parsed(first, path, "a")
    monkeypatch.setattr(sinks, "MANIFEST", "elsewhere")
    sinks.write_parsed(second, path, "a")
    monkeypatch.undo()
    assert [r.message for r in parsed_rows(spark, path).collect()] == ["one"]
    sinks.write_parsed(second, path, "a")
    assert [r.message for r in parsed_rows(spark, path).collect()] == ["two"]


def test_a_family_has_its_own_columns(spark, log, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parsed(oslogs.parsed(spark, "mem", log(LINE(9, 1, 1, "one"), name="x/1")), path)
    sinks.write_parsed(oslogs.parsed(spark, "dpkg", log("2024-11-09 10:00:00 install a:amd64 1 2", name="x/2")), path)
    latest = oslogs.report(oslogs.analyze(spark, "dpkg", "2024-11-09", path=path, landed=True), "dpkg")["package_report"]
    assert [(r.package, r.action) for r in latest.collect()] == [("a:amd64", "install")]


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


@pytest.mark.parametrize("kind", ["ubu", "sol", "cbs"])
def test_a_months_report_equals_a_fresh_scan(spark, tmp_path, kind):
    texts = ("error one", "all fine", "OOM and kernel bug", "warning: high usage", "Failed, HRESULT = 0x80004005]", "fatal")
    made = []
    for day in range(1, 31):
        form = "2024-11-{0:02d} {1:02d}:00:00, Error  CBS  {3}" if kind == "cbs" else "2024-11-{0:02d}T{1:02d}:00:00.1 h app{2}[1]: {3}"
        name = tmp_path / f"log-{day:02d}"
        name.write_text("".join(form.format(day, h, h % 3, texts[(day * h) % len(texts)]) + "\n" for h in range(24)))
        made.append(str(name))
    table = str(tmp_path / "summaries")
    store = lambda path: sinks.write_summaries(oslogs.analyze(spark, kind, "2024-11-01", last="2024-11-30", path=path), table, kind)
    for path in (str(tmp_path / "log-0*"), str(tmp_path / "log-[123]*"), made[4], made[29]):  # two files are stored again
        store(path)
    stored = daily_summaries(spark, table, kind, ("2024-11-03", "2024-11-30"))
    assert "text" not in physical(stored) and "Scan parquet" in physical(stored)
    fresh = oslogs.report(oslogs.analyze(spark, kind, "2024-11-03", last="2024-11-30", path=str(tmp_path / "log-*")), kind)
    for name, report in oslogs.report(stored, kind).items():
        assert rows_of(report) == rows_of(fresh[name]), name


def test_summaries_on_the_command_line(spark, log, tmp_path, capsys):
    path, table = log(LINE(9, 1, 1, "error here"), LINE(10, 1, 1, "fine"), name="x/log"), str(tmp_path / "t")
    main(["mem", "2024-11-09", "00:00:00", "23:59:59", path, "--last", "2024-11-10", "--store-summaries", table, "--out", str(tmp_path / "fresh")])
    os.remove(path)
    main(["mem", "2024-11-09", "--last", "2024-11-10", "--summaries", table, "--out", str(tmp_path / "stored")])
    read = lambda name: sorted(tuple(r) for r in spark.read.csv(str(tmp_path / name / "error_counts"), sep="\t").collect())
    assert read("stored") == read("fresh") and ("Mild Errors", "1") in read("stored")


def test_summaries_of_summaries(spark):
    rows = spark.createDataFrame([("warning", "a", ["x"], 3), ("warning", "a", ["x"], 4)], "category string, app_name string, error_types array<string>, n long")
    assert [r.n for r in severity.summarize(rows).collect()] == [7]


def test_auth_report_reads_the_log_once(spark, log, monkeypatch):
    """The log is scanned for the table by event; every table of the report is read from there."""
    path = log("2024-11-09T10:00:00.1 h sshd[1]: authentication failure; logname= user=ann", "2024-11-09T11:00:00.1 h sudo: bob : PWD=/ ; USER=root ; COMMAND=/bin/ls -l",
               "2024-11-09T12:00:00.1 h sshd[2]: session opened for user ann", "2024-11-09T12:30:00.1 h cron[2]: tick")
    report = oslogs.report(oslogs.analyze(spark, "auth", "2024-11-09", path=path), "auth")
    os.remove(path)
    spark.catalog.clearCache()
    assert [tuple(r)[2:] for r in report["auth_failures"].collect()] == [("N/A", "ann")]
    assert [tuple(r)[2:] for r in report["sudo_commands"].collect()] == [("root", "/", "/bin/ls")]
    assert [tuple(r) for r in report["auth_summary"].collect()] == [(1, 1, 1, 1, 4)]
    assert all("Scan text" not in physical(table) for table in report.values())
    other = report["sudo_commands"].sparkSession.read.parquet(report["auth_failures"].inputFiles()[0].rsplit("/event=", 1)[0])
    assert other.where(F.col("message").isNotNull()).count() == 2
