"""The plans Spark chooses: single scans, early filters, pruning, no Python and no broadcast of growing data."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import oslogs
from oslogs import session, sinks
from oslogs.__main__ import main
from oslogs.operators import auth, errors, filters, host, packages, parse, severity
from oslogs.plans.derived import derived
from oslogs.plans.queries import QUERIES
from oslogs.sources.host import host_snapshots, process_samples
from oslogs.sources.tables import parsed_rows
from oslogs.sources.text import log_lines
from oslogs.sources.windows import windows_system


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


def test_no_query_runs_python_or_a_cross_join(spark, sf_dir):
    for name, query in QUERIES.items():
        text = plan(query(spark, sf_dir))
        assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", text), name


def test_log_is_scanned_once(spark, sf_dir):
    rows = filters.nonempty_message(parse.parse_syslog(log_lines(spark, derived(spark, sf_dir, "mixed"))))
    classified = severity.classified(rows, "ubu")
    for df in (severity.severity_by_app(classified), severity.analysis_summary(classified),
               severity.severity_totals(classified), severity.summarize(classified)):
        assert tree(df).count("Scan text") == 1
    table = errors.error_table(classified, "ubu")
    table.collect()
    final = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Scan text") == 1 and "ReusedExchange" in final and "Join" not in final
    assert tree(severity.summarize(classified)).count("Exchange") == 1
    assert tree(severity.severity_by_app(classified)).count("Exchange") == 1


def test_message_and_category_are_computed_once(spark, sf_dir):
    """A filter on the category does not repeat the word searches."""
    rows = parse.parse_syslog(log_lines(spark, derived(spark, sf_dir, "mixed")))
    text = plan(severity.severity_by_app(severity.with_category(rows, "ubu")))
    assert text.count("deprecated") == 1 and text.count("kernel bug") == 1
    assert "Generate" in text


def test_day_filter_runs_before_the_cuts(spark, sf_dir):
    path = derived(spark, sf_dir, "mixed")
    lines = tree(oslogs.analyze(spark, "mem", "2024-01-15", path=path)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan text" in line)
    assert "Filter" in lines[scan - 1] or "Filter" in lines[scan - 2]
    rows = filters.on_date(parse.parse_syslog(log_lines(spark, path)), "2024-01-15")
    days = [i for i, line in enumerate(tree(rows).splitlines()) if "Generate" in line or "Filter" in line]
    assert "Generate" in tree(rows).splitlines()[days[0]]  # the date filter is below the last cut


def test_landed_rows_are_pruned(spark, sf_dir, tmp_path):
    rows = parse.parse_iso_syslog(log_lines(spark, derived(spark, sf_dir, "iso")))
    path = str(tmp_path / "landed")
    sinks.write_parsed(rows, path)
    text = plan(filters.on_date(parsed_rows(spark, path), "2024-01-15").select("message"))
    assert "PartitionFilters: [isnotnull(log_date" in text and "2024-01-15" in text
    assert path.rsplit("/", 1)[0] and parsed_rows(spark, path).columns == [*rows.drop("log_date", "kind").columns, "kind", "log_date"]
    assert "ReadSchema: struct<message:string,landing:string>" in text  # the number of the landing tells whether a row is valid
    later = filters.between_times(filters.on_day(parsed_rows(spark, path), "2024-01-15"), "06:00:00", "07:00:00")
    assert "GreaterThanOrEqual(log_time,06:00:00)" in plan(later)
    assert "PartitionFilters: [((log_date" in plan(later) or "PartitionFilters: [isnotnull" in plan(later)
    assert compare_counts(rows, parsed_rows(spark, path))
    one_day = oslogs.analyze(spark, "mem", "2024-01-15", path=path, landed=True)
    assert "/rows/kind=mem" in plan(one_day) and "log_date" in plan(one_day).split("PartitionFilters: ")[1].split("]")[0]
    text_day = oslogs.analyze(spark, "mem", "2024-01-15", path=derived(spark, sf_dir, "iso"))
    assert compare_counts(one_day, text_day)


def compare_counts(a, b):
    count = lambda df: sorted(tuple(r) for r in df.groupBy("log_date", "app_name").count().collect())
    return count(a) == count(b)


def test_unused_columns_are_not_read(spark, sf_dir):
    snapshots = host_snapshots(spark, derived(spark, sf_dir, "host"))
    assert "ReadSchema: struct<host:string,ts:timestamp_ntz,mem_used_mb:int,mem_total_mb:int>" in plan(
        host.memory_status(snapshots))
    lines = log_lines(spark, derived(spark, sf_dir, "mixed"))
    assert "monotonically_increasing_id" not in plan(severity.severity_totals(
        severity.with_category(parse.parse_syslog(lines), "mem")))


def test_partial_counts_before_the_shuffle(spark, sf_dir):
    rows = packages.latest_package_action(parse.parse_dpkg(log_lines(spark, derived(spark, sf_dir, "dpkg"))))
    assert "partial_max_by" in plan(rows) and "Window" not in tree(rows)
    samples = process_samples(spark, derived(spark, sf_dir, "ps"))
    assert "TakeOrderedAndProject" in tree(host.top_memory_processes(samples))
    assert tree(host.top_memory_processes(samples, by=("host",))).count("WindowGroupLimit") == 2


def test_one_layout_needs_no_join(spark, sf_dir, log):
    """All exports with one header row share its positions; only differing ones are looked up by file."""
    rows = windows_system(spark, derived(spark, sf_dir, "wsys"))
    assert "Join" not in tree(rows) and "Exchange" not in tree(rows) and tree(rows).count("Scan text") == 1
    head = ["Level", "Date and Time", "Source", "Event ID", "Task Category"]
    log("\t".join(head), name="w/a"), log("\t".join(head[::-1]), name="w/b")
    assert "Join" in tree(windows_system(spark, log("\t".join(head), name="w/c").rsplit("/", 1)[0]))


def test_line_order_does_not_stop_pruning(spark, tmp_path):
    """A condition given to the scan prunes directories although the rows are numbered."""
    for day in ("2024-01-01", "2024-01-02"):
        folder = tmp_path / f"log_date={day}"
        folder.mkdir()
        (folder / "dpkg.log").write_text(f"{day} 10:00:00 install a:amd64 1 2\n")
    lines = log_lines(spark, str(tmp_path), where=F.col("log_date") == F.lit("2024-01-02").cast("date"))
    text = plan(lines)
    assert "PartitionFilters: [isnotnull(log_date" in text
    assert packages.latest_package_action(parse.parse_dpkg(lines)).count() == 1
    rows = oslogs.analyze(spark, "dpkg", "2024-01-02", path=str(tmp_path))
    assert "PartitionFilters: [isnotnull(log_date" in plan(rows) and rows.count() == 1


def test_expressions_accept_a_stream(spark, sf_dir):
    """Parsing, filters and rules are stateless, so a streaming scan of new files works unchanged."""
    stream = spark.readStream.text(derived(spark, sf_dir, "mixed"))
    rows = severity.classified(filters.in_window(parse.parse_syslog(stream), "2024-01-15", "06:00:00", "18:00:00"), "mem")
    assert rows.isStreaming
    query = rows.select("category").writeStream.format("memory").queryName("oslogs_stream").trigger(availableNow=True).start()
    query.awaitTermination(120)
    batch = severity.classified(filters.in_window(parse.parse_syslog(log_lines(
        spark, derived(spark, sf_dir, "mixed"))), "2024-01-15", "06:00:00", "18:00:00"), "mem")
    assert spark.table("oslogs_stream").count() == batch.count() > 0


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("kind", ["mem", "auth", "dpkg"])
def test_command_line(spark, sf_dir, tmp_path, capsys, kind):
    path = derived(spark, sf_dir, {"mem": "mixed"}.get(kind, kind))
    main([kind, "2024-01-10", "00:00:00", "23:59:59", path, "--last", "2024-01-20", "--out", str(tmp_path)])
    shown = capsys.readouterr().out
    assert {"mem": "error_table", "auth": "auth_summary", "dpkg": "package_bars"}[kind] in shown
    tables = oslogs.report(oslogs.analyze(spark, kind, "2024-01-10", path=path, last="2024-01-20"), kind)
    assert len(list(tmp_path.iterdir())) == len(tables) + 1  # and the count table
    for name, table in tables.items():
        assert spark.read.csv(str(tmp_path / name), sep="\t", header=True).count() == table.count(), name


def test_command_line_exports_what_it_does_not_show(spark, log, tmp_path, capsys):
    path = log(*(f"2024-11-09T10:{i // 60:02}:{i % 60:02}.1+00:00 h sudo[1]: ann : PWD=/ ; USER=root ; COMMAND=/bin/{i}" for i in range(120)))
    main(["auth", "2024-11-09", "10:00:00", "10:01:29", path, "--rows", "50", "--out", str(tmp_path / "out")])
    assert "only showing top 50 rows" in capsys.readouterr().out
    assert spark.read.csv(str(tmp_path / "out/sudo_commands"), sep="\t", header=True).count() == 90


def test_command_line_for_hosts(spark, sf_dir, tmp_path, capsys):
    main(["host", "2024-01-15", "06:00:00", "18:00:00", derived(spark, sf_dir, "host"), "--series",
          "paging=" + derived(spark, sf_dir, "sar"), "--processes", derived(spark, sf_dir, "ps"), "--out", str(tmp_path)])
    shown = capsys.readouterr().out
    assert all(name in shown for name in ("host_status", "paging_interval", "paging_series", "top_memory_processes"))
    assert {p.name for p in tmp_path.iterdir()} == {"host_status", "used_free", "paging_interval", "paging_series", "top_memory_processes"}
    status = spark.read.csv(str(tmp_path / "host_status"), sep="\t", header=True, schema="host STRING, ts TIMESTAMP_NTZ")
    assert {(t.hour >= 6, t.hour <= 18) for _, t in status.select("host", "ts").collect()} == {(True, True)}


def test_auth_rows_use_extracts_only_on_hits(spark, sf_dir):
    rows = auth.with_auth_event(parse.parse_iso_auth(log_lines(spark, derived(spark, sf_dir, "auth"))))
    lines = tree(auth.sudo_commands(rows)).splitlines()
    project = next(i for i, line in enumerate(lines) if "Project" in line)
    assert any("Filter" in line for line in lines[project:])
