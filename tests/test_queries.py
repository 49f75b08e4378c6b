"""Every registered query against its DuckDB counterpart, and properties of the counts."""

import sys

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oslogs.operators import errors, filters, parse, severity
from oslogs.plans.derived import SYSLOG_MESSAGES, derived
from oslogs.plans.queries import ORACLE, QUERIES
from oslogs.sources.text import log_lines


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys() and len(QUERIES) >= 86
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert (columns, rows) == compare.duck_rows(duck, ORACLE[name])
    assert rows


def test_entry_without_training_data(monkeypatch):
    monkeypatch.setitem(sys.modules, "oslogs.llm", None)
    assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLE


def test_entry(spark, sf_dir):
    assert entry.entry(spark).columns == ["category", "app_name", "n"]


def mixed(spark, sf_dir):
    return filters.nonempty_message(parse.parse_syslog(log_lines(spark, derived(spark, sf_dir, "mixed"))))


@pytest.mark.parametrize("family", ["mem", "proc", "ubu", "mac"])
def test_counts_agree_with_each_other(spark, sf_dir, family):
    rows = severity.classified(mixed(spark, sf_dir), family)
    totals = {r.category: r.n for r in severity.severity_totals(rows).collect()}
    by_app = severity.severity_by_app(rows).groupBy("category").agg(F.sum("n").alias("n")).collect()
    assert {r.category: r.n for r in by_app} == {c: n for c, n in totals.items() if c != "success" and n}
    assert sum(totals.values()) == rows.count() == severity.raw_total(rows).first().total
    summary = severity.summarize(rows)
    for count in (severity.severity_by_app, severity.severity_totals, severity.analysis_summary, errors.error_types_by_app):
        assert compare.spark_rows(count(rows)) == compare.spark_rows(count(summary))


def test_a_wider_window_never_lowers_a_count(spark, sf_dir):
    rows = severity.with_category(mixed(spark, sf_dir), "ubu")
    before = None
    for start, end in (("12:00:00", "12:30:00"), ("10:00:00", "14:00:00"), ("00:00:00", "23:59:59")):
        one = severity.analysis_summary(filters.between_times(rows, start, end)).first()
        raw = [one.severe, one.mild, one.warning, one.success_count]
        assert before is None or all(a <= b for a, b in zip(before, raw))
        before = raw


def test_message_pool_reaches_every_rule(spark, sf_dir):
    """The derived lines hit each category and each error type, and near misses of them."""
    messages = spark.createDataFrame([(m,) for m in SYSLOG_MESSAGES], "message STRING")
    for family in ("mem", "proc", "ubu", "mac"):
        rows = severity.classified(messages, family)
        assert rows.select("category").distinct().count() == 4
        types = {t for r in rows.collect() for t in r.error_types}
        assert types == {name for group in errors_of(family) for name, _ in group}


def errors_of(family):
    from oslogs.functions.rules import ERROR_TYPE_WORDS
    return ERROR_TYPE_WORDS[family]
