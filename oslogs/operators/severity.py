"""Severity counts.

Every aggregate takes classified rows, or a summary of them (``summarize``) whose column ``n``
holds how many rows each line stands for; a report therefore reads the log once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import category, error_types
from ..functions.rules import CATEGORIES, SEVERITY_LABELS
from .once import with_once


def with_category(rows: DataFrame, family: str) -> DataFrame:
    """Rows with ``category``."""
    return with_once(rows, {"category": category(F.col("message"), family)})


def with_error_types(rows: DataFrame, family: str) -> DataFrame:
    """Rows with ``error_types``."""
    return with_once(rows, {"error_types": error_types(F.col("message"), family)})


def classified(rows: DataFrame, family: str) -> DataFrame:
    """Rows with ``category`` and ``error_types``."""
    message = F.col("message")
    return with_once(rows, {"category": category(message, family), "error_types": error_types(message, family)})


def distinct_messages(rows: DataFrame, by: tuple[str, ...] = ("log_date",)) -> DataFrame:
    """``app_name, message, n`` (and ``by``) of parsed rows: each different message once, with its number of rows.

    For logs that say the same things over and over: rules are then searched in each message once, not in each row. Equal
    rows are counted in every task before the one shuffle, so a message that fills a third of the log sends one row per
    task. A log whose messages all differ would be shuffled whole; classify its rows as they are.
    """
    by = tuple(c for c in by if c in rows.columns)
    return rows.groupBy(*by, "app_name", "message").agg(weight(rows).alias("n"))


def weight(rows: DataFrame) -> Column:
    """Number of log rows in a group."""
    return F.coalesce(F.sum("n"), F.lit(0)).cast("long") if "n" in rows.columns else F.count(F.lit(1))


def weight_where(rows: DataFrame, condition: Column) -> Column:
    """Number of log rows in a group that meet the condition."""
    if "n" in rows.columns:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return F.count_if(condition)


def summarize(rows: DataFrame) -> DataFrame:
    """``category, app_name, error_types, n``: all that the severity and error reports need, also of other summaries.

    One shuffle, on partial counts; a chatty application costs one row per task.
    """
    return rows.groupBy("category", "app_name", "error_types").agg(weight(rows).alias("n"))


def severity_by_app(rows: DataFrame) -> DataFrame:
    """Errors and warnings per application; successes are not kept per application."""
    return rows.where(F.col("category") != "success").groupBy("category", "app_name").agg(weight(rows).alias("n"))


def severity_totals(rows: DataFrame) -> DataFrame:
    """Total per category, every category present."""
    counts = [weight_where(rows, F.col("category") == name).alias(name) for name in CATEGORIES]
    pairs = [F.struct(F.lit(name).alias("category"), F.col(name).alias("n")) for name in CATEGORIES]
    return rows.agg(*counts).select(F.inline(F.array(*pairs)))


def _summary_columns(rows: DataFrame) -> DataFrame:
    names = {"severe": "severe_error", "mild": "mild_error", "warning": "warning", "success_count": "success"}
    return rows.agg(*(weight_where(rows, F.col("category") == value).alias(name) for name, value in names.items()))


def analysis_summary(rows: DataFrame) -> DataFrame:
    """One row: severe, mild, warning, success_count, net_success (may be negative) and total."""
    errors = F.col("severe") + F.col("mild") + F.col("warning")
    return _summary_columns(rows).select(
        "severe", "mild", "warning", "success_count",
        (F.col("success_count") - errors).alias("net_success"),
        (F.col("success_count") + errors).alias("total"),
    )


def net_success(rows: DataFrame) -> DataFrame:
    """Successes less all errors and warnings, the figure the syslog reports print."""
    return analysis_summary(rows).select("success_count", "net_success")


def raw_total(rows: DataFrame) -> DataFrame:
    """All classified rows, the total the Windows reports print."""
    return analysis_summary(rows).select("total")


def ranked_apps(rows: DataFrame) -> DataFrame:
    """``severity_by_app`` in report order: per category, applications by falling count."""
    return severity_by_app(rows).orderBy(_position(F.col("category")), F.desc("n"), "app_name")


def severity_report(rows: DataFrame) -> DataFrame:
    """The severe, mild and warning tables stacked under one header."""
    label = F
    for name, text in SEVERITY_LABELS.items():
        label = label.when(F.col("category") == name, F.lit(text))
    return ranked_apps(rows).select(label.alias("error_type"), "app_name", "n")


def _position(column: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CATEGORIES)), column)
