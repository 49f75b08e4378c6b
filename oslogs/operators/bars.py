"""Lengths of the bars that the text reports draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import PACKAGE_ACTIONS
from .severity import weight_where

# --- Fixed values: drawing rules per family -----------------------------------
# width of the longest bar; leading unit of error bars and of the success bar;
# shortest bar; longest success bar
BAR_STYLES: dict[str, dict[str, int | None]] = {
    "mem": {"width": 120, "lead": 1, "success_lead": 1, "least": 0, "success_most": 100},
    "mac": {"width": 120, "lead": 1, "success_lead": 0, "least": 0, "success_most": 100},
    "sol": {"width": 120, "lead": 1, "success_lead": 0, "least": 0, "success_most": 100},
    "proc": {"width": 120, "lead": 0, "success_lead": 0, "least": 1, "success_most": 100},
    "ubu": {"width": 120, "lead": 0, "success_lead": 0, "least": 1, "success_most": None},
    "cbs": {"width": 50, "lead": 0, "success_lead": 0, "least": 0, "success_most": 100},
    "wsys": {"width": 50, "lead": 0, "success_lead": 0, "least": 0, "success_most": 100},
}


def scaled(n: Column, largest: Column, width: int) -> Column:
    """Bar length of ``n``; the wide style truncates the ratio to two decimals first."""
    if width == 120:
        ratio = F.floor(F.lit(100) * n / largest)
        return F.floor(ratio * 120 / 100)
    return F.floor(n * width / largest)


def severity_bars(summary: DataFrame, family: str) -> DataFrame:
    """``category, n, bar_len`` of the four totals in an ``analysis_summary`` row.

    The wide style draws the net successes, the narrow one the raw ones. Where the shortest bar has one unit, four
    zeros draw nothing at all.
    """
    style = BAR_STYLES[family]
    success = "net_success" if style["width"] == 120 else "success_count"
    totals = {"severe_error": "severe", "mild_error": "mild", "warning": "warning", "success": success}
    largest = F.greatest(*totals.values(), F.lit(1))
    bars = []
    for name, column in totals.items():
        length = F.greatest(scaled(F.col(column), largest, style["width"]), F.lit(style["least"]))
        if name == "success" and style["success_most"]:
            length = F.least(length, F.lit(style["success_most"]))
        lead = style["success_lead"] if name == "success" else style["lead"]
        bars.append(F.struct(
            F.lit(name).alias("category"), F.col(column).cast("long").alias("n"),
            (length + lead).cast("long").alias("bar_len"),
        ))
    if style["least"]:
        summary = summary.where(F.greatest(*totals.values()) > 0)
    return summary.select(F.inline(F.array(*bars)))


def _narrow(names: tuple[str, ...], label: str, at_least_one: bool) -> Column:
    """Rows ``label, n, bar_len`` (up to 50) of one row's named counts."""
    largest, bars = F.greatest(*names, F.lit(1)), []
    for name in names:
        length = scaled(F.col(name), largest, 50)
        if at_least_one:
            length = F.when(F.col(name) > 0, F.greatest(length, F.lit(1))).otherwise(length)
        bars.append(F.struct(
            F.lit(name).alias(label), F.col(name).alias("n"), length.cast("long").alias("bar_len")
        ))
    return F.inline(F.array(*bars))


def auth_bars(summary: DataFrame) -> DataFrame:
    """``category, n, bar_len`` of an ``auth_summary`` row; a positive count has a bar."""
    return summary.select(
        _narrow(("auth_failures", "sudo_commands", "sessions", "other_events"), "category", at_least_one=True)
    )


def package_bars(latest: DataFrame) -> DataFrame:
    """``action, n, bar_len`` of the package actions that occur."""
    counts = [weight_where(latest, F.col("action") == action).alias(action) for action in PACKAGE_ACTIONS]
    return latest.agg(*counts).select(_narrow(PACKAGE_ACTIONS, "action", at_least_one=False)).where("n > 0")
