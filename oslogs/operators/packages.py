"""Package reports and Windows security actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import PACKAGE_ACTIONS
from .filters import package_actions_only
from .severity import weight, weight_where


def latest_package_action(rows: DataFrame, order: str = "line_no") -> DataFrame:
    """Per date, time and package the last action in log order.

    For the ``line_no`` of ``log_lines`` the log passes two hash aggregates. The first keeps, per key, file and block, the
    action of the highest position, a number; as one task reads a block, it leaves one row per key and block before any
    shuffle. Only these few rows are then ordered by file (its last change first with ``newest_last``, then its name), block
    and position, so files that changed at the same time follow each other by name. A key that fills a third of the log
    sends one row per block. For any other sortable ``order`` column ``max_by`` does it in one step.
    """
    kept = package_actions_only(rows)
    key = ("log_date", "log_time", "package")
    names = getattr(rows.schema[order].dataType, "names", ())
    if names[-3:] != ["file", "block", "position"]:
        return kept.groupBy(*key).agg(F.max_by("action", order).alias("action"))
    actions = F.array(*map(F.lit, PACKAGE_ACTIONS))
    parts = [F.col(order)[name].alias(f"order_{name}") for name in names]
    number = F.array_position(actions, F.col("action")).cast("int").alias("number")
    block = [f"order_{name}" for name in names[:-1]]
    position = F.col("order_position")
    in_block = kept.select(*key, *parts, number).groupBy(*key, *block).agg(
        F.max_by("number", position).alias("number"), F.max(position).alias("order_position"))
    last = in_block.groupBy(*key).agg(F.max_by("number", F.struct(*block, "order_position")).alias("number"))
    return last.select(*key, F.element_at(actions, F.col("number")).alias("action"))


def package_report(latest: DataFrame) -> DataFrame:
    """Report rows: date, time, package, action."""
    return latest.select("log_date", "log_time", "package", "action")


def package_action_counts(latest: DataFrame) -> DataFrame:
    """Actions that occur, with their counts."""
    return latest.groupBy("action").agg(weight(latest).alias("n"))


def package_action_totals(latest: DataFrame) -> DataFrame:
    """One row: the largest count of an action (at least 1) and the total of all."""
    counts = package_action_counts(latest)
    return counts.agg(
        F.greatest(F.coalesce(F.max("n"), F.lit(1)), F.lit(1)).cast("long").alias("max_n"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
    )


def package_actions_filled(latest: DataFrame) -> DataFrame:
    """The five actions in their fixed order, 0 where absent."""
    counts = [weight_where(latest, F.col("action") == action).alias(action) for action in PACKAGE_ACTIONS]
    pairs = [F.struct(F.lit(a).alias("action"), F.col(a).alias("n")) for a in PACKAGE_ACTIONS]
    return latest.agg(*counts).select(F.inline(F.array(*pairs)))


def nonzero_guard(counts: DataFrame, ignore: tuple[str, ...] = (), label: str = "category", n: str = "count") -> DataFrame:
    """The count table, or no rows when its counts sum to 0; ``ignore`` leaves labels out of the sum."""
    total = counts.where(~F.col(label).isin(*ignore)) if ignore else counts
    return counts.where(total.agg(F.coalesce(F.sum(n), F.lit(0)) != 0).scalar())


def security_actions(rows: DataFrame) -> DataFrame:
    """Security log rows per action."""
    return rows.groupBy("action").agg(weight(rows).alias("n"))
