"""Row filters: days, times, ranges and well-formedness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import contains_any
from ..functions.dates import as_date, as_time
from ..functions.rules import MONTHS, PACKAGE_ACTIONS
from ..session import checkpointed
from .lookup import with_file_facts

Day = str | dt.date


def on_date(rows: DataFrame, date: Day) -> DataFrame:
    """Rows of one calendar day."""
    return rows.where(F.col("log_date") == F.lit(as_date(date)))


def on_bsd_date(rows: DataFrame, date: Day) -> DataFrame:
    """Year-less rows of one month and day, compared as numbers."""
    day = as_date(date)
    return rows.where((F.col("style") == "bsd") & _same_day(day))


def _same_day(day: dt.date) -> Column:
    return (F.col("log_month") == day.month) & (F.col("log_day") == day.day)


def on_day(rows: DataFrame, date: Day) -> DataFrame:
    """Rows of one day: by date where the year is known, else by month and day."""
    day, log_date = as_date(date), F.col("log_date")
    if "log_month" not in rows.columns:
        return rows.where(log_date == F.lit(day))
    return rows.where((log_date == F.lit(day)) | (log_date.isNull() & _same_day(day)))


def between_times(rows: DataFrame, start: str, end: str, bsd_time_filter: bool = True) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; optionally leaving year-less rows untouched."""
    inside = F.col("log_time").between(as_time(start), as_time(end))
    return rows.where(inside if bsd_time_filter else inside | (F.col("style") == "bsd"))


def between_instants(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows between two instants ``yyyy-mm-dd HH:MM:SS``, both included.

    The test on ``log_date`` repeats the outer days so that a date-partitioned table is pruned.
    """
    first, last = (dt.datetime.fromisoformat(text) for text in (start, end))
    instant = F.concat_ws(" ", F.col("log_date").cast("string"), "log_time").try_cast("timestamp_ntz")
    return rows.where(
        F.col("log_date").between(F.lit(first.date()), F.lit(last.date()))
        & instant.between(F.lit(str(first)).cast("timestamp_ntz"), F.lit(str(last)).cast("timestamp_ntz"))
    )


def date_range(rows: DataFrame, first: Day, last: Day, inclusive: str = "both") -> DataFrame:
    """Rows of a range of days; ``inclusive='neither'`` leaves out both outer days of dated rows.

    Year-less rows are compared by month and day, always with both outer days; a range over the
    turn of the year wraps.
    """
    if inclusive not in ("both", "neither"):
        raise ValueError("inclusive must be 'both' or 'neither'")
    d0, d1, log_date = as_date(first), as_date(last), F.col("log_date")
    if inclusive == "both":
        dated = log_date.between(F.lit(d0), F.lit(d1))
    else:
        dated = (log_date > F.lit(d0)) & (log_date < F.lit(d1))
    if "log_month" not in rows.columns:
        return rows.where(dated)
    if (d1 - d0).days >= 366:
        yearless = F.lit(True)
    else:
        key, k0, k1 = F.col("log_month") * 100 + F.col("log_day"), d0.month * 100 + d0.day, d1.month * 100 + d1.day
        wraps = d1.year > d0.year
        yearless = (key >= k0) | (key <= k1) if wraps else (key >= k0) & (key <= k1)
    return rows.where(dated | (log_date.isNull() & yearless))


def prefix_stop(rows: DataFrame, late: Column, per_file: bool = False) -> DataFrame:
    """Rows before the first late one, in ``line_no`` order: the early stop of a reader of sorted logs.

    The first late position is found with a partial aggregate: one scalar, or with ``per_file`` one row per file, which the
    lines look up (``with_file_facts``), so the log itself is not shuffled.
    """
    if not per_file:
        stop = rows.agg(F.min(F.when(late, F.col("line_no"))).alias("stop")).scalar()
        return rows.where(stop.isNull() | (F.col("line_no") < stop))
    block, position = F.col("line_no.block"), F.col("line_no.position")
    blocks = rows.groupBy("source_file", block.alias("block")).agg(F.min(F.when(late, position)).alias("position"))
    first = F.min(F.when(F.col("position").isNotNull(), F.struct("block", "position")))
    stops = checkpointed(blocks.groupBy("source_file").agg(first.alias("stop"), F.max("block").alias("last_byte")))
    marked = with_file_facts(rows, stops.where(F.col("stop").isNotNull()), block)
    before = F.struct(block.alias("block"), position.alias("position")) < F.col("stop")
    return marked.where(F.col("stop").isNull() | before).drop("stop").select(*rows.columns)


def late_for(date: Day, end: str) -> Column:
    """True for rows after the day, or on it after the end time."""
    day = F.lit(as_date(date))
    return (F.col("log_date") > day) | ((F.col("log_date") == day) & (F.col("log_time") > as_time(end)))


def nonempty_message(rows: DataFrame) -> DataFrame:
    """Rows that have a message."""
    return rows.where(F.col("message") != "")


def well_formed_windows(lines: DataFrame) -> DataFrame:
    """Tab-separated lines of at least five fields, not all blank."""
    tabs = F.length("value") - F.length(F.translate("value", "\t", ""))
    return lines.where((tabs >= 4) & (F.translate("value", "\t ", "") != ""))


def package_actions_only(rows: DataFrame) -> DataFrame:
    """Rows whose action is one of the five package actions."""
    return rows.where(F.col("action").isin(*PACKAGE_ACTIONS))


def recent_days(rows: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``."""
    today = as_date(as_of)
    return rows.where(F.col("log_date").between(F.lit(today - dt.timedelta(days=days)), F.lit(today)))


def metric_rows(rows: DataFrame, column: str = "value") -> DataFrame:
    """Rows that name memory, disk or swap usage."""
    return rows.where(F.col(column).rlike("Memory Usage|Disk Usage|Swap Usage"))


def data_rows_only(lines: DataFrame) -> DataFrame:
    """Lines that start with a digit."""
    return lines.where(F.col("value").rlike("^[0-9]"))


def raw_days(first: Day, last: Day) -> Column:
    """A cheap test on unparsed lines for a range of days, applied before any field is cut out.

    It never drops a line the parsed filters would keep: ISO stamps compare as text, year-less
    ones by their month name.
    """
    d0, d1 = as_date(first), as_date(last)
    months, month = [], d0.replace(day=1)
    while month <= d1 and len(months) < 12:
        months.append(MONTHS[month.month - 1])
        month = (month + dt.timedelta(days=31)).replace(day=1)
    value = F.col("value")
    return F.substring(value, 1, 10).between(str(d0), str(d1)) | F.substring(value, 1, 3).isin(*months)


def raw_windows_days(first: Day, last: Day) -> Column:
    """The same for tab-separated Windows lines: one of the days, or a header.

    A long range is tested by its months, a very long one by its years.
    """
    d0, d1 = as_date(first), as_date(last)
    days = (d0 + dt.timedelta(days=i) for i in range((d1 - d0).days + 1))
    form = "%d-%m-%Y" if (d1 - d0).days <= 31 else "-%m-%Y" if (d1 - d0).days <= 732 else "-%Y"
    return contains_any(F.col("value"), ("Date and Time", *dict.fromkeys(day.strftime(form) for day in days)))


def in_window(
    rows: DataFrame, date: Day, start: str, end: str, last: Day | None = None,
    inclusive: str = "both", bsd_time_filter: bool = True,
) -> DataFrame:
    """The day (or range of days up to ``last``) and time window of a report."""
    days = on_day(rows, date) if last is None else date_range(rows, date, last, inclusive)
    return between_times(days, start, end, bsd_time_filter)
