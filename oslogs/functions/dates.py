"""Date styles, date normalisation and parameter checks."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import MONTHS

# --- Fixed values: how lines of either style begin ----------------------------
BSD_PATTERN = r"^[A-Za-z]{3}\s+[0-9]{1,2}"
ISO_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_TIME = re.compile(r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d")


def date_style(value: Column) -> Column:
    """'bsd' (``Mon d``), 'iso' (``yyyy-mm-dd``) or NULL, decided per line."""
    return F.when(value.rlike(BSD_PATTERN), F.lit("bsd")).when(value.rlike(ISO_PATTERN), F.lit("iso"))


def iso_date(text: Column) -> Column:
    """DATE of a ``yyyy-mm-dd`` text, NULL where no such day exists."""
    return text.try_cast("date")


def day_first_date(text: Column) -> Column:
    """DATE of a ``dd-mm-yyyy`` text; other layouts give NULL."""
    turned = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.when(text.rlike(r"^[0-9]{2}-[0-9]{2}-[0-9]{4}\z"), turned.try_cast("date"))


def normalise_date(text: Column) -> Column:
    """DATE of either ``yyyy-mm-dd`` or ``dd-mm-yyyy``."""
    return F.when(text.rlike(ISO_PATTERN + r"\z"), iso_date(text)).otherwise(day_first_date(text))


def month_number(name: Column) -> Column:
    """1-12 for an English three-letter month name, NULL otherwise."""
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("int"), F.lit(0))


def file_year(modified: Column, month: Column, day: Column) -> Column:
    """Year of a year-less log date: the latest one in which it is not after the file's last change."""
    later = month * 100 + day > F.month(modified) * 100 + F.dayofmonth(modified)
    return F.year(modified) - F.when(later, 1).otherwise(0)


def as_date(text: str | dt.date) -> dt.date:
    """A query parameter as a date: ``yyyy-mm-dd`` or ``dd-mm-yyyy``."""
    if isinstance(text, dt.date):
        return text
    if re.fullmatch(r"\d{2}-\d{2}-\d{4}", text):
        return dt.datetime.strptime(text, "%d-%m-%Y").date()
    if _DATE.fullmatch(text):
        return dt.date.fromisoformat(text)
    raise ValueError(f"not a date (YYYY-MM-DD): {text!r}")


def as_time(text: str) -> str:
    """A query parameter as ``HH:MM:SS``."""
    if not _TIME.fullmatch(text):
        raise ValueError(f"not a time (HH:MM:SS): {text!r}")
    return text


def check_recent(date: str | dt.date, as_of: str | dt.date, days: int = 7) -> dt.date:
    """The date itself when it lies within the last ``days`` days up to ``as_of``."""
    day, today = as_date(date), as_date(as_of)
    if not today - dt.timedelta(days=days) <= day <= today:
        raise ValueError(f"{day} is outside the last {days} days before {today}")
    return day
