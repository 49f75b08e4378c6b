"""Key/value captures inside messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import HRESULT_NAMES


def _value_of(message: Column, key: str) -> Column:
    return F.regexp_extract(message, key + "=([^ ]+)", 1)


def _without_closing(value: Column) -> Column:
    return F.regexp_replace(value, r"\]+\z", "")


def auth_failure_fields(message: Column, missing: str | None = "N/A") -> dict[str, Column]:
    """``logname`` (``missing`` where empty) and ``user``; ``ruser=`` is a different key."""
    logname = _value_of(message, "logname")
    if missing is not None:
        logname = F.coalesce(F.nullif(logname, F.lit("")), F.lit(missing))
    return {"logname": logname, "user": _value_of(message, r"\buser")}


def sudo_fields(message: Column, strip: bool = True) -> dict[str, Column]:
    """``sudo_user``, ``pwd`` and ``command`` (its first word)."""
    user, command = _value_of(message, "USER"), _value_of(message, "COMMAND")
    if strip:
        user, command = _without_closing(user), _without_closing(command)
    return {"sudo_user": user, "pwd": _value_of(message, "PWD"), "command": command}


def hresult_code(message: Column) -> Column:
    """Text after ``HRESULT =`` up to the closing bracket, '' where there is none."""
    return F.regexp_extract(message, r"HRESULT\s*=\s*([^\]]+)", 1)


def hresult_label(text: Column) -> Column:
    """Drop everything up to the last `` - ``."""
    return F.regexp_replace(text, "^.* - ", "")


def hresult_name(code: Column) -> Column:
    """Known codes become ``code - NAME``; other texts stay as they are."""
    known = F
    for value, name in HRESULT_NAMES:
        known = known.when(code == value, F.lit(f"{value} - {name}"))
    return known.otherwise(code)
