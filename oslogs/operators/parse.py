"""Log lines (``value``) to typed rows.

Parsed rows carry the input's ``source_file`` and ``line_no`` where present, plus
``kind, style, log_date, log_month, log_day, log_time, app_name, message`` and the family's own columns.
``log_date`` is NULL for year-less lines unless a year is supplied; ``log_month`` and ``log_day`` never are.

Lines are cut up in two steps, days first, so that a filter on days runs before the costly cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_style, day_first_date, file_year, iso_date, month_number
from ..functions.extract import auth_failure_fields, sudo_fields
from .once import with_once

Year = int | str | None  # a year, "modified" (from the file's last change), or not known

# --- Fixed values: the form of a component-servicing line ---------------------
CBS_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\s+[0-9]{2}:[0-9]{2}:[0-9]{2},\s+[A-Za-z]+\s+[A-Za-z0-9_]+\s+"
)


def _word(n: int, until: str = "") -> Column:
    """The n-th (from 0) blank-separated word of the line, cut at a mark; '' past the end."""
    return F.regexp_extract(F.col("value"), r"^\s*(?:\S+\s+){%d}([^\s%s]*)" % (n, until), 1)


def _iso_clock() -> Column:
    """Eight characters after the first ``T`` (not past a second one)."""
    at = F.instr(F.col("value"), "T")
    return F.when(at > 0, F.substring_index(F.substr(F.col("value"), at + 1, F.lit(8)), "T", 1)).otherwise("")


def _tail() -> Column:
    """Text between the first and the second ``]: ``, '' without one."""
    head = F.substring_index(F.col("value"), "]: ", 2)
    return F.when(F.col("value").contains("]: "), F.trim(F.substring_index(head, "]: ", -1))).otherwise("")


def _after_two_colons() -> Column:
    """Text after the line's second colon; a line without any colon passes whole."""
    rest = F.substr(F.col("value"), F.length(F.substring_index(F.col("value"), ":", 2)) + 2)
    return F.trim(F.when(F.col("value").contains(":"), rest).otherwise(F.col("value")))


def _iso_days(date: Column) -> dict[str, Column]:
    log_date = iso_date(date)
    return {"log_date": log_date, "log_month": F.month(log_date), "log_day": F.dayofmonth(log_date)}


def _iso_fields(layout: str) -> dict[str, Column]:
    """``layout`` is syslog, auth (the message is the whole line) or auth_tail."""
    if layout == "syslog":
        app = F.regexp_extract(F.col("value"), r"^[^\s\[]*[\s\[][^\s\[]*[\s\[]([^\s\[]*)", 1)
    else:
        app = F.regexp_replace(_word(2, r"\["), r":\z", "")
    return {"log_time": _iso_clock(), "app_name": app, "message": F.col("value") if layout == "auth" else _tail()}


def _bsd_days(year: Year) -> dict[str, Column]:
    month = month_number(F.substring(F.col("value"), 1, 3))
    day = F.regexp_extract(F.col("value"), r"^[A-Za-z]{3}\s+([0-9]{1,2})", 1).try_cast("int")
    if year is None:
        log_date = F.lit(None).cast("date")
    else:
        in_year = file_year(F.col("modified"), month, day) if year == "modified" else F.lit(year)
        log_date = F.concat_ws("-", in_year.cast("string"), month.cast("string"), day.cast("string")).try_cast("date")
    return {"log_date": log_date, "log_month": month, "log_day": day}


def _bsd_fields() -> dict[str, Column]:
    """The message starts after the line's second colon, that is inside the clock."""
    app = F.regexp_replace(_word(4, r"\["), r"\]?:?\z", "")
    return {"log_time": _word(2), "app_name": app, "message": _after_two_colons()}


def _by_style(iso: dict[str, Column], bsd: dict[str, Column]) -> dict[str, Column]:
    return {name: F.when(F.col("style") == "iso", iso[name]).otherwise(bsd[name]) for name in iso}


def _cut(lines: DataFrame, kind: str, days: dict[str, Column], fields: dict[str, Column], once: str) -> DataFrame:
    """Lines with their days, then with their fields.

    The field ``once`` is the one that rules search many times. The others are cheap and stay
    projections, so that they cost nothing where they are not used and filters on them run first.
    """
    dated = with_once(lines, days).where(F.col("log_month").isNotNull() & F.col("log_day").isNotNull())
    cut = with_once(dated, {once: fields[once]})
    others = {"kind": F.lit(kind), **{name: column for name, column in fields.items() if name != once}}
    return _with(cut, others, drop=("value",))


def _with(rows: DataFrame, columns: dict[str, Column], drop: tuple[str, ...]) -> DataFrame:
    """Adds (or replaces) and drops columns in one projection."""
    kept = [c for c in rows.columns if c not in columns and c not in drop]
    return rows.select(*kept, *(column.alias(name) for name, column in columns.items()))


def detect_date_style(lines: DataFrame) -> DataFrame:
    """The lines with their ``style``: 'bsd', 'iso' or NULL (unsupported)."""
    return with_once(lines, {"style": date_style(F.col("value"))})


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that parsing drops: of unknown date style, or of a month or day that does not exist."""
    days = _by_style(_iso_days(F.substring(F.col("value"), 1, 10)), _bsd_days(None))
    dated = with_once(detect_date_style(lines), {"dated": days["log_month"].isNotNull() & days["log_day"].isNotNull()})
    return dated.where(F.col("style").isNull() | ~F.col("dated")).drop("style", "dated")


def parse_iso_syslog(lines: DataFrame, kind: str = "mem") -> DataFrame:
    """ISO syslog lines; the date may stand anywhere in the line."""
    found = F.regexp_extract(F.col("value"), "[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)
    return _cut(lines.withColumn("style", F.lit("iso")), kind, _iso_days(found), _iso_fields("syslog"), "message")


def parse_bsd_syslog(lines: DataFrame, kind: str = "mem", year: Year = None) -> DataFrame:
    """``Mon d HH:MM:SS host app[pid]: message`` lines; other lines are dropped."""
    return _cut(lines.withColumn("style", F.lit("bsd")), kind, _bsd_days(year), _bsd_fields(), "message")


def parse_iso_auth(lines: DataFrame, message: str = "line") -> DataFrame:
    """ISO authentication lines; the message is the whole line, or with 'tail' the text after ``]: ``."""
    found = F.regexp_extract(F.col("value"), "[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)
    layout = {"line": "auth", "tail": "auth_tail"}[message]
    return _cut(lines.withColumn("style", F.lit("iso")), "auth", _iso_days(found), _iso_fields(layout), "message")


def parse_iso_auth_tail(lines: DataFrame) -> DataFrame:
    """``parse_iso_auth`` with the text after ``]: `` as message."""
    return parse_iso_auth(lines, "tail")


def parse_syslog(lines: DataFrame, kind: str = "mem", year: Year = None, layout: str = "syslog") -> DataFrame:
    """Lines of either date style, decided per line in one pass; lines of unknown style are dropped."""
    days = _by_style(_iso_days(F.substring(F.col("value"), 1, 10)), _bsd_days(year))
    styled = detect_date_style(lines).where(F.col("style").isNotNull())
    return _cut(styled, kind, days, _by_style(_iso_fields(layout), _bsd_fields()), "message")


def parse_dpkg(lines: DataFrame, year: Year = None) -> DataFrame:
    """Package log lines: ``log_date, log_time, action, package, version`` by position after the stamp."""
    days = _by_style(_iso_days(F.substring(F.col("value"), 1, 10)), _bsd_days(year))
    words, names = F.col("words"), ("log_time", "action", "package", "version")
    at = F.when(F.col("style") == "bsd", 1).otherwise(0)
    fields = {name: F.coalesce(F.get(words, at + i), F.lit("")) for i, name in enumerate(names, start=1)}
    styled = detect_date_style(lines).where(F.col("style").isNotNull())
    cut = _cut(styled, "dpkg", days, {"words": F.split(F.trim(F.col("value")), r"\s+")}, "words")
    return _with(cut, fields, drop=("words",))


def parse_cbs(lines: DataFrame) -> DataFrame:
    """``date time, Level App message`` lines; lines of another form are dropped."""
    matching = lines.where(F.col("value").rlike(CBS_PATTERN)).withColumns(
        {"kind": F.lit("cbs"), "style": F.lit("iso"), "log_date": iso_date(F.substring(F.col("value"), 1, 10))}
    )
    words = F.col("words")
    fields = {
        "log_time": F.substring(F.get(words, F.lit(1)), 1, 8),
        "level": F.get(words, F.lit(2)),
        "app_name": F.get(words, F.lit(3)),
        "message": F.get(words, F.lit(4)),
    }
    cut = with_once(matching, {"words": F.split(F.col("value"), r"\s+", 5)}, drop=("value",))
    return _with(cut, fields, drop=("words",))


def _split_stamp() -> tuple[Column, Column]:
    """Day and clock of ``dd-mm-yyyy HH:MM:SS``, cut at the first blank."""
    stamp = F.trim("date_time")
    day = F.substring_index(stamp, " ", 1)
    return day_first_date(day), F.trim(F.substr(stamp, F.length(day) + 1))


def parse_windows_system(rows: DataFrame) -> DataFrame:
    """System export rows with ``log_date``, ``log_time`` and the source as ``app_name``."""
    log_date, log_time = _split_stamp()
    named = rows.withColumnRenamed("source", "app_name").withColumns({"kind": F.lit("wsys"), "style": F.lit("iso")})
    return with_once(named, {"log_date": log_date, "log_time": log_time}, drop=("date_time",))


def parse_windows_security(rows: DataFrame) -> DataFrame:
    """Security export rows with ``log_date``, ``log_time`` and ``action``."""
    log_date, log_time = _split_stamp()
    named = rows.withColumns({"kind": F.lit("wsec"), "style": F.lit("iso")})
    clock = F.substring_index(log_time, " ", 1)
    return with_once(named, {"log_date": log_date, "log_time": clock}, drop=("date_time",))


def extract_auth_failure(rows: DataFrame, missing: str | None = "N/A") -> DataFrame:
    """Adds ``logname`` and ``user`` from the message."""
    return rows.withColumns(auth_failure_fields(F.col("message"), missing))


def extract_sudo(rows: DataFrame, strip: bool = True) -> DataFrame:
    """Adds ``sudo_user``, ``pwd`` and ``command`` from the message."""
    return rows.withColumns(sudo_fields(F.col("message"), strip))
