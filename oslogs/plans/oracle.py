"""DuckDB SQL for the same questions, written from the log formats rather than from the Spark code."""

from __future__ import annotations

from ..functions.rules import (
    AUTH_WORDS, CATEGORIES, ERROR_TABLE, ERROR_TYPE_WORDS, HRESULT_NAMES, MONTHS, PACKAGE_ACTIONS, SEVERITY_WORDS,
)
from .derived import SYSTEM_HEADER, lines_sql

DATE_RE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_MONTHS = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"


def _alternation(words) -> str:
    return "(" + "|".join(words) + ")"


def category(family: str, column: str = "message") -> str:
    whens = " ".join(
        f"when regexp_matches({column}, '{_alternation(words)}') then '{name}'"
        for name, words in SEVERITY_WORDS[family].items()
    )
    return f"case {whens} else 'success' end"


def types(family: str, column: str = "message") -> str:
    """List of error types."""
    groups = []
    for group in ERROR_TYPE_WORDS[family]:
        whens = " ".join(
            f"when regexp_matches({column}, '{_alternation(words)}') then '{name}'" for name, words in group
        )
        groups.append(f"case {whens} end")
    return f"[x for x in [{', '.join(groups)}] if x is not null]"


def auth_kind(column: str = "message") -> str:
    whens = " ".join(f"when contains({column}, '{word}') then '{kind}'" for kind, word in AUTH_WORDS)
    return f"case {whens} else 'other' end"


_ISO = f"""
    try_cast(regexp_extract(value, '{DATE_RE}') as date) as log_date,
    substr(split_part(split_part(value, 'T', 2), '.', 1), 1, 8) as log_time,
    coalesce(regexp_split_to_array(value, '[\\s\\[]')[3], '') as app_name,
    trim(split_part(value, ']: ', 2), ' ') as message"""
_BSD_MONTH = f"list_position({_MONTHS}, substr(value, 1, 3))"
_BSD_DAY = "cast(regexp_extract(value, '^[A-Za-z]{3}\\s+([0-9]{1,2})', 1) as int)"
_BSD_TIME = "coalesce(regexp_split_to_array(trim(value), '\\s+')[3], '')"
_BSD_APP = (
    "regexp_replace(regexp_replace(split_part(coalesce(regexp_split_to_array(trim(value), '\\s+')[5], ''), "
    "'[', 1), ':$', ''), '\\]$', '')"
)
_BSD_MESSAGE = (
    "trim(case when not contains(value, ':') then value when regexp_matches(value, '^[^:]*:[^:]*:') "
    "then regexp_replace(value, '^[^:]*:[^:]*:', '') else '' end, ' ')"
)


def iso_rows() -> str:
    return f"select event_id, {_ISO} from ({lines_sql('iso')}) where regexp_matches(value, '{DATE_RE}')"


def bsd_rows(kind: str = "bsd") -> str:
    return (
        f"select event_id, cast({_BSD_MONTH} as int) as log_month, {_BSD_DAY} as log_day, {_BSD_TIME} as log_time, "
        f"{_BSD_APP} as app_name, {_BSD_MESSAGE} as message from ({lines_sql(kind)}) "
        "where regexp_matches(value, '^[A-Za-z]{3}\\s+[0-9]{1,2}')"
    )


def mixed_rows() -> str:
    """Rows of the mixed log, each line by its own style, messages not empty."""
    lines = f"({lines_sql('mixed')})"
    iso = (
        f"select event_id, 'iso' as style, log_date, cast(month(log_date) as int) as log_month, "
        f"cast(day(log_date) as int) as log_day, log_time, app_name, message from "
        f"(select event_id, {_ISO} from {lines} where regexp_matches(value, '^{DATE_RE}')) where log_date is not null"
    )
    bsd = (
        f"select event_id, 'bsd' as style, cast(null as date) as log_date, cast({_BSD_MONTH} as int) as log_month, "
        f"{_BSD_DAY} as log_day, {_BSD_TIME} as log_time, {_BSD_APP} as app_name, {_BSD_MESSAGE} as message "
        f"from {lines} where regexp_matches(value, '^[A-Za-z]{{3}}\\s+[0-9]{{1,2}}') and {_BSD_MONTH} > 0"
    )
    return f"select * from (({iso}) union all ({bsd})) where message <> ''"


def mixed_ids() -> str:
    """Numbers of the mixed log's lines that have a date."""
    iso = f"regexp_matches(value, '^{DATE_RE}') and try_cast(substr(value, 1, 10) as date) is not null"
    bsd = f"regexp_matches(value, '^[A-Za-z]{{3}}\\s+[0-9]{{1,2}}') and {_BSD_MONTH} > 0"
    return f"select event_id from ({lines_sql('mixed')}) where ({iso}) or ({bsd})"


def auth_rows(tail: bool = False) -> str:
    message = "trim(split_part(value, ']: ', 2), ' ')" if tail else "value"
    rows = (
        f"select event_id, try_cast(regexp_extract(value, '{DATE_RE}') as date) as log_date, "
        "substr(split_part(split_part(value, 'T', 2), '.', 1), 1, 8) as log_time, "
        "regexp_replace(split_part(coalesce(regexp_split_to_array(trim(value), '\\s+')[3], ''), '[', 1), ':$', '') "
        f"as app_name, {message} as message from ({lines_sql('auth')})"
    )
    return f"select *, {auth_kind()} as event from ({rows})"


def dpkg_rows() -> str:
    word = lambda n: f"coalesce(regexp_split_to_array(value, '\\s+')[{n}], '')"
    return (
        f"select event_id, try_cast({word(1)} as date) as log_date, {word(2)} as log_time, {word(3)} as action, "
        f"{word(4)} as package, {word(5)} as version from ({lines_sql('dpkg')})"
    )


def latest_actions() -> str:
    actions = ", ".join(f"'{a}'" for a in PACKAGE_ACTIONS)
    return (
        "select log_date, log_time, package, action from (select *, row_number() over "
        "(partition by log_date, log_time, package order by event_id desc) as rn "
        f"from ({dpkg_rows()}) where action in ({actions})) where rn = 1"
    )


def cbs_rows() -> str:
    pattern = "^([0-9]{4}-[0-9]{2}-[0-9]{2})\\s+([0-9]{2}:[0-9]{2}:[0-9]{2}),\\s+([A-Za-z]+)\\s+([A-Za-z0-9_]+)\\s+(.*)$"
    part = lambda n: f"regexp_extract(value, '{pattern}', {n})"
    return (
        f"select event_id, try_cast({part(1)} as date) as log_date, {part(2)} as log_time, {part(3)} as level, "
        f"{part(4)} as app_name, {part(5)} as message from ({lines_sql('cbs')}) where regexp_matches(value, '{pattern}')"
    )


def _fields(kind: str) -> str:
    return f"select event_id, string_split(value, chr(9)) as f from ({lines_sql(kind)})"


def _day_first(column: str) -> str:
    return f"cast(strptime(split_part({column}, ' ', 1), '%d-%m-%Y') as date)"


def wsys_raw() -> str:
    at = {name: i + 1 for i, name in enumerate(SYSTEM_HEADER)}
    return (
        f"select event_id, f[{at['Level']}] as level, f[{at['Date and Time']}] as date_time, f[{at['Source']}] as source, "
        f"f[{at['Event ID']}] as win_event_id, f[{at['Task Category']}] as task_category, "
        f"array_to_string(f[6:], ' ') as message from ({_fields('wsys')}) where len(f) >= 5"
    )


def wsys_rows() -> str:
    return (
        f"select *, {_day_first('date_time')} as log_date, split_part(date_time, ' ', 2) as log_time, "
        f"source as app_name from ({wsys_raw()})"
    )


def wsec_rows() -> str:
    return (
        f"select event_id, {_day_first('f[2]')} as log_date, split_part(f[2], ' ', 2) as log_time, f[5] as action "
        f"from ({_fields('wsec')})"
    )


def hresult(column: str = "message") -> str:
    return f"regexp_extract({column}, 'HRESULT\\s*=\\s*([^\\]]+)', 1)"


def hresult_name(code: str) -> str:
    whens = " ".join(f"when {code} = '{c}' then '{c} - {n}'" for c, n in HRESULT_NAMES)
    return f"case {whens} else {code} end"


def by_app(rows: str, family: str) -> str:
    """Errors and warnings per application."""
    return (
        f"select category, app_name, count(*) as n from (select *, {category(family)} as category from ({rows})) "
        "where category <> 'success' group by category, app_name"
    )


def summary(rows: str, family: str) -> str:
    count = lambda name: f"count(*) filter (category = '{name}')"
    return (
        "select severe, mild, warning, success_count, success_count - severe - mild - warning as net_success, "
        "success_count + severe + mild + warning as total from (select "
        f"{count('severe_error')} as severe, {count('mild_error')} as mild, {count('warning')} as warning, "
        f"{count('success')} as success_count from (select {category(family)} as category from ({rows})))"
    )


def totals(rows: str, family: str) -> str:
    names = ", ".join(f"('{c}')" for c in CATEGORIES)
    return (
        f"select d.category, count(r.category) as n from (values {names}) d(category) left join "
        f"(select {category(family)} as category from ({rows})) r on r.category = d.category group by d.category"
    )


def type_counts(rows: str, family: str) -> str:
    return (
        "select error, app_name, count(*) as n from "
        f"(select app_name, unnest({types(family)}) as error from ({rows})) group by error, app_name"
    )


def filled_types(rows: str, family: str) -> str:
    table = ", ".join(f"('{e}', '{m}')" for e, m in ERROR_TABLE[family])
    return (
        "select d.error, coalesce(c.app_name, 'N/A') as app_name, coalesce(c.n, 0) as n, d.error_message "
        f"from (values {table}) d(error, error_message) left join ({type_counts(rows, family)}) c on c.error = d.error"
    )


def wide_bars(rows: str, family: str, lead: int, success_lead: int, least: int, most: int | None) -> str:
    """Bars of at most 120 units; the ratio is cut to two decimals first."""
    parts = []
    for name, column in (
        ("severe_error", "severe"), ("mild_error", "mild"), ("warning", "warning"), ("success", "net_success"),
    ):
        length = f"greatest(((100 * {column} // m) * 120) // 100, {least})"
        if name == "success" and most:
            length = f"least({length}, {most})"
        extra = success_lead if name == "success" else lead
        parts.append(f"select '{name}' as category, {column} as n, {length} + {extra} as bar_len from s")
    return (
        f"with s as (select *, greatest(severe, mild, warning, net_success, 1) as m from ({summary(rows, family)})) "
        + " union all ".join(parts)
    )


def narrow_bars(source: str, columns: dict[str, str], label: str = "category", lift: bool = False) -> str:
    """Bars of at most 50 units over one row of counts."""
    parts = []
    for name, column in columns.items():
        length = f"{column} * 50 // m"
        if lift:
            length = f"case when {column} > 0 then greatest({length}, 1) else {length} end"
        parts.append(f"select '{name}' as {label}, {column} as n, {length} as bar_len from s")
    largest = ", ".join(columns.values())
    return f"with s as (select *, greatest({largest}, 1) as m from ({source})) " + " union all ".join(parts)
