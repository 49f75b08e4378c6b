"""One query per operator over inputs derived from the given tables, with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import extract
from ..functions.classify import auth_event, category
from ..functions.dates import normalise_date
from ..functions.rules import AUTH_COUNT_LABELS, PACKAGE_ACTIONS, SEVERITY_LABELS
from ..operators import auth, bars, errors, filters, host, packages, parse, severity
from ..operators.once import with_once
from ..session import checkpointed
from ..sources import synthetic
from ..sources.host import host_snapshots, process_samples, sar_series
from ..sources.tables import daily_summaries, parsed_rows, read_counts
from ..sources.text import log_lines
from ..sources.windows import windows_security, windows_system
from . import oracle as o
from .derived import PAGING_HEADER, SAR_METRICS, SYSTEM_HEADER, derived, fresh_dir, lines_sql, table_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DAY, START, END = "2024-01-15", "06:00:00", "18:00:00"
FIRST, LAST = "2024-01-10", "2024-01-20"


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return register


# --- rows of the derived logs -------------------------------------------------
def _lines(spark, sf, kind):
    return log_lines(spark, derived(spark, sf, kind))


def _iso(spark, sf):
    return parse.parse_iso_syslog(_lines(spark, sf, "iso"))


def _mixed(spark, sf):
    return filters.nonempty_message(parse.parse_syslog(_lines(spark, sf, "mixed")))


def _sol(spark, sf):
    return filters.nonempty_message(parse.parse_syslog(_lines(spark, sf, "sol"), "sol"))


def _auth(spark, sf):
    return auth.with_auth_event(parse.parse_iso_auth(_lines(spark, sf, "auth")))


def _dpkg(spark, sf):
    return parse.parse_dpkg(log_lines(spark, derived(spark, sf, "dpkg")))  # part files follow each other by name


def _latest(spark, sf):
    return packages.latest_package_action(_dpkg(spark, sf))


def _cbs(spark, sf):
    return parse.parse_cbs(_lines(spark, sf, "cbs"))


def _wsys(spark, sf):
    return parse.parse_windows_system(windows_system(spark, derived(spark, sf, "wsys")))


def _wsec(spark, sf):
    return parse.parse_windows_security(windows_security(spark, derived(spark, sf, "wsec")))


def _snapshots(spark, sf):
    return host_snapshots(spark, derived(spark, sf, "host"))


def _samples(spark, sf):
    return process_samples(spark, derived(spark, sf, "ps"))


def _paging(spark, sf):
    return sar_series(spark, derived(spark, sf, "sar"), "paging", PAGING_HEADER)


_ROWS = {"mixed": _mixed, "sol": _sol, "cbs": _cbs, "wsys": _wsys}
_FAMILY_LOG = {"mem": "mixed", "proc": "mixed", "ubu": "mixed", "mac": "mixed", "sol": "sol", "cbs": "cbs", "wsys": "wsys"}
_SOL_SQL = f"select * from ({o.bsd_rows('sol')}) where message <> ''"
_ROWS_SQL = {"mixed": o.mixed_rows(), "sol": _SOL_SQL, "cbs": o.cbs_rows(), "wsys": o.wsys_rows()}


def _family(spark, sf, family):
    return _ROWS[_FAMILY_LOG[family]](spark, sf)


def _family_sql(family):
    return _ROWS_SQL[_FAMILY_LOG[family]]


def _category(spark, sf, family):
    return severity.with_category(_family(spark, sf, family), family)


def _types(spark, sf, family):
    return severity.with_error_types(_family(spark, sf, family), family)


# --- sources --------------------------------------------------------------------
@query("log_lines", f"select value from ({lines_sql('mixed')})")
def _(spark, sf):
    return _lines(spark, sf, "mixed").select("value")


@query("windows_system", "select level, date_time, source, win_event_id as event_id, task_category, message "
       f"from ({o.wsys_raw()})")
def _(spark, sf):
    rows = windows_system(spark, derived(spark, sf, "wsys"))
    return rows.select("level", "date_time", "source", "event_id", "task_category", "message")


@query("windows_security", f"select f[2] as date_time, f[5] as action from ({o._fields('wsec')})")
def _(spark, sf):
    return windows_security(spark, derived(spark, sf, "wsec")).select("date_time", "action")


@query("sar_series", f"select host, log_date, ts, pgpgin, pgpgout from ({table_sql('sar')})")
def _(spark, sf):
    return _paging(spark, sf)


@query("host_snapshots", table_sql("host"))
def _(spark, sf):
    return _snapshots(spark, sf)


@query("process_samples", f'select "user", pct_mem, command from ({table_sql("ps")})')
def _(spark, sf):
    return _samples(spark, sf).select("user", "pct_mem", "command")


def _synthetic_sql() -> str:
    number = lambda salt: f"(event_id * {7919 + 2 * salt} + {salt})"
    pick = lambda pool, salt: (
        "[" + ", ".join(f"'{t}'" for t in pool) + f"][{number(salt)} % {len(pool)} + 1]"
    )
    good = f"event_id % {synthetic.LINES} < {synthetic.SUCCESS_LINES}"
    return (
        "select strftime(ts, '%b %d %H:%M:%S') || ' solaris-host genunix: [ID ' || "
        f"cast({number(4)} % 1000 as varchar) || ' kern.' || "
        f"case when {good} then 'success' else {pick(synthetic.SEVERITIES, 1)} end || '] ' || "
        f"case when {good} then {pick(synthetic.SUCCESS_MESSAGES, 2)} else {pick(synthetic.PROBLEM_MESSAGES, 3)} end "
        "as value from events"
    )


@query("synthetic_solaris", _synthetic_sql())
def _(spark, sf):
    return _lines(spark, sf, "synthetic").select("value")


def _error_count_sql(rows: str, family: str, labels: tuple[str, str]) -> str:
    label, count = labels
    parts = [
        f"select '{text}' as {label}, {name} as {count} from s" for text, name in (
            ("Severe Errors", "severe"), ("Mild Errors", "mild"), ("Warnings", "warning"), ("Successes", "net_success"),
        )
    ]
    return f"with s as ({o.summary(rows, family)}) " + " union all ".join(parts)


@query("read_counts", _error_count_sql(o.mixed_rows(), "proc", ("category", '"count"')))
def _(spark, sf):
    path = fresh_dir(spark, "read_counts")
    sinks.write_error_counts(_category(spark, sf, "proc"), path)
    return read_counts(spark, path, header=True)


# --- parsing --------------------------------------------------------------------
PARSED = ("log_date", "log_time", "app_name", "message")
BSD = ("log_month", "log_day", "log_time", "app_name", "message")


@query("detect_date_style", f"""select value, case when regexp_matches(value, '^[A-Za-z]{{3}}\\s+[0-9]{{1,2}}') then 'bsd'
       when regexp_matches(value, '^{o.DATE_RE}') then 'iso' end as style from ({lines_sql('mixed')})""")
def _(spark, sf):
    return parse.detect_date_style(_lines(spark, sf, "mixed")).select("value", "style")


@query("parse_iso_syslog", f"select {', '.join(PARSED)} from ({o.iso_rows()})")
def _(spark, sf):
    return _iso(spark, sf).select(*PARSED)


@query("parse_bsd_syslog", f"select {', '.join(BSD)} from ({o.bsd_rows()})")
def _(spark, sf):
    return parse.parse_bsd_syslog(_lines(spark, sf, "bsd")).select(*BSD)


@query("parse_syslog", f"select style, {', '.join(BSD)} from ({o.mixed_rows()})")
def _(spark, sf):
    return _mixed(spark, sf).select("style", *BSD)


@query("parse_iso_auth", f"select {', '.join(PARSED)} from ({o.auth_rows()})")
def _(spark, sf):
    return parse.parse_iso_auth(_lines(spark, sf, "auth")).select(*PARSED)


@query("parse_iso_auth_tail", f"select {', '.join(PARSED)} from ({o.auth_rows(tail=True)})")
def _(spark, sf):
    return parse.parse_iso_auth_tail(_lines(spark, sf, "auth")).select(*PARSED)


@query("parse_dpkg", f"select log_date, log_time, action, package, version from ({o.dpkg_rows()})")
def _(spark, sf):
    return _dpkg(spark, sf).select("log_date", "log_time", "action", "package", "version")


@query("parse_cbs", f"select log_date, log_time, level, app_name, message from ({o.cbs_rows()})")
def _(spark, sf):
    return _cbs(spark, sf).select("log_date", "log_time", "level", "app_name", "message")


@query("parse_windows_system", "select log_date, log_time, level, app_name, win_event_id as event_id, task_category, "
       f"message from ({o.wsys_rows()})")
def _(spark, sf):
    return _wsys(spark, sf).select(
        "log_date", "log_time", "level", "app_name", "event_id", "task_category", "message"
    )


@query("parse_windows_security", f"select log_date, log_time, action from ({o.wsec_rows()})")
def _(spark, sf):
    return _wsec(spark, sf).select("log_date", "log_time", "action")


_FAILURE_SQL = (
    "coalesce(nullif(regexp_extract(message, 'logname=([^ ]+)', 1), ''), 'N/A') as logname, "
    "regexp_extract(message, '(?:^|[^A-Za-z0-9_])user=([^ ]+)', 1) as \"user\""
)
_SUDO_SQL = (
    "regexp_replace(regexp_extract(message, 'USER=([^ ]+)', 1), '\\]+$', '') as sudo_user, "
    "regexp_extract(message, 'PWD=([^ ]+)', 1) as pwd, "
    "regexp_replace(regexp_extract(message, 'COMMAND=([^ ]+)', 1), '\\]+$', '') as command"
)


@query("extract_auth_failure", f"select message, {_FAILURE_SQL} from ({o.auth_rows()})")
def _(spark, sf):
    return parse.extract_auth_failure(_auth(spark, sf)).select("message", "logname", "user")


@query("extract_sudo", f"select message, {_SUDO_SQL} from ({o.auth_rows()})")
def _(spark, sf):
    return parse.extract_sudo(_auth(spark, sf)).select("message", "sudo_user", "pwd", "command")


@query("extract_hresult", f"select log_date, log_time, {o.hresult()} as hresult_code, "
       f"{o.hresult_name(o.hresult())} as hresult_name from ({o.cbs_rows()}) where {o.hresult()} <> ''")
def _(spark, sf):
    return errors.with_hresult(_cbs(spark, sf)).select("log_date", "log_time", "hresult_code", "hresult_name")


@query("hresult_label", "select hresult, list_last(string_split(hresult, ' - ')) as label, n from "
       f"(select {o.hresult_name(o.hresult())} as hresult, count(*) as n from ({o.cbs_rows()}) "
       f"where {o.hresult()} <> '' group by 1)")
def _(spark, sf):
    counts = errors.hresult_counts(_types(spark, sf, "cbs"))
    return counts.select("hresult", extract.hresult_label(F.col("hresult")).alias("label"), "n")


# --- filters --------------------------------------------------------------------
@query("on_date", f"select {', '.join(PARSED)} from ({o.iso_rows()}) where log_date = date '{DAY}'")
def _(spark, sf):
    return filters.on_date(_iso(spark, sf), DAY).select(*PARSED)


@query("between_times", f"select {', '.join(PARSED)} from ({o.iso_rows()}) "
       f"where log_time >= '{START}' and log_time <= '{END}'")
def _(spark, sf):
    return filters.between_times(_iso(spark, sf), START, END).select(*PARSED)


@query("between_instants", "select log_date, log_time, app_name, message from "
       f"({o.cbs_rows()}) where cast(cast(log_date as varchar) || ' ' || log_time as timestamp) "
       f"between timestamp '{FIRST} {END}' and timestamp '{LAST} {START}'")
def _(spark, sf):
    return filters.between_instants(_cbs(spark, sf), f"{FIRST} {END}", f"{LAST} {START}").select(*PARSED)


_YEARLESS = "log_date is null and log_month * 100 + log_day between 110 and 120"


@query("date_range", f"select style, {', '.join(BSD)} from ({o.mixed_rows()}) where "
       f"log_date between date '{FIRST}' and date '{LAST}' or ({_YEARLESS})")
def _(spark, sf):
    return filters.date_range(_mixed(spark, sf), FIRST, LAST).select("style", *BSD)


@query("date_range_exclusive", f"select style, {', '.join(BSD)} from ({o.mixed_rows()}) where "
       f"(log_date > date '{FIRST}' and log_date < date '{LAST}') or ({_YEARLESS})")
def _(spark, sf):
    return filters.date_range(_mixed(spark, sf), FIRST, LAST, inclusive="neither").select("style", *BSD)


@query("on_bsd_date", f"select {', '.join(BSD)} from ({o.bsd_rows()}) where log_month = 1 and log_day = 9")
def _(spark, sf):
    return filters.on_bsd_date(parse.parse_bsd_syslog(_lines(spark, sf, "bsd")), "2024-01-09").select(*BSD)


_LATE_SQL = f"log_date > date '{DAY}' or (log_date = date '{DAY}' and log_time > '{END}')"


@query("prefix_stop", f"with r as ({o.iso_rows()}) select {', '.join(PARSED)} from r "
       f"where event_id < (select min(event_id) from r where {_LATE_SQL})")
def _(spark, sf):
    return filters.prefix_stop(_iso(spark, sf), filters.late_for(DAY, END)).select(*PARSED)


@query("nonempty_message", f"select {', '.join(PARSED)} from ({o.iso_rows()}) where length(message) > 0")
def _(spark, sf):
    return filters.nonempty_message(_iso(spark, sf)).select(*PARSED)


@query("well_formed_windows", f"select value from ({lines_sql('wsys')}) where len(string_split(value, chr(9))) >= 5")
def _(spark, sf):
    lines = _lines(spark, sf, "wsys").where(F.col("value") != "\t".join(SYSTEM_HEADER))
    return filters.well_formed_windows(lines).select("value")


@query("package_actions_only", "select log_date, log_time, action, package from "
       f"({o.dpkg_rows()}) where action in ({', '.join(repr(a) for a in PACKAGE_ACTIONS)})")
def _(spark, sf):
    return filters.package_actions_only(_dpkg(spark, sf)).select("log_date", "log_time", "action", "package")


@query("normalise_date", "select strftime(ts, '%d-%m-%Y') as text, cast(ts as date) as day from events union all "
       "select strftime(ts, '%Y-%m-%d') as text, cast(ts as date) as day from events")
def _(spark, sf):
    day_first = windows_security(spark, derived(spark, sf, "wsec")).select(
        F.substring_index("date_time", " ", 1).alias("text"))
    year_first = _lines(spark, sf, "dpkg").select(F.substring_index("value", " ", 1).alias("text"))
    return day_first.unionByName(year_first).select("text", normalise_date(F.col("text")).alias("day"))


@query("recent_days", f"select {', '.join(PARSED)} from ({o.iso_rows()}) "
       f"where log_date between date '{LAST}' - 7 and date '{LAST}'")
def _(spark, sf):
    return filters.recent_days(_iso(spark, sf), LAST).select(*PARSED)


@query("metric_rows", f"select value from ({lines_sql('metrics')}) where value like '%Memory Usage%' "
       "or value like '%Disk Usage%' or value like '%Swap Usage%'")
def _(spark, sf):
    return filters.metric_rows(_lines(spark, sf, "metrics")).select("value")


@query("data_rows_only", f"select value from ({lines_sql('mixed')}) where substr(value, 1, 1) between '0' and '9'")
def _(spark, sf):
    return filters.data_rows_only(_lines(spark, sf, "mixed")).select("value")


# --- classification and tagging -------------------------------------------------
def _register_rules(family: str) -> None:
    @query(f"category_{family}", "select log_time, app_name, message, "
           f"{o.category(family)} as category from ({_family_sql(family)})")
    def _(spark, sf):
        return _category(spark, sf, family).select("log_time", "app_name", "message", "category")

    listed = f"[{o.hresult()}]" if family == "cbs" else o.types(family)
    where = f" where {o.hresult()} <> ''" if family == "cbs" else f" where len({listed}) > 0"

    @query(f"error_types_{family}", "select log_time, app_name, message, "
           f"array_to_string({listed}, ',') as error_types from ({_family_sql(family)}){where}")
    def _(spark, sf):
        rows = _types(spark, sf, family).where(F.size("error_types") > 0)
        return rows.select("log_time", "app_name", "message", F.array_join("error_types", ",").alias("error_types"))


for _name in ("mem", "proc", "ubu", "mac", "sol", "wsys", "cbs"):
    _register_rules(_name)


@query("category_auth", f"select message, {o.auth_kind()} as category from ({o.auth_rows()})")
def _(spark, sf):
    rows = parse.parse_iso_auth(_lines(spark, sf, "auth"))
    return rows.select("message", auth_event(F.col("message")).alias("category"))


# --- counts -----------------------------------------------------------------------
@query("severity_by_app", o.by_app(o.mixed_rows(), "mem"))
def _(spark, sf):
    return severity.severity_by_app(_category(spark, sf, "mem"))


@query("severity_totals", o.totals(o.mixed_rows(), "proc"))
def _(spark, sf):
    return severity.severity_totals(_category(spark, sf, "proc"))


@query("net_success", f"select success_count, net_success from ({o.summary(o.mixed_rows(), 'mac')})")
def _(spark, sf):
    return severity.net_success(_category(spark, sf, "mac"))


@query("raw_total", f"select total from ({o.summary(o.cbs_rows(), 'cbs')})")
def _(spark, sf):
    return severity.raw_total(_category(spark, sf, "cbs"))


@query("summarize", "select category, app_name, array_to_string(error_types, ',') as error_types, count(*) as n from "
       f"(select app_name, {o.category('ubu')} as category, {o.types('ubu')} as error_types from ({o.mixed_rows()})) "
       "group by all")
def _(spark, sf):
    summary = severity.summarize(severity.classified(_mixed(spark, sf), "ubu"))
    return summary.withColumn("error_types", F.array_join("error_types", ","))


@query("error_types_by_app", o.type_counts(o.mixed_rows(), "ubu"))
def _(spark, sf):
    return errors.error_types_by_app(_types(spark, sf, "ubu"))


@query("zero_fill_errors", o.filled_types(o.mixed_rows(), "mem"))
def _(spark, sf):
    return errors.zero_fill_errors(errors.error_types_by_app(_types(spark, sf, "mem")), "mem").drop("position")


@query("hresult_counts", f"select {o.hresult_name(o.hresult())} as hresult, count(*) as n from ({o.cbs_rows()}) "
       f"where {o.hresult()} <> '' group by 1")
def _(spark, sf):
    return errors.hresult_counts(_types(spark, sf, "cbs"))


def _events_by_app_sql(event: str) -> str:
    return (f"select app_name, count(*) as n from ({o.auth_rows()}) where event = '{event}' and app_name <> '' "
            "group by app_name")


@query("sessions_by_app", _events_by_app_sql("session"))
def _(spark, sf):
    return auth.sessions_by_app(_auth(spark, sf))


@query("other_events_by_app", _events_by_app_sql("other"))
def _(spark, sf):
    return auth.other_events_by_app(_auth(spark, sf))


_AUTH_SUMMARY = (
    "select count(*) filter (event = 'auth_failure') as auth_failures, count(*) filter (event = 'sudo') as sudo_commands, "
    "count(*) filter (event = 'session' and app_name <> '') as sessions, "
    f"count(*) filter (event = 'other' and app_name <> '') as other_events from ({o.auth_rows()})"
)


@query("auth_summary", "select *, auth_failures + sudo_commands + sessions + other_events as total "
       f"from ({_AUTH_SUMMARY})")
def _(spark, sf):
    return auth.auth_summary(_auth(spark, sf))


@query("latest_package_action", o.latest_actions())
def _(spark, sf):
    return _latest(spark, sf)


_ACTION_COUNTS = f"select action, count(*) as n from ({o.latest_actions()}) group by action"
_ACTIONS_FILLED = (
    f"select d.action, coalesce(c.n, 0) as n from (values {', '.join(f'({a!r})' for a in PACKAGE_ACTIONS)}) d(action) "
    f"left join ({_ACTION_COUNTS}) c on c.action = d.action"
)


@query("package_action_counts", _ACTION_COUNTS)
def _(spark, sf):
    return packages.package_action_counts(_latest(spark, sf))


@query("package_action_totals", f"select max(n) as max_n, cast(sum(n) as bigint) as total from ({_ACTION_COUNTS})")
def _(spark, sf):
    return packages.package_action_totals(_latest(spark, sf))


@query("package_actions_filled", _ACTIONS_FILLED)
def _(spark, sf):
    return packages.package_actions_filled(_latest(spark, sf))


@query("security_actions", f"select action, count(*) as n from ({o.wsec_rows()}) where log_date = date '{DAY}' "
       f"and log_time between '{START}' and '{END}' group by action")
def _(spark, sf):
    return packages.security_actions(filters.in_window(_wsec(spark, sf), DAY, START, END))


_WIDE = {"mem": (1, 1, 0, 100), "mac": (1, 0, 0, 100), "sol": (1, 0, 0, 100), "proc": (0, 0, 1, 100), "ubu": (0, 0, 1, None)}


@query("bar_lengths", " union all ".join(
    f"select '{family}' as family, * from ({o.wide_bars(_family_sql(family), family, *style)})"
    for family, style in _WIDE.items()))
def _(spark, sf):
    """The four families of the mixed log are classified and counted in one scan."""
    mixed = [family for family in _WIDE if _FAMILY_LOG[family] == "mixed"]
    rows = with_once(_mixed(spark, sf), {"labels": F.array(*(
        F.struct(F.lit(family).alias("family"), category(F.col("message"), family).alias("category")) for family in mixed))})
    counts = checkpointed(rows.select(F.inline("labels")).groupBy("family", "category").agg(F.count("*").alias("n")))
    by_family = {family: counts.where(F.col("family") == family) for family in mixed}
    by_family |= {family: _category(spark, sf, family) for family in _WIDE if family not in by_family}
    drawn = [
        bars.severity_bars(severity.analysis_summary(rows), family).select(F.lit(family).alias("family"), "*")
        for family, rows in by_family.items()
    ]
    return reduce(DataFrame.unionByName, drawn)


_NARROW = {"severe_error": "severe", "mild_error": "mild", "warning": "warning", "success": "success_count"}


@query("bar_lengths_narrow", " union all ".join([
    *(f"select '{family}' as family, * from ({o.narrow_bars(o.summary(_family_sql(family), family), _NARROW)})"
      for family in ("cbs", "wsys")),
    "select 'auth' as family, * from (" + o.narrow_bars(
        _AUTH_SUMMARY, {c: c for c in ("auth_failures", "sudo_commands", "sessions", "other_events")}, lift=True) + ")",
    f"select 'dpkg' as family, action as category, n, n * 50 // max(n) over () as bar_len from ({_ACTION_COUNTS})",
]))
def _(spark, sf):
    drawn = {
        **{f: bars.severity_bars(severity.analysis_summary(_category(spark, sf, f)), f) for f in ("cbs", "wsys")},
        "auth": bars.auth_bars(auth.auth_summary(_auth(spark, sf))),
        "dpkg": bars.package_bars(_latest(spark, sf)).withColumnRenamed("action", "category"),
    }
    return reduce(DataFrame.unionByName, (d.select(F.lit(f).alias("family"), "*") for f, d in drawn.items()))


@query("nonzero_guard", f"select * from ({_ACTIONS_FILLED}) where (select sum(n) from ({_ACTIONS_FILLED})) > 0")
def _(spark, sf):
    return packages.nonzero_guard(packages.package_actions_filled(_latest(spark, sf)), label="action", n="n")


# --- host -------------------------------------------------------------------------
_PCT = "cast((cast({0} as bigint) * 10000 // {1}) / 100.0 as decimal(7,2))"
_MEM_SQL = (
    "select host, ts, 'memory' as metric, mem_used_mb as used, mem_total_mb as total, "
    f"{_PCT.format('mem_used_mb', 'mem_total_mb')} as pct from ({table_sql('host')})"
)
_DISK_SQL = (
    "select host, ts, 'disk' as metric, try_cast(replace(disk_pct, '%', '') as int) as used, 100 as total, "
    f"cast(try_cast(replace(disk_pct, '%', '') as int) as decimal(7,2)) as pct from ({table_sql('host')})"
)
_SWAP_SQL = (
    "select host, ts, 'swap' as metric, swap_used_mb as used, swap_total_mb as total, case when swap_total_mb = 0 "
    f"then 0 else {_PCT.format('swap_used_mb', 'nullif(swap_total_mb, 0)')} end as pct from ({table_sql('host')})"
)
_MEM_STATUS = (
    f"select *, case when pct > 75 then 'High' when pct > 50 then 'Moderate' else 'Normal' end as status from ({_MEM_SQL})"
)
_DISK_STATUS = (
    "select *, case when pct is null then 'Unavailable' when pct > 80 then 'High' else 'Normal' end as status "
    f"from ({_DISK_SQL})"
)
_SWAP_STATUS = f"select *, case when pct > 75 then 'High' else 'Normal' end as status from ({_SWAP_SQL})"
_STATUS_COLUMNS = "host, ts, metric, used, total, cast(pct as double) as pct, status"


def _plain(status: DataFrame) -> DataFrame:
    return status.withColumn("pct", F.col("pct").cast("double"))


@query("memory_status", f"select {_STATUS_COLUMNS} from ({_MEM_STATUS})")
def _(spark, sf):
    return _plain(host.memory_status(_snapshots(spark, sf)))


@query("disk_status", f"select {_STATUS_COLUMNS} from ({_DISK_STATUS})")
def _(spark, sf):
    return _plain(host.disk_status(_snapshots(spark, sf)))


@query("swap_status", f"select {_STATUS_COLUMNS} from ({_SWAP_STATUS})")
def _(spark, sf):
    return _plain(host.swap_status(_snapshots(spark, sf)))


@query("host_status", " union all ".join(
    f"select {_STATUS_COLUMNS} from ({part})" for part in (_MEM_STATUS, _DISK_STATUS, _SWAP_STATUS)))
def _(spark, sf):
    return _plain(host.host_status(_snapshots(spark, sf)))


@query("sar_interval", "select host, time_bucket(interval '30 minutes', ts) as bucket, round(avg(pgpgin), 6) as pgpgin, "
       f"round(avg(pgpgout), 6) as pgpgout from ({table_sql('sar')}) group by 1, 2")
def _(spark, sf):
    averages = host.sar_interval(_paging(spark, sf))
    return averages.withColumns({c: F.round(c, 6) for c in ("pgpgin", "pgpgout")})


@query("used_free_split", f"""with h as (select *, try_cast(replace(disk_pct, '%', '') as bigint) as d from ({table_sql('host')}))
       select host, ts, 'memory' as metric, 'Used' as part, cast(mem_used_mb as bigint) as value from h union all
       select host, ts, 'memory', 'Free', cast(mem_total_mb - mem_used_mb as bigint) from h union all
       select host, ts, 'disk', 'Used', d from h union all select host, ts, 'disk', 'Free', 100 - d from h""")
def _(spark, sf):
    return host.used_free_split(_snapshots(spark, sf))


@query("paging_series", f"select host, log_date, ts, pgpgin, pgpgout from ({table_sql('sar')})")
def _(spark, sf):
    return host.paging_series(_paging(spark, sf))


_HIGH_SWAP = f"select 1 from ({_SWAP_STATUS}) where status = 'High'"


@query("top_memory_processes", f'select "user", pct_mem, command, event_id from ({table_sql("ps")}) '
       f"where exists ({_HIGH_SWAP}) order by pct_mem desc, event_id limit 10")
def _(spark, sf):
    top = host.top_memory_processes(_samples(spark, sf), snapshots=_snapshots(spark, sf), ties=("event_id",))
    return top.select("user", "pct_mem", "command", "event_id")


@query("top_memory_processes_by_host", f"""with high as (select distinct host, cast(ts as date) as log_date from ({_SWAP_STATUS}) where status = 'High')
       select "user", pct_mem, command, event_id, host, log_date from (select *, row_number() over
       (partition by host, log_date order by pct_mem desc, event_id) as rn from ({table_sql("ps")})
       where (host, log_date) in (select (host, log_date) from high)) where rn <= 10""")
def _(spark, sf):
    return host.top_memory_processes(_samples(spark, sf), snapshots=_snapshots(spark, sf), by=("host", "log_date"), ties=("event_id",))


# --- tables and reports -----------------------------------------------------------
@query("ranked_apps", o.by_app(o.mixed_rows(), "proc"))
def _(spark, sf):
    return severity.ranked_apps(_category(spark, sf, "proc"))


@query("error_table", o.filled_types(_SOL_SQL, "sol"))
def _(spark, sf):
    return errors.error_table(_types(spark, sf, "sol"), "sol")


def _register_tables(family: str) -> None:
    """The error table and the per-application counts of one more family."""
    @query(f"error_table_{family}", o.filled_types(_family_sql(family), family))
    def _(spark, sf):
        return errors.error_table(_types(spark, sf, family), family)

    @query(f"severity_by_app_{family}", o.by_app(_family_sql(family), family))
    def _(spark, sf):
        return severity.severity_by_app(_category(spark, sf, family))


for _name in ("proc", "ubu", "mac", "wsys"):
    _register_tables(_name)


@query("error_table_mem", o.filled_types(_family_sql("mem"), "mem"))
def _(spark, sf):
    return errors.error_table(_types(spark, sf, "mem"), "mem")


@query("severity_by_app_repetitive", o.by_app(o.mixed_rows(), "ubu"))
def _(spark, sf):
    """Each different message is classified once, and counts for as many rows as it has."""
    return severity.severity_by_app(severity.with_category(severity.distinct_messages(_mixed(spark, sf)), "ubu"))


@query("severity_by_app_sol", o.by_app(_SOL_SQL, "sol"))
def _(spark, sf):
    return severity.severity_by_app(_category(spark, sf, "sol"))


@query("severity_by_app_cbs", o.by_app(o.cbs_rows(), "cbs"))
def _(spark, sf):
    return severity.severity_by_app(_category(spark, sf, "cbs"))


@query("hresult_table", f"select regexp_replace({o.hresult_name(o.hresult())}, '^.* - ', '') as error, 'N/A' as app_name, count(*) as n, "
       f"regexp_replace({o.hresult_name(o.hresult())}, '^.* - ', '') as error_message from ({o.cbs_rows()}) where {o.hresult()} <> '' "
       f"group by {o.hresult_name(o.hresult())}")
def _(spark, sf):
    return errors.hresult_table(_types(spark, sf, "cbs"))


@query("daily_summaries", "select category, app_name, array_to_string(error_types, ',') as error_types, count(*) as n from "
       f"(select app_name, {o.category('ubu')} as category, {o.types('ubu')} as error_types from ({o.iso_rows()}) "
       f"where message <> '' and log_date between date '{FIRST}' and date '{LAST}') group by all")
def _(spark, sf):
    """Some days of a stored table of daily summaries, into which one half of the log was put twice."""
    path = fresh_dir(spark, "summaries")
    rows = severity.classified(filters.nonempty_message(_iso(spark, sf)), "ubu")
    early = F.col("log_time") < "12:00:00"
    for half, batch in ((early, "am"), (~early, "pm"), (early, "am")):
        sinks.write_summaries(rows.where(half), path, "ubu", batch)
    return daily_summaries(spark, path, "ubu", (FIRST, LAST)).withColumn("error_types", F.array_join("error_types", ","))

_LABEL = "case category " + " ".join(f"when '{c}' then '{t}'" for c, t in SEVERITY_LABELS.items()) + " end"


@query("severity_report", f"select {_LABEL} as error_type, app_name, n from ({o.by_app(_family_sql('wsys'), 'wsys')})")
def _(spark, sf):
    return severity.severity_report(_category(spark, sf, "wsys"))


@query("hresult_lookup", "select c.hresult_code, c.n, d.known_as from (select "
       f"{o.hresult()} as hresult_code, count(*) as n from ({o.cbs_rows()}) where {o.hresult()} <> '' group by 1) c "
       "left join (values ('0x80004005', 'E_FAIL'), ('0x800f080d', 'CBS_E_MANIFEST_INVALID_ITEM'), "
       "('0x800f0805', 'CBS_E_INVALID_PACKAGE')) d(hresult_code, known_as) on c.hresult_code = d.hresult_code")
def _(spark, sf):
    codes = errors.with_hresult(_cbs(spark, sf)).groupBy("hresult_code").agg(F.count(F.lit(1)).alias("n"))
    return errors.hresult_lookup(codes)


@query("auth_failures", f"select log_date, log_time, {_FAILURE_SQL} from ({o.auth_rows()}) where event = 'auth_failure'")
def _(spark, sf):
    return auth.auth_failures(_auth(spark, sf))


@query("sudo_commands", f"select log_date, log_time, {_SUDO_SQL} from ({o.auth_rows()}) where event = 'sudo'")
def _(spark, sf):
    return auth.sudo_commands(_auth(spark, sf))


_TAIL_SQL = f"select * from ({o.auth_rows(tail=True)}) where message <> ''"


def _auth_tail(spark, sf):
    rows = filters.nonempty_message(parse.parse_iso_auth_tail(_lines(spark, sf, "auth")))
    return auth.by_event(auth.with_auth_event(rows))


@query("auth_failures_tail", "select log_date, log_time, regexp_extract(message, 'logname=([^ ]+)', 1) as logname, "
       f"regexp_extract(message, '(?:^|[^A-Za-z0-9_])user=([^ ]+)', 1) as \"user\" from ({_TAIL_SQL}) where event = 'auth_failure'")
def _(spark, sf):
    """The form of the older report, from the rows written by event: an empty logname stays empty."""
    return auth.auth_failures(_auth_tail(spark, sf), None)


@query("sudo_commands_tail", "select log_date, log_time, regexp_extract(message, 'USER=([^ ]+)', 1) as sudo_user, "
       "regexp_extract(message, 'PWD=([^ ]+)', 1) as pwd, regexp_extract(message, 'COMMAND=([^ ]+)', 1) as command "
       f"from ({_TAIL_SQL}) where event = 'sudo'")
def _(spark, sf):
    return auth.sudo_commands(_auth_tail(spark, sf), strip=False)


@query("other_events_by_app_tail", f"select app_name, count(*) as n from ({_TAIL_SQL}) where event = 'other' group by app_name")
def _(spark, sf):
    return auth.other_events_by_app(_auth_tail(spark, sf), keep_unnamed=True)


@query("package_report", o.latest_actions())
def _(spark, sf):
    return packages.package_report(_latest(spark, sf))


@query("analysis_summary", o.summary(o.mixed_rows(), "mem"))
def _(spark, sf):
    return severity.analysis_summary(_category(spark, sf, "mem"))


# --- sinks: write, read back --------------------------------------------------------
_COUNTS = ("Category", '"Count"')


@query("write_error_counts", _error_count_sql(o.mixed_rows(), "mem", _COUNTS))
def _(spark, sf):
    path = fresh_dir(spark, "error_counts")
    sinks.write_error_counts(_category(spark, sf, "mem"), path)
    return read_counts(spark, path, header=True).toDF("Category", "Count")


@query("write_auth_events", f"with s as ({_AUTH_SUMMARY}) " + " union all ".join(
    f"select '{text}' as Category, {name} as \"Count\" from s" for text, name in AUTH_COUNT_LABELS))
def _(spark, sf):
    path = fresh_dir(spark, "auth_events")
    sinks.write_auth_events(_auth(spark, sf), path)
    return read_counts(spark, path, header=True).toDF("Category", "Count")


@query("write_dpkg_actions", f"select action as category, n as \"count\" from ({_ACTIONS_FILLED})")
def _(spark, sf):
    path = fresh_dir(spark, "dpkg_actions")
    sinks.write_dpkg_actions(_latest(spark, sf), path)
    return read_counts(spark, path)


@query("write_host_status", " union all ".join(
    f"select host, ts, used, total, cast(pct as double) as pct, status, metric, cast(ts as date) as log_date from (select {_STATUS_COLUMNS} from ({part}))"
    for part in (_MEM_STATUS, _DISK_STATUS, _SWAP_STATUS)))
def _(spark, sf):
    path = fresh_dir(spark, "host_status")
    sinks.write_host_status(_snapshots(spark, sf), path)
    return spark.read.csv(path, sep="\t", header=True, schema=(
        "ts TIMESTAMP_NTZ, used INT, total INT, pct DOUBLE, status STRING, metric STRING, log_date DATE, host STRING"))


_DUMPED = ("memory", "paging", "swapping")


@query("write_sar_dumps", " union all ".join(
    f"select '{kind}' as kind, host, log_date, ts, {first} as first_metric, {second} as second_metric from ({table_sql('sar_' + kind)})"
    for kind, (first, second) in SAR_METRICS.items()))
def _(spark, sf):
    path = fresh_dir(spark, "sar_dumps")
    sinks.write_sar_dumps({kind: sar_series(spark, derived(spark, sf, f"sar_{kind}"), kind) for kind in _DUMPED}, path)
    dumps = []
    for kind, (first, second) in SAR_METRICS.items():
        dump = spark.read.csv(f"{path}/{kind}_sar", sep="\t", header=True)
        dumps.append(dump.select(
            F.lit(kind).alias("kind"), F.col("host").cast("string"), F.col("log_date").cast("date"), F.col("ts").cast("timestamp_ntz"),
            F.col(first).cast("double").alias("first_metric"), F.col(second).cast("double").alias("second_metric")))
    return reduce(DataFrame.unionByName, dumps)


def _register_series(kind: str) -> None:
    """The series of one more kind, whose files name their columns in either order."""
    first, second = SAR_METRICS[kind]

    @query(f"sar_series_{kind}", f"select host, log_date, ts, {first}, {second} from ({table_sql('sar_' + kind)})")
    def _(spark, sf):
        return sar_series(spark, derived(spark, sf, f"sar_{kind}"), kind).select("host", "log_date", "ts", first, second)

    @query(f"sar_interval_{kind}", f"select host, time_bucket(interval '30 minutes', ts) as bucket, round(avg({first}), 6) as {first}, "
           f"round(avg({second}), 6) as {second} from ({table_sql('sar_' + kind)}) group by 1, 2")
    def _(spark, sf):
        averages = host.sar_interval(sar_series(spark, derived(spark, sf, f"sar_{kind}"), kind))
        return averages.select("host", "bucket", *(F.round(c, 6).alias(c) for c in (first, second)))


for _kind in _DUMPED:
    _register_series(_kind)


@query("write_top_processes", f"""with high as (select distinct cast(ts as date) as log_date from ({_SWAP_STATUS}) where status = 'High')
       select "user", pct_mem, command, event_id, host, log_date from (select *, row_number() over
       (partition by log_date order by pct_mem desc, event_id) as rn from ({table_sql("ps")})
       where log_date in (select log_date from high)) where rn <= 10""")
def _(spark, sf):
    path = fresh_dir(spark, "top_processes")
    sinks.write_top_processes(_samples(spark, sf), path, _snapshots(spark, sf), ties=("event_id",))
    return spark.read.csv(path, sep="\t", header=True, schema=(
        "user STRING, pct_mem DOUBLE, command STRING, event_id LONG, host STRING, log_date DATE"))


@query("write_parsed", f"select {', '.join(PARSED)} from ({o.iso_rows()}) union all select {', '.join(PARSED)} from ({o.auth_rows()})")
def _(spark, sf):
    """Two families, landed into one table one after the other; the first again, which changes nothing."""
    path = fresh_dir(spark, "parsed")
    both = parse.parse_iso_syslog(_lines(spark, sf, "iso")), parse.parse_iso_auth(_lines(spark, sf, "auth"))
    for rows in (*both, both[0]):
        sinks.write_parsed(rows, path)
    return parsed_rows(spark, path).select(*PARSED)


@query("rejected", f"""select count(*) as lines, count(*) filter (parsed) as parsed, count(*) filter (not parsed) as rejected
       from (select l.event_id, r.event_id is not null as parsed from ({lines_sql('mixed')}) l left join ({o.mixed_ids()}) r using (event_id))""")
def _(spark, sf):
    """Every line is parsed or rejected."""
    lines = _lines(spark, sf, "mixed")
    parts = [lines.select(F.lit("lines").alias("part")), parse.parse_syslog(lines).select(F.lit("parsed")), parse.rejected_lines(lines).select(F.lit("rejected"))]
    counts = reduce(DataFrame.union, parts)
    return counts.agg(*(F.count_if(F.col("part") == name).alias(name) for name in ("lines", "parsed", "rejected")))
