"""Reports by log family: the entry points a user calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.dates import as_date, as_time, check_recent
from .operators import auth, bars, errors, filters, host, packages, parse, severity
from .session import checkpointed
from .sources.tables import parsed_rows
from .sources.text import log_lines
from .sources.windows import windows_security, windows_system

SYSLOG_KINDS = ("mem", "proc", "ubu", "mac", "sol")
KINDS = (*SYSLOG_KINDS, "auth", "auth_t", "dpkg", "cbs", "wsys", "wsec")


def parsed(
    spark: SparkSession, kind: str, path: str | None = None, days: tuple | None = None,
    year: parse.Year = None, newest_last: bool = True, header: list[str] | None = None,
) -> DataFrame:
    """Parsed rows of one family's log.

    ``days`` (first, last) drops lines of other days before they are cut up, and reads only those
    days of a log kept in ``log_date=`` directories. ``header`` fixes the columns of a System export. The last line is
    that of the file changed last (rotated logs), or with ``newest_last=False`` of the file that is last by name.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}; one of {', '.join(KINDS)}")
    if kind in ("wsys", "wsec"):
        where = filters.raw_windows_days(*days) if days else None
        if kind == "wsys":
            return parse.parse_windows_system(windows_system(spark, path, header, where))
        return parse.parse_windows_security(windows_security(spark, path, where))
    where = filters.raw_days(*days) if days else None
    lines = log_lines(spark, path, kind, where, days, newest_last, modified=year == "modified")
    if kind == "dpkg":
        return parse.parse_dpkg(lines, year)
    if kind == "cbs":
        return parse.parse_cbs(lines)
    if kind in ("auth", "auth_t"):
        return parse.parse_syslog(lines, kind, year, layout="auth" if kind == "auth" else "auth_tail")
    return parse.parse_syslog(lines, kind, year)


def labelled(rows: DataFrame, kind: str) -> DataFrame:
    """Rows with a message and their category and error types, or their authentication event."""
    if kind in ("dpkg", "wsec"):
        return rows
    if kind != "cbs" and kind != "wsys":
        rows = filters.nonempty_message(rows)
    return auth.with_auth_event(rows) if kind in ("auth", "auth_t") else severity.classified(rows, kind)


def analyze(
    spark: SparkSession, kind: str, date: str, start: str = "00:00:00", end: str = "23:59:59",
    path: str | None = None, last: str | None = None, inclusive: str = "both",
    bsd_time_filter: bool = True, year: parse.Year = None, newest_last: bool = True,
    header: list[str] | None = None, landed: bool = False, repetitive: bool = False,
) -> DataFrame:
    """Parsed and labelled rows of a day (or days up to ``last``) and time window of one log.

    With ``landed`` the path is a table written by ``write_parsed``; only the days asked for are read. With ``repetitive``
    the families with severities give each different message of an application and day once, labelled, with its number of
    rows ``n``; their reports are the same.
    """
    days = (as_date(date), as_date(last or date))
    as_time(start), as_time(end)
    if landed:
        rows = parsed_rows(spark, path, kind, days)
    else:
        rows = parsed(spark, kind, path, days, year, newest_last, header)
    rows = filters.in_window(rows, date, start, end, last, inclusive, bsd_time_filter)
    if repetitive:
        if kind not in (*SYSLOG_KINDS, "cbs", "wsys"):
            raise ValueError("only families with severities have repetitive reports")
        rows = severity.distinct_messages(rows)
    return labelled(rows, kind)


def report(rows: DataFrame, kind: str) -> dict[str, DataFrame]:
    """All tables of a family's report over rows from ``analyze``.

    The log is read once into a small summary, which is checkpointed; the tables come from that. Authentication rows are
    written once, by event, and all tables come from there. ``rows`` may also be a summary of many days
    (``daily_summaries``), for the families with severities.
    """
    if kind == "wsec":
        return {"security_actions": packages.security_actions(rows)}
    if kind == "dpkg":
        latest = checkpointed(packages.latest_package_action(rows))
        return {
            "package_report": packages.package_report(latest),
            "package_action_counts": packages.package_action_counts(latest),
            "package_bars": packages.nonzero_guard(bars.package_bars(latest), n="n"),
            "package_actions": packages.package_actions_filled(latest),
        }
    if kind in ("auth", "auth_t"):
        strict = kind == "auth"
        rows = auth.by_event(rows)
        counts = rows.groupBy("event", "app_name").agg(severity.weight(rows).alias("n"))
        counts = checkpointed(counts)
        summary = auth.auth_summary(counts, keep_unnamed=not strict)
        return {
            "auth_failures": auth.auth_failures(rows, "N/A" if strict else None),
            "sudo_commands": auth.sudo_commands(rows, strip=strict),
            "sessions_by_app": auth.sessions_by_app(counts),
            "other_events_by_app": auth.other_events_by_app(counts, keep_unnamed=not strict),
            "auth_summary": summary,
            "auth_bars": packages.nonzero_guard(bars.auth_bars(summary), n="n"),
        }
    summary = checkpointed(severity.summarize(rows))
    totals = severity.analysis_summary(summary)
    return {
        "severity_report": severity.severity_report(summary),
        "analysis_summary": totals,
        "severity_bars": bars.severity_bars(totals, kind),
        "error_table": errors.hresult_table(summary) if kind == "cbs" else errors.error_table(summary, kind),
    }


def host_report(
    snapshots: DataFrame, date: str, start: str = "00:00:00", end: str = "23:59:59",
    series: dict[str, DataFrame] | None = None, samples: DataFrame | None = None, as_of: str | None = None,
) -> dict[str, DataFrame]:
    """Status, half-hour averages and top processes of one day and time window.

    ``series`` holds ``sar_series`` frames by kind. With ``as_of`` the day must lie within the
    seven days before it. Processes are listed, per host and day where the samples name them, only when swap use was
    high in the window.
    """
    day = check_recent(date, as_of) if as_of else as_date(date)
    window = f"{day} {as_time(start)}", f"{day} {as_time(end)}.999999"
    within = lambda rows: rows.where(rows.ts.between(*window))
    readings = within(snapshots)
    tables = {"host_status": host.host_status(readings), "used_free": host.used_free_split(readings)}
    for kind, rows in (series or {}).items():
        tables[f"{kind}_interval"] = host.sar_interval(within(rows))
        if kind == "paging":
            tables["paging_series"] = host.paging_series(within(rows))
    if samples is not None:
        if "ts" in samples.columns:
            samples = within(samples)
        elif "log_date" in samples.columns:
            samples = filters.on_date(samples, day)
        by = tuple(c for c in ("host", "log_date") if c in samples.columns)
        tables["top_memory_processes"] = host.top_memory_processes(samples, snapshots=readings, by=by)
    return tables
