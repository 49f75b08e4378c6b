"""Authentication reports. Rows carry ``event`` from ``with_auth_event``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import auth_event
from ..session import written
from .once import with_once
from .parse import extract_auth_failure, extract_sudo
from .severity import weight, weight_where


def with_auth_event(rows: DataFrame) -> DataFrame:
    """Rows with ``event``: auth_failure, sudo, session or other."""
    return with_once(rows, {"event": auth_event(F.col("message"))})


def by_event(rows: DataFrame) -> DataFrame:
    """Rows in a table by event, written in one pass over the log; only failures and commands keep their message."""
    message = F.when(F.col("event").isin("auth_failure", "sudo"), F.col("message")).alias("message")
    return written(rows.select("log_date", "log_time", "app_name", message, "event"), "auth-events", "event")


def _by_app(rows: DataFrame, event: str, keep_unnamed: bool) -> DataFrame:
    hits = rows.where(F.col("event") == event)
    if not keep_unnamed:
        hits = hits.where(F.col("app_name") != "")
    return hits.groupBy("app_name").agg(weight(hits).alias("n"))


def sessions_by_app(rows: DataFrame) -> DataFrame:
    """Opened sessions per application; rows without an application are left out."""
    return _by_app(rows, "session", keep_unnamed=False)


def other_events_by_app(rows: DataFrame, keep_unnamed: bool = False) -> DataFrame:
    """Other events per application."""
    return _by_app(rows, "other", keep_unnamed)


def auth_summary(rows: DataFrame, keep_unnamed: bool = False) -> DataFrame:
    """One row: auth_failures, sudo_commands, sessions, other_events and their total."""
    event, named = F.col("event"), F.col("app_name") != ""
    counts = rows.agg(
        weight_where(rows, event == "auth_failure").alias("auth_failures"),
        weight_where(rows, event == "sudo").alias("sudo_commands"),
        weight_where(rows, (event == "session") & named).alias("sessions"),
        weight_where(rows, (event == "other") & (named | F.lit(keep_unnamed))).alias("other_events"),
    )
    return counts.withColumn(
        "total", F.col("auth_failures") + F.col("sudo_commands") + F.col("sessions") + F.col("other_events")
    )


def auth_failures(rows: DataFrame, missing: str | None = "N/A") -> DataFrame:
    """One row per failure: log_date, log_time, logname, user."""
    hits = extract_auth_failure(rows.where(F.col("event") == "auth_failure"), missing)
    return hits.select("log_date", "log_time", "logname", "user")


def sudo_commands(rows: DataFrame, strip: bool = True) -> DataFrame:
    """One row per command: log_date, log_time, sudo_user, pwd, command."""
    hits = extract_sudo(rows.where(F.col("event") == "sudo"), strip)
    return hits.select("log_date", "log_time", "sudo_user", "pwd", "command")
