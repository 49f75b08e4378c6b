"""Exported tables. Large outputs are partitioned by ``log_date`` and only replace the partitions they hold."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.rules import AUTH_COUNT_LABELS, ERROR_COUNT_LABELS
from .operators.auth import auth_summary
from .operators.host import TOP_PROCESSES, host_status, top_memory_processes
from .operators.packages import package_actions_filled
from .operators.severity import analysis_summary, weight
from .sources.tables import LANDED_ROWS, MANIFEST

TIMESTAMPS = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # the default would cut microseconds


def _labelled(summary: DataFrame, labels: tuple[tuple[str, str], ...]) -> DataFrame:
    pairs = [F.struct(F.lit(text).alias("Category"), F.col(name).alias("Count")) for text, name in labels]
    return summary.select(F.inline(F.array(*pairs)))


def _write_counts(rows: DataFrame, path: str, header: bool) -> None:
    """A count table of a handful of rows that come out of one global aggregate."""
    rows.write.csv(path, sep="\t", header=header, mode="overwrite")


def error_counts(summary: DataFrame) -> DataFrame:
    """Category and Count of an ``analysis_summary`` row: severe, mild, warnings and net successes."""
    return _labelled(summary, ERROR_COUNT_LABELS)


def auth_events(summary: DataFrame) -> DataFrame:
    """Category and Count of an ``auth_summary`` row."""
    return _labelled(summary, AUTH_COUNT_LABELS)


def write_error_counts(rows: DataFrame, path: str) -> None:
    """``error_counts`` of classified rows, with a header."""
    _write_counts(error_counts(analysis_summary(rows)), path, header=True)


def write_auth_events(rows: DataFrame, path: str) -> None:
    """``auth_events`` of rows with their event, with a header."""
    _write_counts(auth_events(auth_summary(rows)), path, header=True)


def write_dpkg_actions(latest: DataFrame, path: str) -> None:
    """The five package actions with their counts, without a header."""
    _write_counts(package_actions_filled(latest), path, header=False)


def export_counts(tables: dict[str, DataFrame], path: str) -> None:
    """The count table of a report (``oslogs.report``) below ``path``, without reading the log again."""
    if "auth_summary" in tables:
        _write_counts(auth_events(tables["auth_summary"]), f"{path}/auth_events", header=True)
    elif "package_actions" in tables:
        _write_counts(tables["package_actions"], f"{path}/dpkg_actions", header=False)
    elif "analysis_summary" in tables:
        _write_counts(error_counts(tables["analysis_summary"]), f"{path}/error_counts", header=True)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Every table of a report below ``path``, all its rows, tab-separated with a header."""
    for name, table in tables.items():
        flat = [F.array_join(c, ",").alias(c) if kind.startswith("array") else F.col(c) for c, kind in table.dtypes]
        table.select(*flat).write.option("timestampNTZFormat", TIMESTAMPS).csv(f"{path}/{name}", sep="\t", header=True, mode="overwrite")


def _write_by_date(rows: DataFrame, path: str, by: tuple[str, ...] = ("log_date",)) -> None:
    """Tab-separated files per day. Rebalancing splits a big day over tasks and packs small ones together."""
    (
        rows.hint("rebalance", *by).write.partitionBy(*by)
        .option("partitionOverwriteMode", "dynamic").option("timestampNTZFormat", TIMESTAMPS)
        .csv(path, sep="\t", header=True, mode="overwrite")
    )


def write_host_status(snapshots: DataFrame, path: str) -> None:
    """Memory, disk and swap rows of all readings below ``path``, in one pass, by metric, day and host.

    A later run replaces the days of the hosts that it holds, and leaves those of other hosts.
    """
    rows = host_status(snapshots).withColumn("log_date", F.to_date("ts"))
    _write_by_date(rows.select("ts", "used", "total", "pct", "status", "metric", "log_date", "host"), path, ("metric", "log_date", "host"))


def write_sar_dumps(series: dict[str, DataFrame], path: str) -> None:
    """memory_sar, paging_sar and swapping_sar tables below ``path``, from series by kind."""
    for kind, rows in series.items():
        _write_by_date(rows, f"{path}/{kind}_sar")


def write_top_processes(
    samples: DataFrame, path: str, snapshots: DataFrame | None = None, n: int = TOP_PROCESSES,
    by: tuple[str, ...] = ("log_date",), ties: tuple[str, ...] = ("user", "command"),
) -> None:
    """The processes with most memory of each day; with ``snapshots`` only of days with high swap use."""
    _write_by_date(top_memory_processes(samples, n, snapshots, by, ties), path)


def _batch(batch: str | None) -> Column:
    return F.lit(f"b-{batch}") if batch is not None else F.concat(F.lit("f-"), F.substring(F.md5("source_file"), 1, 16))


def _land(rows: DataFrame, path: str, within: tuple[str, ...]) -> None:
    """Adds rows with ``kind``, ``log_date`` and ``batch`` to a table of landings.

    Rows go to directories by ``kind`` and ``log_date`` alone, however many batches a day has; which landing of a batch's day
    is valid stands in a second table, the manifest, written once the rows are in place. So a landing that fails is never
    seen, and one that succeeds replaces the former rows of its batches and days in one step, without touching their files.
    """
    refused = F.raise_error(F.lit("rows without a year can't be landed; give year=2024 or year='modified'"))
    dated = F.when(F.col("log_date").isNull(), refused.cast("date")).otherwise(F.col("log_date"))
    landing = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    landed = rows.withColumns({"log_date": dated, "landing": F.lit(landing)})
    data, manifest = f"{path}/{LANDED_ROWS}", f"{path}/{MANIFEST}"
    (
        landed.hint("rebalance", "kind", "log_date").sortWithinPartitions("kind", "log_date", *within)
        .write.partitionBy("kind", "log_date").parquet(data, mode="append")
    )
    # what was written is read, not the source again: only the landing's own files hold its number, which the statistics tell
    keys = landed.sparkSession.read.parquet(data).where(F.col("landing") == landing).groupBy("kind", "log_date", "batch", "landing").agg(F.count(F.lit(1)).alias("n"))
    keys.hint("rebalance", "kind", "log_date").write.partitionBy("kind", "log_date").parquet(manifest, mode="append")


def write_parsed(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Parsed rows as Parquet by ``kind`` and ``log_date``, so that a report reads only its family's days.

    Landing adds to the table: a second file, host or family of a day stands beside the first. What is landed again
    under the same batch replaces its former rows of those days. By default every source file is a batch of its own, which
    costs a row of the manifest and no directory; name a batch to replace many files together. A row without a date fails
    the write: give the year.
    """
    _land(rows.withColumn("batch", _batch(batch)), path, ("log_time",))


def write_summaries(rows: DataFrame, path: str, kind: str, batch: str | None = None) -> None:
    """What the severity and error reports need of classified rows, per day and batch.

    A month's report then adds up thirty small tables (``sources.tables.daily_summaries``). A batch landed again replaces its
    own days, so summaries can be made again after a failure or a late file without counting anything twice.
    """
    counted = rows.withColumn("batch", _batch(batch)).groupBy("log_date", "batch", "category", "app_name", "error_types")
    _land(counted.agg(weight(rows).alias("n")).withColumn("kind", F.lit(kind)), path, ("batch",))
