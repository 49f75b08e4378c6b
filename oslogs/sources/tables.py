"""Count tables and parsed rows that this package wrote earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import LOOKUP_BYTES
from ..session import checkpointed

LANDED_ROWS, MANIFEST = "rows", "manifest"  # the two parts of a table of landings
NAMED_LANDINGS = 500  # landings that a filter names one by one
LOOKUP_ROW = 256  # bytes that one batch and day takes at most


def read_counts(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """A two-column count table as ``category, count``."""
    return spark.read.csv(path, sep="\t", header=header, schema="category STRING, count LONG")


def _valid(spark: SparkSession, path: str, kind: str | None, days: tuple | None) -> DataFrame:
    """Rows of the valid landing of each batch and day, without the columns that landings add.

    The manifest of the days asked for tells which landings there are and which batches of a day were landed more than once;
    only for those is a row's landing looked up, and without any there is no join.
    """
    def part(name: str) -> DataFrame:
        folder = f"{path}/{name}"
        # the schema is that of the family's own files
        table = spark.read.option("basePath", folder).parquet(f"{folder}/kind={kind}" if kind else folder)
        return table if days is None else table.where(F.col("log_date").between(*(F.lit(str(day)).cast("date") for day in days)))

    key = ("kind", "log_date", "batch")
    manifest = part(MANIFEST)
    landings = [row.landing for row in manifest.select("landing").distinct().limit(NAMED_LANDINGS + 1).collect()]
    again = manifest.groupBy(*key).agg(F.max("landing").alias("valid"), F.count_distinct("landing").alias("times")).where("times > 1").drop("times")
    again = checkpointed(again)
    rows, replaced = part(LANDED_ROWS), again.count()
    if len(landings) <= NAMED_LANDINGS:
        rows = rows.where(F.col("landing").isin(landings))
    else:
        rows = rows.join(F.broadcast(manifest.select("landing").distinct()), "landing", "left_semi")
    if replaced:
        if replaced * LOOKUP_ROW <= LOOKUP_BYTES:
            again = F.broadcast(again)
        rows = rows.join(again, [*key], "left").where(F.col("valid").isNull() | (F.col("landing") == F.col("valid")))
    return rows.drop("batch", "landing", "valid")


def parsed_rows(spark: SparkSession, path: str, kind: str | None = None, days: tuple | None = None) -> DataFrame:
    """Parsed rows landed by ``write_parsed``; filters on ``kind`` and ``log_date`` prune directories.

    ``kind`` and ``days`` (first, last) also bound the part of the manifest that is read.
    """
    rows = _valid(spark, path, kind, days)
    return rows.select(*(c for c in rows.columns if c not in ("kind", "log_date")), "kind", "log_date")


def daily_summaries(spark: SparkSession, path: str, kind: str, days: tuple | None = None) -> DataFrame:
    """``category, app_name, error_types, n`` of whole days, from what ``write_summaries`` stored: a report's summary."""
    rows = _valid(spark, path, kind, days)
    return rows.groupBy("category", "app_name", "error_types").agg(F.sum("n").alias("n"))
