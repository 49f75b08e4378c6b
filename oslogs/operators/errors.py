"""Known error types: counts per application, zero-filled tables, result codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.extract import hresult_code, hresult_label, hresult_name
from ..functions.rules import ERROR_TABLE, HRESULT_NAMES
from .severity import weight


def _texts(texts) -> Column:
    return F.array(*map(F.lit, texts))


def _fixed(spark: SparkSession, rows, names: str) -> DataFrame:
    """Fixed rows as a local relation, whose size Spark knows."""
    return spark.sql(f"VALUES {', '.join(str(tuple(row)) for row in rows)} AS fixed({names})")


def error_types_by_app(rows: DataFrame) -> DataFrame:
    """Hits per error type and application; a row with several types counts for each."""
    kept = ["app_name", *(c for c in rows.columns if c == "n")]
    hits = rows.where(F.size("error_types") > 0).select(F.explode("error_types").alias("error"), *kept)
    return hits.groupBy("error", "app_name").agg(weight(hits).alias("n"))


def zero_fill_errors(counts: DataFrame, family: str) -> DataFrame:
    """Every type of the family's table; a type without hits gets one row (``N/A``, 0).

    No join: a type finds its place and message among a dozen fixed ones, and the types that no count has are those
    left of them by one small aggregate.
    """
    types, messages = (_texts(column) for column in zip(*ERROR_TABLE[family]))
    place = F.array_position(types, F.col("error")).cast("int")
    found = counts.where(place > 0).select("error", "app_name", F.col("n").cast("long").alias("n"))
    # all columns of the counts are used, so that both branches share one exchange and the log is scanned once
    left = F.array_except(types, F.collect_set(F.when(F.col("n") > 0, F.col("error"))))
    missing = found.agg(left.alias("left")).select(F.explode("left").alias("error"), F.lit("N/A").alias("app_name"), F.lit(0).cast("long").alias("n"))
    return found.unionByName(missing).select((place - 1).alias("position"), "error", "app_name", "n", F.get(messages, place - 1).alias("error_message"))


def error_table(rows: DataFrame, family: str) -> DataFrame:
    """The whole error table (error, app_name, n, error_message) in its printed order."""
    table = zero_fill_errors(error_types_by_app(rows), family)
    return table.orderBy("position", F.desc("n"), "app_name").drop("position")


def with_hresult(rows: DataFrame) -> DataFrame:
    """Rows that report a result code, with ``hresult_code`` and ``hresult_name``."""
    code = hresult_code(F.col("message"))
    return rows.where(code != "").withColumns({"hresult_code": code, "hresult_name": hresult_name(code)})


def hresult_lookup(codes: DataFrame) -> DataFrame:
    """Left join of ``hresult_code`` with the names of the known codes (three rows)."""
    names = _fixed(codes.sparkSession, HRESULT_NAMES, "hresult_code, known_as")
    return codes.join(F.broadcast(names), "hresult_code", "left")


def hresult_counts(rows: DataFrame) -> DataFrame:
    """Rows per result code (named where known) of classified rows; no zero-fill."""
    hits = rows.where(F.size("error_types") > 0)
    code = F.get("error_types", F.lit(0))
    return hits.groupBy(hresult_name(code).alias("hresult")).agg(weight(hits).alias("n"))


def hresult_table(rows: DataFrame) -> DataFrame:
    """``hresult_counts`` under the error table's header, with the short label of each code."""
    label = hresult_label(F.col("hresult"))
    return hresult_counts(rows).select(
        label.alias("error"), F.lit("N/A").alias("app_name"), "n", label.alias("error_message")
    ).orderBy(F.desc("n"), "error")
