"""Host resource tables: readings, process samples and exported time series."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import data_rows_only
from ..operators.lookup import with_file_facts
from ..operators.once import with_once
from ..session import checkpointed

# --- Fixed values: table schemas ----------------------------------------------
SNAPSHOT_SCHEMA = (
    "host STRING, ts TIMESTAMP_NTZ, mem_used_mb INT, mem_total_mb INT, disk_pct STRING, "
    "swap_used_mb INT, swap_total_mb INT"
)
PROCESS_SCHEMA = "user STRING, pct_mem DOUBLE, command STRING"

# --- Fixed values: metric columns of the exported series, in their usual order -
SAR_COLUMNS: dict[str, tuple[str, ...]] = {
    "memory": (
        "kbmemfree", "kbavail", "kbmemused", "%memused", "kbbuffers", "kbcached", "kbcommit", "%commit",
        "kbactive", "kbinact", "kbdirty",
    ),
    "paging": (
        "pgpgin/s", "pgpgout/s", "fault/s", "majflt/s", "pgfree/s", "pgscank/s", "pgscand/s", "pgsteal/s", "%vmeff",
    ),
    "swapping": ("pswpin/s", "pswpout/s"),
}

MAX_LAYOUTS = 1000  # different header rows of one query that are told apart


def _table(spark: SparkSession, path: str, schema: str, fmt: str, sep: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.csv(path, schema=schema, sep=sep, header=True)


def host_snapshots(spark: SparkSession, path: str, fmt: str = "parquet", sep: str = "\t") -> DataFrame:
    """Memory, disk and swap readings of many hosts."""
    return _table(spark, path, SNAPSHOT_SCHEMA, fmt, sep)


def process_samples(spark: SparkSession, path: str, fmt: str = "parquet", sep: str = "\t") -> DataFrame:
    """Process samples: user, percent of memory, command."""
    return _table(spark, path, PROCESS_SCHEMA, fmt, sep)


def metric_name(header: str) -> str:
    """Column name of a metric header: ``pgpgin/s`` -> ``pgpgin``, ``%memused`` -> ``pct_memused``."""
    return header.removesuffix("/s").replace("%", "pct_")


def sar_header(spark: SparkSession, path: str, kind: str) -> tuple[str, ...]:
    """Metric names from the first header line found in the export."""
    known = SAR_COLUMNS[kind][0]
    found = spark.read.text(path).where(F.col("value").contains(known)).first()
    if found is None:
        raise ValueError(f"no {kind} header line below {path}")
    return tuple(re.split(r"\s+", found["value"].strip()))[1:]


def _clock(value: Column) -> Column:
    """``HH:mm:ss`` of a data row; a 12-hour clock with AM or PM is turned into 24 hours."""
    clock, half = F.substring(value, 1, 8), F.regexp_extract(value, r"^\S+\s+([AP]M)\b", 1)
    hour = F.substring(clock, 1, 2).try_cast("int") % 12 + F.when(half == "PM", 12).otherwise(0)
    return F.when(half == "", clock).otherwise(
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.substring(clock, 3, 6))
    )


def _metrics(line: Column) -> Column:
    """What follows the clock of a line, with one blank between words."""
    return F.regexp_replace(F.trim(F.regexp_replace(line, r"^\S+\s+([AP]M\s+)?", "")), r"\s+", " ")


def _series_layouts(lines: DataFrame, kind: str) -> DataFrame:
    """Every file with its layout, NULL without a header row; one pass by hash aggregates, checkpointed."""
    layout = F.when(F.col("value").contains(SAR_COLUMNS[kind][0]), _metrics(F.col("value"))).alias("layout")
    seen = lines.select("source_file", "size", layout).groupBy("source_file", "size", "layout").agg(F.count(F.lit(1)))
    return checkpointed(seen.groupBy("source_file").agg(F.min("layout").alias("layout"), F.max("size").alias("last_byte")))


def sar_series(
    spark: SparkSession,
    path: str,
    kind: str,
    columns: tuple[str, ...] | None = None,
    date: str | None = None,
) -> DataFrame:
    """Exported ``memory``, ``paging`` or ``swapping`` text as ``host, log_date, ts`` and DOUBLE metrics.

    The rows carry only a clock, so the day comes from a ``log_date=`` directory or from ``date``; ``host=``
    directories name the host. Each file's header row names its columns, in whatever order; a file without one has the
    usual columns. If all files come to the same layout there is no lookup; otherwise each line finds its file's in a
    dictionary of the files that differ from the usual one (``with_file_facts``). ``columns`` overrides the headers and saves
    the pass that looks for them. Headers, averages and
    restart notes are dropped; a metric that a file lacks is NULL.
    """
    raw = spark.read.text(path)
    kept = [c for c in ("host", "log_date") if c in raw.columns]
    place = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block")]
    usual, files = " ".join(SAR_COLUMNS[kind]), None
    if columns is None:
        files = _series_layouts(raw.select("value", *place, F.col("_metadata.file_size").alias("size")), kind)
        met = [row.layout for row in files.select("layout").distinct().limit(MAX_LAYOUTS + 1).collect()]
        if len(met) > MAX_LAYOUTS:
            raise ValueError(f"more than {MAX_LAYOUTS} header rows below {path}; give columns=")
        headers = sorted(layout for layout in met if layout is not None)
        layouts = sorted({layout or usual for layout in met})
    else:
        headers = layouts = [" ".join(columns)]
    lines = raw.select("value", *kept, *place)
    found = {name for layout in headers or [usual] for name in layout.split(" ")}
    names = list(columns) if columns else [*(c for c in SAR_COLUMNS[kind] if c in found), *sorted(found - set(SAR_COLUMNS[kind]))]
    lines = data_rows_only(lines)
    if len(layouts) > 1:
        others = files.where(F.col("layout") != usual)
        lines = with_file_facts(lines, others, F.col("block")).withColumn("layout", F.coalesce("layout", F.lit(usual)))
    else:
        lines = lines.withColumn("layout", F.lit(layouts[0] if layouts else usual))
    log_date = F.lit(date) if date is not None else F.col("log_date") if "log_date" in lines.columns else None
    if log_date is None:
        raise ValueError("the rows carry no day: give date= or a log_date= directory layout")
    host = F.col("host").cast("string") if "host" in lines.columns else F.lit("")
    words = F.split(_metrics(F.col("value")), " ")
    stamp = F.concat_ws(" ", log_date.cast("string"), _clock(F.col("value"))).try_cast("timestamp_ntz")
    cut = with_once(lines, {"words": words, "ts": stamp, "first": F.get(words, F.lit(0)).try_cast("double"), "names": F.split("layout", " ")})
    metric = lambda name: F.get("words", F.nullif(F.array_position("names", F.lit(name)), F.lit(0)).cast("int") - 1)
    return cut.where(F.col("ts").isNotNull() & F.col("first").isNotNull()).select(
        host.alias("host"), log_date.cast("date").alias("log_date"), "ts",
        *(metric(name).try_cast("double").alias(metric_name(name)) for name in names),
    )
