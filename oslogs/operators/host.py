"""Host status, time-bucketed series and processes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .once import with_once

# --- Fixed values: thresholds in percent and the step of the series -----------
HIGH, MODERATE, DISK_HIGH = 75, 50, 80
STEP = "30 minutes"
TOP_PROCESSES = 10


def percent(used: Column, total: Column) -> Column:
    """``used * 100 / total`` cut (not rounded) to two decimals; NULL when the total is 0."""
    hundredths = F.floor(F.try_divide(used.cast("long") * 10000, total.cast("long")))
    return (hundredths.cast("decimal(15,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(7,2)")


def _with_disk(snapshots: DataFrame) -> DataFrame:
    """Readings with ``disk_used``, the digits of the disk percentage."""
    return with_once(snapshots, {"disk_used": F.regexp_replace("disk_pct", "[^0-9]", "").try_cast("int")})


def _reading(metric: str, used: Column, total: Column, pct: Column, status: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"), used.cast("int").alias("used"), total.cast("int").alias("total"),
        pct.cast("decimal(7,2)").alias("pct"), status.alias("status"),
    )


def _memory() -> Column:
    used, total = F.col("mem_used_mb"), F.col("mem_total_mb")
    pct = percent(used, total)
    status = F.when(pct > HIGH, "High").when(pct > MODERATE, "Moderate").otherwise("Normal")
    return _reading("memory", used, total, pct, status)


def _disk() -> Column:
    used = F.col("disk_used")
    status = F.when(used > DISK_HIGH, "High").when(used.isNull(), "Unavailable").otherwise("Normal")
    return _reading("disk", used, F.lit(100), used, status)


def _swap() -> Column:
    used, total = F.col("swap_used_mb"), F.col("swap_total_mb")
    pct = F.when(total == 0, F.lit(0).cast("decimal(7,2)")).otherwise(percent(used, total))
    return _reading("swap", used, total, pct, F.when(pct > HIGH, "High").otherwise("Normal"))


def _readings(snapshots: DataFrame, *readings: Column) -> DataFrame:
    return snapshots.select("host", "ts", F.inline(F.array(*readings)))


def memory_status(snapshots: DataFrame) -> DataFrame:
    """High above 75 %, Moderate above 50 %, else Normal."""
    return _readings(snapshots, _memory())


def disk_status(snapshots: DataFrame) -> DataFrame:
    """High above 80 %, else Normal; a reading without digits is Unavailable."""
    return _readings(_with_disk(snapshots), _disk())


def swap_status(snapshots: DataFrame) -> DataFrame:
    """High above 75 %, else Normal; no swap counts as 0 %."""
    return _readings(snapshots, _swap())


def host_status(snapshots: DataFrame) -> DataFrame:
    """Memory, disk and swap rows of every reading, in one pass."""
    return _readings(_with_disk(snapshots), _memory(), _disk(), _swap())


def used_free_split(snapshots: DataFrame) -> DataFrame:
    """``host, ts, metric, part, value``: Used and Free rows of memory (MB) and disk (percent)."""
    disk = F.col("disk_used")
    parts = [
        ("memory", "Used", F.col("mem_used_mb")), ("memory", "Free", F.col("mem_total_mb") - F.col("mem_used_mb")),
        ("disk", "Used", disk), ("disk", "Free", 100 - disk),
    ]
    rows = [
        F.struct(F.lit(m).alias("metric"), F.lit(p).alias("part"), v.cast("long").alias("value")) for m, p, v in parts
    ]
    return _with_disk(snapshots).select("host", "ts", F.inline(F.array(*rows)))


def sar_interval(series: DataFrame, step: str = STEP) -> DataFrame:
    """Averages of every metric per host and step; partial sums keep a busy host to one row per task and step."""
    metrics = [c for c in series.columns if c not in ("host", "log_date", "ts")]
    grouped = series.groupBy("host", F.window("ts", step).alias("w")).agg(*(F.avg(c).alias(c) for c in metrics))
    return grouped.select("host", F.col("w.start").alias("bucket"), *metrics)


def paging_series(series: DataFrame) -> DataFrame:
    """Host, day, time, pgpgin and pgpgout; each host's day is in time order."""
    days = series.select("host", "log_date", "ts", "pgpgin", "pgpgout").repartition("host", "log_date")
    return days.sortWithinPartitions("host", "log_date", "ts")


def top_memory_processes(
    samples: DataFrame, n: int = TOP_PROCESSES, snapshots: DataFrame | None = None,
    by: tuple[str, ...] = (), ties: tuple[str, ...] = ("user", "command"),
) -> DataFrame:
    """The ``n`` processes with most memory; with ``snapshots`` only where swap is above 75 %.

    Without ``by`` the swap test covers all readings. With ``by`` (for instance host and log_date)
    there are ``n`` rows per group, and only groups whose swap is high are kept. Either way each
    task passes on at most ``n`` rows per group.
    """
    order = [F.desc("pct_mem"), *ties]
    if snapshots is not None:
        high = swap_status(snapshots).where(F.col("status") == "High")
        if by:
            groups = high.withColumn("log_date", F.to_date("ts")).select(*by).distinct()
            samples = samples.join(groups, list(by), "left_semi")
        else:
            samples = samples.where(high.agg(F.count(F.lit(1)) > 0).scalar())
    if not by:
        return samples.orderBy(*order).limit(n)
    ranked = samples.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("rank") <= n).drop("rank")

