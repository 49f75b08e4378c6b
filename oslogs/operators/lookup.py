"""Facts about files, given to the lines of those files without shuffling a log where the facts are few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKUP_BYTES = 64 << 20  # facts up to this measured size are broadcast
PART_BYTES = 128 << 20  # beyond, a file's lines are dealt by parts of this many bytes


def with_file_facts(lines: DataFrame, facts: DataFrame, block: Column, bound: int | None = None) -> DataFrame:
    """``lines`` (with ``source_file``) and the columns of ``facts``, NULL for files without any.

    ``facts`` has one row per ``source_file`` and its ``last_byte``, and is cheap to read twice (checkpointed): its size is
    measured first. Up to ``LOOKUP_BYTES`` it is broadcast and no line moves. Beyond that both sides are joined by file and
    part of the file, so that a file which holds a third of the log is spread like any others; ``block`` is the byte at which
    a line's block begins.
    """
    names = [c for c in facts.columns if c not in ("source_file", "last_byte")]
    width = F.octet_length("source_file") + F.lit(32) + sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in names), F.lit(0))
    size = facts.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= (LOOKUP_BYTES if bound is None else bound):
        return lines.join(F.broadcast(facts.drop("last_byte")), "source_file", "left")
    part = lambda byte: F.floor(byte / F.lit(PART_BYTES))
    parts = facts.select("source_file", *names, F.explode(F.sequence(F.lit(0).cast("long"), part(F.col("last_byte")))).alias("file_part"))
    return lines.withColumn("file_part", part(block)).join(parts, ["source_file", "file_part"], "left").drop("file_part")
