"""Text log scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import DEFAULT_PATHS

#: endings of compressed files, which can't be split
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


def default_path(kind: str | None, path: str | None = None) -> str:
    """The given path, or the family's usual log file."""
    if path is not None and path != "nofile":
        return path
    if kind in DEFAULT_PATHS:
        return DEFAULT_PATHS[kind]
    raise ValueError(f"kind {kind!r} has no default path; give one")


def log_lines(
    spark: SparkSession,
    path: str | list[str] | None = None,
    kind: str | None = None,
    where: Column | None = None,
    days: tuple | None = None,
    newest_last: bool = False,
    modified: bool = False,
    file_size: bool = False,
    spread: bool = True,
) -> DataFrame:
    """Lines of a file, directory or glob as ``value, source_file, line_no``.

    ``line_no`` is an ordering key (file, block, position in the block), not a number: it follows
    the file order over splits without a sort or a pass over the data. Files are ordered by name,
    or by modification time first with ``newest_last`` (rotated logs). It is computed only where a
    query uses it. ``where`` is a condition on ``value`` or on directory columns that is applied
    before numbering, so it can still prune directories. ``days`` (first, last) reads only those
    ``log_date=`` directories where the log is laid out that way. ``modified`` adds the file's last
    change, ``file_size`` its size.

    A compressed file is read by one task, whatever its size. With ``spread`` its lines are numbered there and then dealt
    over many tasks, so that parsing and rules are not bound to that one; other files keep their tasks and are not shuffled.
    """
    lines = spark.read.text(default_path(kind, path) if path is None or isinstance(path, str) else path)
    keep = ["value", *(c for c in lines.columns if c != "value")]
    if days is not None and "log_date" in lines.columns:
        lines = lines.where(F.col("log_date").between(*(F.lit(str(day)).cast("date") for day in days)))
    if where is not None:
        lines = lines.where(where)
    key = [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    ]
    if newest_last:
        key.insert(0, F.col("_metadata.file_modification_time").alias("modified"))
    numbered = lines.select(
        *keep,
        F.col("_metadata.file_path").alias("source_file"),
        F.struct(*key).alias("line_no"),
        *([F.col("_metadata.file_modification_time").alias("modified")] if modified else []),
        *([F.col("_metadata.file_size").alias("file_size")] if file_size else []),
    )
    if not spread or lines.isStreaming or not any(name.endswith(COMPRESSED) for name in lines.inputFiles()):
        return numbered
    packed = F.substring_index("source_file", ".", -1).isin([ending[1:] for ending in COMPRESSED])
    return numbered.where(~packed).unionAll(numbered.where(packed).hint("rebalance", "line_no"))
