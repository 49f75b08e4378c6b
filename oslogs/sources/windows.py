"""Tab-separated exports of the Windows System and Security logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import well_formed_windows
from ..operators.lookup import with_file_facts
from ..operators.once import with_once
from ..session import checkpointed
from .text import log_lines

# --- Fixed values: header names of a System export and the columns they become -
SYSTEM_HEADER: tuple[tuple[str, str], ...] = (
    ("Level", "level"),
    ("Date and Time", "date_time"),
    ("Source", "source"),
    ("Event ID", "event_id"),
    ("Task Category", "task_category"),
)
MESSAGE_FIELD = 5  # the message is everything from this field on; it has no header


def _is_header(line: Column) -> Column:
    """A test on the unsplit line."""
    return F.concat(F.lit("\t"), line, F.lit("\t")).contains("\tDate and Time\t") & line.contains("Event ID")


def system_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first header row found; stops reading there."""
    found = spark.read.text(path).where(_is_header(F.col("value"))).select(F.split("value", "\t").alias("names")).first()
    if found is None:
        raise ValueError(f"no header row below {path}")
    return found["names"]


def _layouts(lines: DataFrame) -> DataFrame:
    """Files and the layout (the whole header row) that each has; of several the first in the order of their text."""
    header = lines.where(_is_header(F.col("value")))
    return header.groupBy("source_file").agg(F.min("value").alias("layout"), F.max("file_size").alias("last_byte"))


def windows_system(
    spark: SparkSession, path: str, header: list[str] | None = None, where: Column | None = None
) -> DataFrame:
    """System export rows ``level, date_time, source, event_id, task_category, message``.

    Column positions come from the header rows, wherever their columns stand. Without ``header`` (see
    ``system_header``) a first pass looks for header rows among the unsplit lines. If all files that have one share a
    layout, it holds for files without a header row as well, and nothing is looked up. Where layouts differ, each file takes
    its own from a checkpointed dictionary, which is broadcast up to a measured size (``with_file_facts``), and a file
    without a header row fails the query with its name, as its columns can't be known. Rows that are not
    ``well_formed_windows`` and header rows are dropped; empty fields keep their place. ``where`` is applied to the
    unsplit lines and has to keep header rows.
    """
    lines = log_lines(spark, path, where=where)
    layouts = [header] if header is not None else None
    if layouts is None:
        files = checkpointed(_layouts(log_lines(spark, path, file_size=True)))
        layouts = [row.layout.split("\t") for row in files.select("layout").distinct().limit(2).collect()]
        if not layouts:
            raise ValueError(f"no header row below {path}")
    body = well_formed_windows(lines.where(~_is_header(F.col("value"))))
    if len(layouts) == 1:
        position = {column: F.lit(layouts[0].index(name)) for name, column in SYSTEM_HEADER}
    else:
        unknown = F.raise_error(F.concat(F.lit("no header row in "), F.col("source_file")))
        names = F.split(F.coalesce("layout", unknown.cast("string")), "\t")
        body = with_file_facts(body, files, F.col("line_no.block")).withColumn("at", F.struct(
            *((F.array_position(names, name).cast("int") - 1).alias(column) for name, column in SYSTEM_HEADER)))
        position = {column: F.col(f"at.{column}") for _, column in SYSTEM_HEADER}
    rows = with_once(body, {"f": F.split("value", "\t")}, drop=("value",))
    return rows.select(
        *(F.coalesce(F.get("f", at), F.lit("")).alias(column) for column, at in position.items()),
        F.array_join(F.slice("f", MESSAGE_FIELD + 1, F.size("f")), " ").alias("message"),
        "source_file", "line_no",
    )


def windows_security(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Security export rows: ``date_time`` (second field) and ``action`` (fifth field)."""
    fields = F.split("value", "\t")
    return log_lines(spark, path, where=where).select(
        F.coalesce(F.get(fields, F.lit(1)), F.lit("")).alias("date_time"),
        F.coalesce(F.get(fields, F.lit(4)), F.lit("")).alias("action"),
        "source_file", "line_no",
    )
