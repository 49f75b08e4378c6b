"""Columns that are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds (or replaces) columns whose expressions are evaluated once per row.

    A filter on a projected column is pushed below the projection with its expression copied into
    it, once per use; for a category of twenty word searches over a parsed message that costs more
    than all other work. Inlining a one-row array keeps the expressions where they are, inside
    generated code, while filters on the other columns still move below.
    """
    kept = [c for c in rows.columns if c not in columns and c not in drop]
    return rows.select(*kept, F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))
