"""Connected components of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oslogs.llm.common import discard, written


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """id and component (the smallest id reachable) of every id that occurs in a link.

    Links may repeat, run either way and join an id with itself. Each step writes the links anew, so that no lineage grows;
    a hub's links are summed up before they are shuffled, and the join that hands its new centre to them may be split.
    Ends when all links form stars, after a number of rounds that grows with the logarithm of the longest path.
    """
    edges = links.select(F.greatest(left, right).cast("bigint").alias("a"), F.least(left, right).cast("bigint").alias("b")).where("a != b").distinct()
    edges = written(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large")
        discard(edges)
        least = _least(large)
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "small")
        discard(large)
        ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("from"), F.lit(0).alias("to")).unionByName(
            edges.select(F.col("b").alias("id"), F.lit(0).alias("from"), F.lit(1).alias("to")))
        ends = ends.groupBy("id").agg(F.sum("from").alias("from"), F.max("to").alias("to"))
        if ends.where("from > 1 or (from = 1 and to = 1)").isEmpty():
            break  # every id has one link at most, and none leads on: all are stars round their smallest id
    out = written(edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()), "components")
    discard(edges)
    return out
