"""Exact top-k by inner product with a vector-approximation file.

The vectors are rounded down to integers. Their approximations, a few bits per component on a grid of equal cells, are scanned
first: a cell bounds the score of every vector in it from above and from below. Of each block of candidates only those
remain whose upper bound reaches the kth lower bound of the query, first within the block, then over all blocks. Their exact
vectors are then read by descending upper bound (that is, ascending lower bound of the distance) until the kth score beats
every bound left, so the result is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oslogs.llm.common import written

CANDIDATES = 4096  # of a block
QUERIES = 2048  # of a block
STRIP = 256  # queries that are multiplied at a time
REFINED = 128  # queries, on average, whose exact vectors one task reads together


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """id and v (array<bigint>, floor(scale * x)) of the vectors without null or non-finite components; one row per id.

    Rows of one id count as one row (the smallest vector, if they differ); a null id or an empty vector takes no part.
    """
    vector = F.col(f"`{vector_col}`")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = df.where(F.col(f"`{id_col}`").isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & good)
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)))
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), ints.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores, queries by candidates."""
    # a cell holds the integers low + step * cell ... low + step * (cell + 1) - 1
    half = (step - 1) / 2.0
    middle = queries @ (low + step * cells + half).T
    slack = (np.abs(queries) @ half)[:, None]
    return middle - slack, middle + slack


def _scan(k: int):
    def scan(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "low": [], "high": []}).astype({"query_id": "int64", "vec_id": "int64", "low": "float64", "high": "float64"})
        if not len(queries) or not len(candidates):
            return none
        asked = np.stack(queries["v"].to_numpy()).astype(float)
        cells = np.stack([np.frombuffer(x, np.uint8) for x in candidates["cells"]]).astype(float)
        low = np.stack(candidates["grid_low"].to_numpy()).astype(float)
        step = np.asarray(candidates["grid_step"].iloc[0], float)
        ids, names = queries["id"].to_numpy(), candidates["id"].to_numpy()
        out = [none]
        for at in range(0, len(ids), STRIP):
            least, most = _bounds(asked[at : at + STRIP], cells, low[0], step)
            own = ids[at : at + STRIP, None] == names[None, :]
            least[own] = most[own] = -np.inf
            kth = np.partition(least, -k, axis=1)[:, -k] if least.shape[1] >= k else np.full(len(least), -np.inf)
            q, c = np.nonzero((most >= kth[:, None]) & ~own)
            out.append(pd.DataFrame({"query_id": ids[at + q], "vec_id": names[c], "low": least[q, c], "high": most[q, c]}))
        return pd.concat(out)

    return scan


def _refine(k: int):
    def refine(key, pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs.sort_values(["query_id", "high"], ascending=[True, False], kind="stable")
        out = []
        for query, rows in pairs.groupby("query_id", sort=False):
            high, ids = rows["high"].to_numpy(), rows["vec_id"].to_numpy()
            asked = np.asarray(rows["q"].iloc[0], np.int64)
            scores = np.zeros(0, np.int64)
            done = 0
            while done < len(rows):
                kth = np.partition(scores, -k)[-k] if done >= k else -np.inf
                if high[done] < kth:  # nothing left can reach the kth
                    break
                more = rows["v"].iloc[done : done + k]
                scores = np.append(scores, np.stack(more.to_numpy()).astype(np.int64) @ asked)
                done += len(more)
            best = np.lexsort((ids[:done], -scores))[:k]
            out.append(pd.DataFrame({"query_id": query, "rank": np.arange(1, len(best) + 1), "vec_id": ids[best], "score": scores[best]}))
        return pd.concat(out).astype({"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "int64"})

    return refine


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, bits: int = 6) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k highest integer inner products, ties to the smaller vec_id.

    Both inputs have id and v as ``integer_vectors`` makes them; the row of the query's own id is no candidate for it.
    Vectors are compared with those of equal length only. Fewer candidates than k give fewer rows, empty inputs none.
    """
    lengths = F.size("v").alias("n")
    base = written(vectors.select("id", "v", lengths), "vectors")
    asked = written(queries.select("id", "v", lengths), "queries")
    n, n_asked = base.count(), asked.count()
    blocks, asked_blocks = max(1, math.ceil(n / CANDIDATES)), max(1, math.ceil(n_asked / QUERIES))

    def approximate(frame: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(frame["v"].to_numpy()).astype(np.int64)
        low = v.min(axis=0)
        step = (v.max(axis=0) - low) // (1 << bits) + 1
        cells = ((v - low) // step).astype(np.uint8)
        same = {"grid_low": [low.tolist()] * len(frame), "grid_step": [step.tolist()] * len(frame)}
        return pd.DataFrame({"id": frame["id"], "n": frame["n"], "block": frame["block"], "cells": [c.tobytes() for c in cells], **same})

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    file = base.withColumn("block", block).groupBy("n", "block").applyInPandas(
        approximate, "id bigint, n int, block int, cells binary, grid_low array<bigint>, grid_step array<bigint>")
    file = written(file, "approximations")
    asked_block = F.pmod(F.xxhash64("id"), F.lit(asked_blocks)).cast("int")
    left = asked.withColumn("asked", asked_block).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = file.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))
    key = ["n", "block", "asked"]
    bounds = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_scan(k), "query_id bigint, vec_id bigint, low double, high double")
    bounds = written(bounds, "bounds")
    order = Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")
    kth = bounds.withColumn("rn", F.row_number().over(order)).where(F.col("rn") == k).select("query_id", F.col("low").alias("kth"))
    left_over = bounds.join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("high") >= F.col("kth")))
    exact = left_over.select("query_id", "vec_id", "high").join(base.select(F.col("id").alias("vec_id"), "v"), "vec_id")
    exact = exact.join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
    parts = max(1, math.ceil(n_asked / REFINED))
    return exact.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts))).groupBy("part").applyInPandas(
        _refine(k), "query_id bigint, rank int, vec_id bigint, score bigint")
