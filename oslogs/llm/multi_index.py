"""Embedding near-duplicates through an inverted multi-index.

Each half of the unit vectors has its own codebook, and every vector lies in one cell of the product grid. A vector looks for
partners by multi-sequence traversal: it visits cells in the order of how near a partner in them could be, and stops when the
next cell is too far for any partner, so the recall is complete. Each pair of cells is visited from one side only. A
cell's vectors are compared in blocks, and a block returns sums and a few links for each vector, never its pairs.
"""

from __future__ import annotations

import math
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oslogs.llm.common import map_batches, written
from oslogs.llm.components import components

SAMPLE = 20_000  # vectors at most to which the codebooks are fitted; all vectors are indexed
BLOCK = 1024  # vectors of a cell that are compared at a time


def codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Centres of k-means from a fixed start (evenly spaced points)."""
    centres = points[np.linspace(0, len(points) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        near = (((centres**2).sum(1))[None, :] - 2 * points @ centres.T).argmin(1)
        count = np.bincount(near, minlength=size)
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def half_bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, and the least squared way from the point to where another centre is nearest."""
    square = np.maximum((points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T, 0)
    near = square.argmin(1)
    apart = np.sqrt(np.maximum((centres**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * centres @ centres.T, 0))
    gap = square - square[np.arange(len(points)), near][:, None]
    way = np.where(gap > 0, gap / np.maximum(2 * apart[near], 1e-12), 0.0)
    return near, way**2


def traversal(first: np.ndarray, second: np.ndarray, stop: float) -> list[tuple[int, int]]:
    """Cells (i, j) by ascending first[i] + second[j] while that is at most stop."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    f, s = first[a].tolist(), second[b].tolist()
    heap, out = [(f[0] + s[0], 0, 0)], []
    while heap:
        total, i, j = heappop(heap)
        if total > stop:
            break
        out.append((int(a[i]), int(b[j])))
        if j + 1 < len(s):
            heappush(heap, (f[i] + s[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(f):
            heappush(heap, (f[i + 1] + s[0], i + 1, 0))
    return out


def _unit(rows) -> np.ndarray:
    x = np.stack(rows).astype(float)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _cells(vectors: DataFrame, books: tuple[np.ndarray, np.ndarray], reach: float) -> DataFrame:
    """A row for each vector in its own cell and in every cell of a higher number that it visits."""
    half = books[0].shape[1]

    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, vectors = part.column(0).to_pylist(), part.column(1).to_pylist()
                x = _unit(vectors)
                (n1, w1), (n2, w2) = half_bounds(x[:, :half], books[0]), half_bounds(x[:, half:], books[1])
                width = len(books[1])
                out = {"id": [], "cell": [], "own": []}
                for i, key in enumerate(ids):
                    own = int(n1[i]) * width + int(n2[i])
                    for a, b in traversal(w1[i], w2[i], reach):
                        if (cell := a * width + b) >= own:
                            out["id"].append(key)
                            out["cell"].append(cell)
                            out["own"].append(cell == own)
                yield out

    return map_batches(vectors.select("id", "v"), rows, "id bigint, cell bigint, own boolean")


def _linked(threshold: float):
    def linked(key, frame: pd.DataFrame) -> pd.DataFrame:
        """What each vector of two blocks gains: the weight of its partners, and a link to the least of those it reaches."""
        frame = frame.sort_values("id")
        left, right = frame[frame["left"]], frame[~frame["left"]]
        none = pd.DataFrame({"id": [], "gain": [], "root": []}).astype("int64")
        alone = key[-2] == key[-1]
        if not len(left) or not alone and not len(right):
            return none
        x = _unit(left["v"].to_numpy())
        y = x if alone else _unit(right["v"].to_numpy())
        hit = x @ y.T >= threshold
        if alone:
            np.fill_diagonal(hit, False)
        if not hit.any():
            return none
        other = left if alone else right
        weight = left["copies"].to_numpy(), other["copies"].to_numpy()
        ids = left["id"].to_numpy(), other["id"].to_numpy()
        gain = hit @ weight[1]
        a, b = ids[0].copy(), ids[1].copy()
        big = np.iinfo(np.int64).max
        while True:  # the least id spreads along the links of the block
            na = np.minimum(a, np.where(hit, b[None, :], big).min(1))
            nb = na if alone else np.minimum(b, np.where(hit, na[:, None], big).min(0))
            if (na == a).all() and (nb == b).all():
                break
            a, b = na, nb
        out = [pd.DataFrame({"id": ids[0], "gain": gain, "root": a})[hit.any(1)]]
        if not alone:
            out.append(pd.DataFrame({"id": ids[1], "gain": hit.T @ weight[0], "root": b})[hit.any(0)])
        return pd.concat(out).astype("int64")

    return linked


def near_vectors(
    df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label"
) -> DataFrame:
    """id_col, n_links, component_id and kept for every row.

    Two rows link when their groups are equal and not null and the cosine of their vectors, in double precision, is at least
    ``threshold``. Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null group
    or id, link with nothing (component_id = id, n_links = 0, kept). Vectors of different length never link. Equal
    vectors are compared once. Rows are told apart by their id: rows that repeat an id count as one link's ends each,
    and all get the same result. An empty table gives an empty one; other columns are not read.
    """
    vector, group = F.col(f"`{vector_col}`"), F.col(f"`{group_col}`")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vector.alias("v"), group.alias("g"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("g").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    key = F.md5(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))))
    keyed = rows.where(usable).withColumn("k", key)
    classes = written(keyed.groupBy("g", "k").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")), "classes")
    n = classes.count()
    links = None
    lengths = [r[0] for r in classes.select(F.size("v")).distinct().limit(2).collect()]
    sized = classes.where(F.size("v") == lengths[0]) if len(lengths) == 1 else classes
    if n and len(lengths) == 1 and lengths[0] > 1:
        sample = sized.orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toPandas()["v"]
        x = _unit(sample.to_numpy())
        half = lengths[0] // 2
        size = int(min(64, max(4, round(math.sqrt(n / 1024))), len(x)))
        books = codebook(x[:, :half], size), codebook(x[:, half:], size)
    elif n:
        books = None
    if n:
        reach = (2 - 2 * threshold) * (1 + 1e-9) + 1e-9
        if books is None:  # vectors of one component or of many lengths: a cell for each length
            placed = classes.select("id", F.size("v").cast("bigint").alias("cell"), F.lit(True).alias("own"))
        else:
            placed = _cells(classes, books, reach)
        placed = written(placed.join(classes.select("id", "g"), "id"), "cells")
        counts = placed.groupBy("g", "cell").agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).alias("n_other"))
        counts = counts.where("n_own > 0 and n_own + n_other > 1").select(
            "g", "cell", F.ceil(F.col("n_own") / BLOCK).cast("int").alias("own_blocks"), F.ceil(F.col("n_other") / BLOCK).cast("int").alias("other_blocks"))
        dealt = placed.join(counts, ["g", "cell"]).withColumn("h", F.xxhash64("id"))
        mine = F.pmod("h", "own_blocks").cast("int")
        theirs = F.col("own_blocks") + F.pmod("h", F.greatest("other_blocks", F.lit(1))).cast("int")
        # own block o is left of every block from o on and right of the own blocks before it; visitors are right of all
        as_left = F.transform(F.sequence(mine, F.col("own_blocks") + F.col("other_blocks") - 1), lambda b: F.struct(mine.alias("a"), b.alias("b"), F.lit(True).alias("left")))
        before = F.when(mine > 0, F.sequence(F.lit(0), mine - 1)).otherwise(F.array().cast("array<int>"))
        as_right = F.transform(before, lambda a: F.struct(a.alias("a"), mine.alias("b"), F.lit(False).alias("left")))
        visits = F.transform(F.sequence(F.lit(0), F.col("own_blocks") - 1), lambda a: F.struct(a.alias("a"), theirs.alias("b"), F.lit(False).alias("left")))
        tasks = dealt.select("id", "g", "cell", F.explode(F.when(F.col("own"), F.concat(as_left, as_right)).otherwise(visits)).alias("t"))
        tasks = tasks.select("id", "g", "cell", "t.*").join(classes.select("id", "copies", "v"), "id")
        gains = written(tasks.groupBy("g", "cell", "a", "b").applyInPandas(_linked(threshold), "id bigint, gain bigint, root bigint"), "gains")
        totals = gains.groupBy("id").agg(F.sum("gain").alias("gain"))
        roots = components(gains.select("id", "root"), "id", "root")
        found = classes.select("g", "k", "id", "copies").join(totals, "id", "left").join(roots, "id", "left").select(
            F.col("g").alias("fg"), F.col("k").alias("fk"), (F.coalesce("gain", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"))
        all_rows = rows.withColumn("k", F.when(usable, key)).join(found, (F.col("g") == F.col("fg")) & (F.col("k") == F.col("fk")), "left")
    else:
        all_rows = rows.withColumn("n_links", F.lit(0).cast("bigint")).withColumn("component_id", F.col("id"))
    component = F.coalesce("component_id", "id")
    return all_rows.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))
