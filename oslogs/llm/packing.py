"""Packing examples into sequences by vector bin packing.

Every piece asks for three things at once: tokens, one segment, and tokens that bear loss. A sequence is filled by the
dot-product heuristic: of the pieces that still fit in all three, it takes the one whose demands, weighted by how scarce each
is in the group, point most along what the sequence has left. Pieces are dealt at random into groups of some thousands, so
that any number of rows is packed by many tasks, at the price of about one half-filled sequence per group.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oslogs.llm.common import map_batches, written
from oslogs.llm.token_counts import counter

GROUP = 4096  # pieces that one task packs together, on average
ALONE = 1 << 60  # sequences of pieces that fill a limit alone are numbered from here


def fill(demand: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The sequence (from 0) of every row of demand (pieces x dimensions, each within the limits)."""
    share = demand / limits
    weight = share.mean(axis=0)
    order = np.argsort(-(share @ weight), kind="stable")
    share, taken = share[order], np.full(len(order), -1)
    tiny = 1e-9
    sequence, left = 0, np.arange(len(order))
    while len(left):
        room = np.ones(demand.shape[1])
        fits = np.ones(len(left), bool)
        while fits.any():
            here = np.flatnonzero(fits)
            best = here[np.argmax(share[left[here]] @ (weight * room))]
            taken[left[best]] = sequence
            room = room - share[left[best]]
            fits[best] = False
            fits &= (share[left] <= room + tiny).all(axis=1)
        left = left[taken[left] < 0]
        sequence += 1
    out = np.empty(len(order), np.int64)
    out[order] = taken
    return out


def pack(
    pieces: DataFrame, tokens: str, loss: str | None = None, capacity: int = 2048, max_segments: int = 128, max_loss: int | None = None
) -> DataFrame:
    """The rows of ``pieces`` with sequence_id (long) and offset (long, tokens before it in its sequence, gapless from 0).

    ``tokens`` names the length, ``loss`` the tokens that bear loss (default: all). No sequence exceeds ``capacity`` tokens,
    ``max_segments`` rows or ``max_loss`` loss tokens. A row that is null, below 1 or beyond a limit alone gets a sequence
    of its own. Repeated rows are placed one by one; an empty table gives an empty one. Columns of ``pieces`` that are
    named sequence_id or offset are replaced. ``pieces`` should be a written table, as it is read twice.
    """
    max_loss = capacity if max_loss is None else max_loss
    rows = pieces.drop("sequence_id", "offset")
    names = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType)]
    size, bears = F.col(f"`{tokens}`").cast("long"), F.col(f"`{loss or tokens}`").cast("long")
    fits = F.coalesce((size >= 1) & (size <= capacity) & (bears >= 0) & (bears <= max_loss), F.lit(False))
    full = (size == capacity) | (bears == max_loss) if loss is None else size == capacity
    alone = rows.where(~fits | F.coalesce(full, F.lit(True)))
    shared = rows.where(fits & ~F.coalesce(full, F.lit(True)))
    groups = max(1, math.ceil(shared.count() / GROUP))
    limits = np.array([capacity, max_segments, max_loss], float)
    out_schema = pieces.drop("sequence_id", "offset").schema.add("sequence_id", "long").add("offset", "long")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["__group"].iloc[0])
        frame = frame.drop(columns="__group").sort_values(names, kind="stable")
        demand = np.stack([frame[tokens], np.ones(len(frame)), frame[loss or tokens]], axis=1).astype(float)
        where = fill(demand, limits)
        order = np.lexsort((-demand[:, 0], where))
        frame, where, length = frame.iloc[order], where[order], demand[order, 0].astype(np.int64)
        before = np.cumsum(length) - length
        first = np.r_[True, where[1:] != where[:-1]]
        return frame.assign(sequence_id=(group << 24) + where, offset=before - before[np.flatnonzero(first)][np.cumsum(first) - 1])

    # dealt by a hash of the row's number, so that repeated rows spread as well
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id(), size), F.lit(groups)).cast("int")
    packed = shared.withColumn("__group", group).groupBy("__group").applyInPandas(one, out_schema)
    lone = alone.withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(ALONE)).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(lone)


def pieces(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document cut into pieces of at most ``capacity`` ids: id_col, start, length, ids_crc32 and doc_tokens.

    A document's ids are those of its whole text (null: empty), then ``end_id``; it has one piece at least. Only its last
    piece is shorter than ``capacity``.
    """

    def rows(batches):
        encoder = counter(path)
        for batch in batches:
            ids, start, length, check, total = [], [], [], [], []
            for key, found in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                raw = np.append(found, end_id).astype("<u4")
                for at in range(0, len(raw), capacity):
                    part = raw[at : at + capacity]
                    ids.append(key)
                    start.append(at)
                    length.append(len(part))
                    check.append(zlib.crc32(part.tobytes()))
                    total.append(len(raw))
            yield {"id": ids, "start": start, "length": length, "ids_crc32": check, "doc_tokens": total}

    few = df.select(df[id_col].cast("bigint").alias("id"), df[text_col].alias("text"))
    schema = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return map_batches(few, rows, schema).withColumnRenamed("id", id_col)


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, max_segments: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents cut into pieces and packed: the columns of ``pieces``, then sequence_id and offset.

    Every id bears loss. A null text is an empty one (its single piece holds ``end_id`` alone); repeated rows are packed
    each; a null id stays null. The documents are encoded once: only the pieces' few numbers are written and packed.
    """
    cut = written(pieces(df, path, capacity, end_id, id_col, text_col), "pieces")
    return pack(cut, "length", None, capacity, max_segments)
