"""Toxicity from subword bags.

A word is the mean of the vectors of its character n-grams (with ends marked) and of itself, a document the mean of its words,
and a linear softmax on top gives the two classes. Vectors and softmax are trained jointly, in numpy, on a bounded sample of
labelled rows. As everything between vectors and softmax is a mean, scoring needs one number per n-gram, and so one per
different word: unseen misspellings get theirs from the n-grams they share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oslogs.llm import bpe
from oslogs.llm.common import filter_batches, fold, map_batches, written

TRAIN_ROWS = 8000  # labelled rows at most that the model is fitted to, chosen by a hash of their id
ROWS_AT_A_TIME = 128  # whose features are held together
BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
DIMENSIONS = 4
STEPS = (40, 60, 120)  # between them, vectors that are zero are left out
RATE = 0.01
PENALTY = 5e-3
LEAST_ROWS = 10  # an n-gram in fewer rows of the sample has no vector
SCREEN = 0.8  # nor has one whose gradient at the start is below this share of the penalty

_MIX = np.uint64(0xD6E8FEB86659FD93)


def _slots(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = (keys ^ (keys >> np.uint64(32))) * _MIX
    return (keys >> np.uint64(47)).astype(np.int64) % BUCKETS


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, and begin, end and text number of every run of letters."""
    texts = [t.lower() for t in texts]
    chars = np.frombuffer(" ".join(texts).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    letter = np.zeros(len(chars) + 2, np.int8)
    letter[1:-1] = bpe.classes()[chars] == bpe.LETTER
    edge = np.diff(letter)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return chars, begin, end, np.searchsorted(np.cumsum(length), begin, "right")


def grams_of(chars: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word number of every n-gram of the words, each word between marks for its ends and itself included."""
    n = end - begin
    size = n + 2
    first = np.cumsum(size) - size
    marked = np.full(int(size.sum()), ord("<"), np.uint32)
    marked[bpe.ragged(first + 1, n)] = chars[bpe.ragged(begin, n)]
    marked[first + size - 1] = ord(">")
    slots, owners = [_slots(bpe.hashes(marked, first, first + size))], [np.arange(len(n))]
    for k in GRAMS:
        count = np.maximum(size - k + 1, 0)
        count[size == k] = 0  # the word itself
        at = bpe.ragged(first, count)
        slots.append(_slots(bpe.hashes(marked, at, at + k)))
        owners.append(np.repeat(np.arange(len(n)), count))
    return np.concatenate(slots), np.concatenate(owners)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their weights, which sum to 1 (none without a word)."""
    chars, begin, end, _ = words_of([text])
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    slots, owner = grams_of(chars, begin, end)
    share = 1.0 / np.bincount(owner, minlength=len(begin))
    slots, where = np.unique(slots, return_inverse=True)
    return slots, (np.bincount(where, share[owner]) / len(begin)).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, scale: np.ndarray, seed: int = 7) -> dict:
    """The number of every bucket and the bias, from joint training of vectors and softmax on all rows at a time.

    ``scale`` brings buckets to a like size. Vectors of n-grams that do not pay for their length are shrunk to zero (a
    penalty on every vector's length, taken by a proximal step), since most n-grams say nothing and would only learn the
    rows by heart.
    """
    n = len(rows)
    share = float(labels.mean()) if n else 0.0
    if not n:  # nothing is known: nothing is toxic
        return {"slots": np.zeros(BUCKETS, np.float32), "bias": -10.0}
    if not 0 < share < 1:  # one class alone: its share everywhere
        return {"slots": np.zeros(BUCKETS, np.float32), "bias": float(np.log((share + 1e-3) / (1 - share + 1e-3)))}
    slots = np.concatenate([s for s, _ in rows])
    weight = np.concatenate([w for _, w in rows]) * scale[slots]
    owner = np.repeat(np.arange(n), [len(s) for s, _ in rows])
    rng = np.random.default_rng(seed)
    w = rng.normal(size=(DIMENSIONS, 2))
    w /= np.linalg.norm(w[:, 1] - w[:, 0])
    bias = np.log([1 - share, share])
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    truth = np.stack([1 - labels, labels], 1)
    active = np.bincount(slots, minlength=BUCKETS) > 0
    for steps in STEPS:
        used = np.flatnonzero(active)
        mine = active[slots]
        number = np.zeros(BUCKETS, np.int64)
        number[used] = np.arange(len(used))
        s, v, o = number[slots[mine]], weight[mine], owner[mine]
        e = ahead = vectors[used]
        turn = 1.0
        for _ in range(steps):
            x = np.stack([np.bincount(o, v * ahead[s, d], n) for d in range(DIMENSIONS)], 1)
            wrong = (_softmax(x @ w + bias) - truth) / n
            back = wrong @ w.T
            slope = np.stack([np.bincount(s, v * back[o, d], len(used)) for d in range(DIMENSIONS)], 1)
            moved = ahead - RATE * slope
            length = np.linalg.norm(moved, axis=1, keepdims=True)
            moved *= np.maximum(0, 1 - RATE * PENALTY / np.maximum(length, 1e-12))
            turn, before = (1 + np.sqrt(1 + 4 * turn * turn)) / 2, turn
            ahead, e = moved + (before - 1) / turn * (moved - e), moved
            w -= RATE * (x.T @ wrong)
            bias = bias - 10 * RATE * wrong.sum(0)
        vectors[used] = e
        active = vectors.any(1)
    margin = (vectors @ (w[:, 1] - w[:, 0])) * scale
    return {"slots": margin.astype(np.float32), "bias": float(bias[1] - bias[0])}


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


class Scorer:
    """Scores of whole texts."""

    def __init__(self, model: dict):
        self.model = model

    def _words(self, chars: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, at, which = np.unique(bpe.hashes(chars, begin, end), return_index=True, return_inverse=True)
        slots, owner = grams_of(chars, begin[at], end[at])
        total = np.bincount(owner, self.model["slots"][slots], len(at)) / np.bincount(owner, minlength=len(at))
        return total[which]

    def __call__(self, texts: list[str | None]) -> Iterator[float]:
        waiting: list[list[str]] = []
        held = 0
        for text in texts:
            waiting.append(list(bpe.slices(text)) if text else [""])
            held += len(text or "")
            if held > bpe.SLICE:
                yield from self._scores(waiting)
                waiting, held = [], 0
        yield from self._scores(waiting)

    def _scores(self, waiting: list[list[str]]) -> Iterator[float]:
        total, count = np.zeros(len(waiting)), np.zeros(len(waiting))
        owners = [i for i, parts in enumerate(waiting) for _ in parts]
        parts = [p for parts in waiting for p in parts]
        at = 0
        while at < len(parts):
            upto, held = at, 0
            while upto < len(parts) and (upto == at or held + len(parts[upto]) <= bpe.SLICE):
                held += len(parts[upto])
                upto += 1
            chars, begin, end, which = words_of(parts[at:upto])
            if len(begin):
                mine = np.array(owners[at:upto])[which]
                total += np.bincount(mine, self._words(chars, begin, end), len(waiting))
                count += np.bincount(mine, minlength=len(waiting))
            at = upto
        margin = total / np.maximum(count, 1) + self.model["bias"]
        return iter((1 / (1 + np.exp(-np.clip(margin, -500, 500)))).tolist())


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> dict:
    """The model for at most ``rows`` rows of ``labelled`` (those with the least hash of their id; null labels don't count).

    Features are made where the rows are, and summed up there for the first gradient; the driver gets those of the sample
    whose gradient stands out.
    """
    key, text, label = (F.col(f"`{c}`") for c in (id_col, text_col, label_col))
    few = labelled.where(label.isNotNull()).select(key.cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text"), label.cast("int").alias("label"))
    few = few.orderBy(F.xxhash64("id"), "id", "text", "label").limit(rows)

    def make(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                found = [features(t) for t in part.column(0).to_pylist()]
                yield {"slots": [s.astype(np.int32) for s, _ in found], "weights": [w for _, w in found], "label": part.column(1)}

    schema = "slots array<int>, weights array<float>, label int"
    spread = few.select("text", "label").repartition(max(8, rows // 250))  # the limit leaves the sample in one task
    table = written(map_batches(spread, make, schema), "features")
    n, positive = table.agg(F.count("*"), F.coalesce(F.avg((F.col("label") > 0).cast("double")), F.lit(0.0))).first()
    pairs = table.select((F.col("label") > 0).cast("double").alias("y"), F.explode(F.arrays_zip("slots", "weights")).alias("f")).select("y", "f.*")
    x = F.col("weights").cast("double")
    sums = pairs.groupBy("slots").agg(F.count("*").alias("rows"), F.sum(x * x).alias("square"), F.sum(x * (F.lit(positive) - F.col("y"))).alias("slope"))
    size = F.lit(1.0) / (F.sqrt(F.col("square") / max(1, n)) + 1e-5)
    good = (F.col("rows") >= min(LEAST_ROWS, max(1, n // 20))) & (F.abs(F.col("slope")) * F.col("scale") / max(1, n) >= SCREEN * PENALTY)
    chosen = sums.withColumn("scale", size).where(good).select("slots", "scale").toPandas()  # BUCKETS rows at most
    scale = np.zeros(BUCKETS)
    scale[chosen["slots"].to_numpy(int)] = chosen["scale"]

    def keep(batches):
        for batch in batches:
            slots, weights = (batch.column(i).flatten().to_numpy() for i in range(2))
            ends = np.cumsum(batch.column(0).value_lengths().to_numpy())
            good = scale[slots] > 0
            kept = np.concatenate([[0], np.cumsum(good)])[ends]
            yield {"slots": np.split(slots[good], kept)[:-1], "weights": np.split(weights[good], kept)[:-1], "label": batch.column(2)}

    got = map_batches(table, keep, schema).toArrow()
    flat = [(np.asarray(got.column(0)[i].values), np.asarray(got.column(1)[i].values)) for i in range(got.num_rows)]
    return train(flat, (got.column(2).to_numpy() > 0).astype(int) if got.num_rows else np.zeros(0, int), scale)


def scores(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (0 to 1) and predicted (1 from 0.5 on) of every row's whole text.

    A text that is null or has no letter gets the score of the bias alone. Repeated rows stay; an empty table gives an
    empty one; other columns are not read.
    """

    def rows(batches):
        scorer = Scorer(model)
        for batch in batches:
            found = list(scorer(batch.column(1).to_pylist()))
            yield {"id": batch.column(0), "score": found, "predicted": [int(s >= 0.5) for s in found]}

    few = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_batches(few, rows, "id bigint, score double, predicted int").withColumnRenamed("id", id_col)


def labelled(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text and toxic of at most ``rows`` labelled ids outside the fold that is held out.

    Of several labels of one id the largest counts. The ids are chosen in the table of labels, so that the documents are
    scanned without a shuffle: the broadcast side has ``rows`` rows at most.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != out))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def clean(df: DataFrame, model: dict, text_col: str = "text", most: float = 0.5) -> DataFrame:
    """The rows, with all columns, whose text scores below ``most``; a null text has the score of the bias alone."""
    return filter_batches(df, text_col, lambda texts: [s < most for s in Scorer(model)(texts)])
