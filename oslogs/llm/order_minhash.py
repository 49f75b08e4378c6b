"""Near-duplicate documents by order MinHash.

A text's words give shingles of five words, each labelled with how often it has occurred before. For each of many hash functions
the few least labelled shingles are taken and kept in the order of the text, so that two texts agree on a sketch with a
probability that follows their edit similarity. As scattered edits leave few shingles whole, as many sketches hold the single
least shingle; texts of up to BRIEF words have more of three-word shingles, and those of up to EXACT words have their
word-deletion neighbourhood, which no link of 0.8 escapes. Texts that share a sketch are candidates; a candidate pair is a link
if a banded alignment of its words proves a similarity (1 - edits / longer length) of at least 0.8.

Equal texts are one class and compared once, and sketches that the same texts share count as one. A sketch that many texts
share never yields all their pairs: every text is aligned with two leaders of the sketch, and those that are near neither with
two of their own, as long as a crowd is left.
Then the texts of a sketch that lie in different components are compared: those of a sketch of few texts by a plain join, those
of a crowd in blocks, the texts outside its largest component with all others. Pairs are aligned where lengths and word counts
leave room for the similarity asked for. So no link between two components is lost, and no pair within one is ever made.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oslogs.llm.common import discard, map_batches, written
from oslogs.llm.components import components

SHINGLE = 5  # words
LEAST = 2  # labelled shingles of a sketch
ORDERED = 24  # sketches of LEAST shingles
SKETCHES = ORDERED + 24  # the others are of one shingle
BRIEF = 64  # words of a text that also has sketches of shorter shingles
BRIEF_SHINGLE = 3  # words
BRIEF_SKETCHES = 24
EXACT = 14  # words of a text that also has its word deletions as sketches
SIMILARITY = 0.8
BLOCK = 512  # texts of a sketch that are compared at a time

FEW = 16  # texts of a sketch that are joined with each other outright
CROWD = 64  # texts of a sketch that are near no leader and are yet not led again
ROUNDS = 2  # of leaders, at most; how many there are decides about time, not about results
FEWER = 128  # counters of words, for a lower bound of the edits between two texts
COUNTERS = 1024  # the same for texts of more than MANY words; they add up to the fewer ones
MANY = 512
STRIP = 1 << 16  # shingles of a text that are hashed at a time
SLOTS = 1 << 18  # of the map of ids that every task gets, with 64 bits each

_WORD = re.compile(r"\w+")
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 63, SKETCHES + BRIEF_SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9FB21C651E98DF25)
_REMEMBERED = 400_000  # words whose numbers a worker keeps


class Words:
    """Numbers (32 bit) of words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall(text.lower()) if text else []
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        known = self.known
        for w in words:
            if w not in known:
                known[w] = zlib.crc32(w.encode())
        return np.fromiter(map(known.__getitem__, words), np.uint32, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return x ^ (x >> np.uint64(29))


def _labelled(words: np.ndarray, size: int) -> np.ndarray:
    """The labelled shingles of a text with at least one word."""
    n = max(1, len(words) - size + 1)
    x = words.astype(np.uint64)
    with np.errstate(over="ignore"):
        keys = np.zeros(n, np.uint64)
        for i in range(min(size, len(words))):
            keys = _mixed(keys + x[i : i + n] + np.uint64(i))
        # the occurrence number of each shingle
        order = np.argsort(keys, kind="stable")
        first = np.r_[True, keys[order][1:] != keys[order][:-1]]
        seen = np.empty(n, np.uint64)
        seen[order] = np.arange(n) - np.flatnonzero(first)[np.cumsum(first) - 1]
        return _mixed(keys + seen * np.uint64(0x632BE59BD9B4E019))


def _least(labelled: np.ndarray, factors: np.ndarray, many: int) -> np.ndarray:
    """For each factor the places, in the order of the text, of the ``many`` least labelled shingles (all, if fewer)."""
    places = np.zeros((len(factors), 0), np.int64)
    with np.errstate(over="ignore"):
        for at in range(0, len(labelled), STRIP):
            values = labelled[None, at : at + STRIP] * factors[:, None]
            if values.shape[1] > many:
                new = np.argpartition(values, many - 1, axis=1)[:, :many] if many > 1 else values.argmin(1)[:, None]
            else:
                new = np.broadcast_to(np.arange(values.shape[1]), values.shape)
            places = np.concatenate([places, new + at], axis=1)
            if places.shape[1] > many:
                best = np.argsort(labelled[places] * factors[:, None], axis=1, kind="stable")[:, :many]
                places = np.take_along_axis(places, best, axis=1)
    return np.sort(places, axis=1)


def sketches(words: np.ndarray) -> np.ndarray:
    """The sketches of a text with at least one word: ORDERED of LEAST shingles in their order, then those of one shingle.

    Very long texts are hashed in strips, so that memory does not grow with the number of sketches.
    """
    labelled = _labelled(words, SHINGLE)
    chosen = _least(labelled, _FACTORS[:ORDERED], LEAST)
    with np.errstate(over="ignore"):
        out = np.zeros(SKETCHES, np.uint64)
        for i in range(chosen.shape[1]):
            out[:ORDERED] = _mixed(out[:ORDERED] + labelled[chosen[:, i]])
        out[ORDERED:] = _mixed(labelled[_least(labelled, _FACTORS[ORDERED:SKETCHES], 1)[:, 0]])
        return (out ^ np.arange(SKETCHES, dtype=np.uint64)).view(np.int64)


@lru_cache(maxsize=None)
def _left(n: int, gone: int) -> np.ndarray:
    """The places that are left of n where some are gone, a row for each choice."""
    return np.array(list(combinations(range(n), n - gone)), np.int64).reshape(-1, n - gone)


def brief(words: np.ndarray) -> np.ndarray:
    """Further sketches of a text of 1 to BRIEF words: of shorter shingles and, up to EXACT words, of what word deletions leave.

    Two texts that k edits part have a sequence in common that k deletions or fewer leave of each, so every link of at
    least SIMILARITY between texts of up to EXACT words shares such a sketch.
    """
    n = len(words)
    if not 0 < n <= BRIEF:
        return np.zeros(0, np.int64)
    x = words.astype(np.uint64)
    with np.errstate(over="ignore"):
        labelled = _labelled(words, BRIEF_SHINGLE)
        least = labelled[(labelled[None, :] * _FACTORS[SKETCHES:, None]).argmin(1)]
        out = [_mixed(least + np.uint64(BRIEF_SHINGLE)) ^ np.arange(SKETCHES, SKETCHES + BRIEF_SKETCHES, dtype=np.uint64)]
        allowed = {m: int((1 - SIMILARITY) * m + 1e-9) for m in range(n, EXACT + 1)}
        for gone in range(1 + max((k for m, k in allowed.items() if m - n <= k), default=-1)):
            left = _left(n, gone)
            keys = np.full(len(left), 0x2545F4914F6CDD1D, np.uint64)
            for i in range(left.shape[1]):
                keys = _mixed(keys + x[left[:, i]])
            out.append(keys)
    return np.unique(np.concatenate(out)).view(np.int64)


def counted(words: np.ndarray) -> bytes:
    """How many words fall to each counter (255 at most).

    What one text has beyond another, summed over the counters, never exceeds the words that it has and the other lacks,
    and so never exceeds the edits between them.
    """
    many = COUNTERS if len(words) > MANY else FEWER
    return np.minimum(np.bincount(words % many, minlength=many), 255).astype(np.uint8).tobytes()


def _fewer(counters: list[bytes]) -> np.ndarray:
    """FEWER counters of each text."""
    out = np.empty((len(counters), FEWER), np.int16)
    for i, c in enumerate(counters):
        c = np.frombuffer(c, np.uint8)
        out[i] = c if len(c) == FEWER else np.minimum(c.reshape(-1, FEWER).sum(0, dtype=np.int32), 255)
    return out


def _room(f: list[bytes], g: list[bytes], i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether the counters of the texts f[i] and g[j] allow for as few edits as ``most``."""
    x, y = _fewer(f), _fewer(g)
    near = np.zeros(len(i), bool)
    for at in range(0, len(i), 8192):
        apart = x[i[at : at + 8192]] - y[j[at : at + 8192]]
        near[at : at + 8192] = np.maximum(np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1)) <= most[at : at + 8192]
    for p in np.flatnonzero(near):
        a, b = f[i[p]], g[j[p]]
        if len(a) == len(b) == COUNTERS:
            apart = np.frombuffer(a, np.uint8).astype(np.int16) - np.frombuffer(b, np.uint8)
            near[p] = max(apart[apart > 0].sum(), -apart[apart < 0].sum()) <= most[p]
    return near


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two word sequences, or most + 1 where it is greater.

    The alignment runs in a band of ``most`` places to either side of the diagonal. The band's column of the dynamic
    programming table is held in two bit vectors of differences, which every word moves down by one place.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    n = len(a)
    differ = np.flatnonzero(a != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = len(a)
    differ = np.flatnonzero(a[::-1] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: n - tail], b[: len(b) - tail]
    if not len(a):
        return len(b) if len(b) <= most else most + 1
    # words that either side has alone bound the distance from below
    words, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    surplus = np.bincount(which[: len(a)], minlength=len(words)) - np.bincount(which[len(a) :], minlength=len(words))
    if max(surplus[surplus > 0].sum(), -surplus[surplus < 0].sum()) > most:
        return most + 1
    first, second = which[: len(a)].tolist(), which[len(a) :].tolist()
    band = max(16, len(b) - len(a))
    while True:
        band = min(band, most)
        found = _banded(first, second, band)
        if found <= band or band == most:
            return found
        band *= 4


def _banded(a: list[int], b: list[int], band: int) -> int:
    """Edit distance if it is at most ``band``, else band + 1 (len(b) - len(a) is at most band).

    Column j of the table is held for the rows j - band ... j + band, bit by bit: ``more`` and ``less`` say where a cell is one
    more or one less than the cell above it. Rows above the table count down to its first row. Each column moves the
    band one row down; the last cell's diagonal always has the same bit, so its value is summed up on the way.
    """
    full = (1 << 2 * band + 1) - 1
    less = (1 << band + 1) - 1
    more = full ^ less
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    value, diagonal, top = len(b) - len(a), 1 << (len(a) - len(b) + band), 1 << 2 * band
    get = places.get
    shift = band
    for w in b:
        more = more >> 1 | top
        less >>= 1
        equal = get(w, 0)
        equal = (equal << shift if shift >= 0 else equal >> -shift) & full
        shift -= 1
        same = ((((equal & more) + more) ^ more) | equal | less) & full
        if not same & diagonal:
            value += 1
            if value > band:
                return band + 1
        raised = (less | full & ~(same | more)) << 1
        lowered = (same & more) << 1
        more = (lowered | ~(same | raised)) & full
        less = raised & same
    return value


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether 1 - edits / longer length is at least ``least``."""
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    return edits(a, b, most) <= most


def _sketched(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, key (digest of the text; null for a null text), n, sketches (none for a text without words), counters and the words' numbers."""

    def rows(batches):
        number = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(2).to_pylist()
                words = [number(t) for t in texts]
                yield {
                    "row": part.column(0), "id": part.column(1), "key": [hashlib.md5(t.encode()).digest() if t is not None else None for t in texts],
                    "n": [len(w) for w in words], "sketches": [np.concatenate([sketches(w), brief(w)]) if len(w) else [] for w in words],
                    "counters": [counted(w) for w in words], "words": [w.astype("<u4").tobytes() for w in words],
                }

    few = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_batches(few, rows, "row bigint, id bigint, key binary, n int, sketches array<bigint>, counters binary, words binary")


def _marked(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows with maybe: false only where the column's value is none of the ids (one bigint column).

    The ids are bits of a broadcast map whose size has a bound, however many they are, so that wide rows which they do not
    concern need no shuffle. What is true may be wrong: an exact join has to follow.
    """
    h = F.xxhash64(F.col(ids.columns[0]))
    place = lambda h: F.pmod(h, F.lit(SLOTS))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, 20), F.lit(64)).cast("int"))
    slots = ids.groupBy(place(h).alias("slot")).agg(F.bit_or(bit(h)).alias("bits"))
    found = F.xxhash64(F.col(column))
    both = rows.join(F.broadcast(slots), place(found) == F.col("slot"), "left")
    return both.withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(bit(found)) != 0, F.lit(False))).drop("slot", "bits")


def _possible(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose lengths and counters leave room for the similarity."""

    def rows(batches):
        for batch in batches:
            n, m = (np.asarray(batch.column(k)) for k in (2, 4))
            every = np.arange(batch.num_rows)
            good = _room(batch.column(3).to_pylist(), batch.column(5).to_pylist(), every, every, (1 - least) * np.maximum(n, m) + 1e-9)
            yield {"a": np.asarray(batch.column(0))[good], "b": np.asarray(batch.column(1))[good]}

    both = pairs.join(classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("counters").alias("ca")), "a").join(
        classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("counters").alias("cb")), "b")
    both = both.where(F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-9)
    return map_batches(both.select("a", "b", "na", "ca", "nb", "cb"), rows, "a bigint, b bigint")


def _verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b), a written table, with linked, by alignment of their words; the words of hardly any other texts are shuffled."""

    def rows(batches):
        for batch in batches:
            ok = [similar(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), least) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield {"a": batch.column(0), "b": batch.column(1), "linked": ok}

    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "named")
    own = _marked(words, "id", ids).where("maybe").select("id", "words").join(ids, "id", "left_semi")
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a").join(
        own.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
    out = written(map_batches(both.select("a", "b", "wa", "wb"), rows, "a bigint, b bigint, linked boolean"), "verified")
    discard(ids)
    return out


def _agreeing(least: float):
    """Pairs of texts in the rows' groups (sorted by v, lane, x, y) of different components that agree in length and in words."""

    def run(frames):
        def pairs(rows: list[pd.DataFrame]) -> pd.DataFrame:
            group = pd.concat(rows)
            left, right = group[group["left"]], group[~group["left"]]
            alone = group["x"].iloc[0] == group["y"].iloc[0]
            if alone:
                right = left
            a, b = left["rep"].to_numpy(), right["rep"].to_numpy()
            if not len(a) or not len(b):
                return pd.DataFrame({"a": [], "b": []}, dtype="int64")
            n, m = left["n"].to_numpy(), right["n"].to_numpy()
            c, d = left["component"].to_numpy(), right["component"].to_numpy()
            good = (np.minimum(n[:, None], m[None, :]) >= least * np.maximum(n[:, None], m[None, :]) - 1e-9) & (c[:, None] != d[None, :])
            i, j = np.nonzero(np.triu(good) if alone else good)
            near = _room(left["counters"].tolist(), right["counters"].tolist(), i, j, (1 - least) * np.maximum(n[i], m[j]) + 1e-9)
            i, j = i[near], j[near]
            return pd.DataFrame({"a": np.minimum(a[i], b[j]), "b": np.maximum(a[i], b[j])})

        held: list[pd.DataFrame] = []
        last = None
        for frame in frames:
            for key, part in frame.groupby(["v", "lane", "x", "y"], sort=False):
                if key != last and held:
                    yield pairs(held)
                    held = []
                last = key
                held.append(part)
        if held:
            yield pairs(held)

    return run


def _across(bands: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), possibly repeated, of texts of different components that share a sketch; bands: v, rep, component, n."""
    placed = bands.repartition("v")  # the groupings and the join all find their rows there
    sizes = placed.groupBy("v", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("v").agg(
        F.sum("size").alias("all"), F.max("size").alias("most"), F.max_by("component", "size").alias("main")).where("most < all")
    mixed = written(placed.join(mixed, "v"), "mixed")
    few = mixed.where(F.col("all") <= FEW).select("v", "rep", "component", "n")
    other = few.select("v", F.col("rep").alias("b"), F.col("component").alias("d"), F.col("n").alias("m"))
    fits = F.least("n", "m") >= least * F.greatest("n", "m") - 1e-9
    pairs = few.join(other, "v").where((F.col("rep") < F.col("b")) & (F.col("component") != F.col("d")) & fits).select(F.col("rep").alias("a"), "b").distinct()
    pairs = _possible(pairs, classes, least)
    # blocks of the texts outside the largest component, and of that one; or of all alike, where that makes fewer rows
    outside, blocks = F.col("all") - F.col("most"), lambda n: F.ceil(n / BLOCK)
    apart = outside * (blocks(outside) + blocks(F.col("most"))) + F.col("most") * blocks(outside) < F.col("all") * blocks(F.col("all"))
    crowds = mixed.where(F.col("all") > FEW).select("*", apart.alias("apart"), F.xxhash64("rep", "v").alias("h"))
    dealt = crowds.where((F.col("all") <= BLOCK) | F.col("apart")).select(
        "v", F.lit(0).alias("lane"), "rep", "component", "h", (~F.col("apart") | (F.col("component") != F.col("main"))).alias("own"),
        F.when(F.col("apart"), blocks(outside)).otherwise(1).cast("int").alias("own_blocks"),
        F.when(F.col("apart"), blocks(F.col("most"))).otherwise(0).cast("int").alias("other_blocks"))
    # where all meet all in several blocks, lengths keep most apart: similar texts lie in the same lane or in the next
    lane = F.floor(F.log("n") / (1e-6 - math.log(max(least, 1e-9)))).cast("int")
    lanes = crowds.where((F.col("all") > BLOCK) & ~F.col("apart")).select("v", F.explode(F.array(
        F.struct(lane.alias("lane"), F.lit(True).alias("own")), F.struct((lane + 1).alias("lane"), F.lit(False).alias("own")))).alias("t"), "rep", "component", "h")
    lanes = lanes.select("v", "t.lane", "rep", "component", "h", "t.own")
    sizes = lanes.groupBy("v", "lane").agg(
        blocks(F.count_if("own")).cast("int").alias("own_blocks"), blocks(F.count_if(~F.col("own"))).cast("int").alias("other_blocks")).where("own_blocks > 0")
    dealt = dealt.unionByName(lanes.join(sizes, ["v", "lane"]))
    mine = F.pmod("h", "own_blocks").cast("int")
    theirs = F.col("own_blocks") + F.pmod("h", F.greatest("other_blocks", F.lit(1))).cast("int")
    as_left = F.transform(F.sequence(mine, F.col("own_blocks") + F.col("other_blocks") - 1), lambda y: F.struct(mine.alias("x"), y.alias("y"), F.lit(True).alias("left")))
    before = F.when(mine > 0, F.sequence(F.lit(0), mine - 1)).otherwise(F.array().cast("array<int>"))
    as_right = F.transform(before, lambda x: F.struct(x.alias("x"), mine.alias("y"), F.lit(False).alias("left")))
    visits = F.transform(F.sequence(F.lit(0), F.col("own_blocks") - 1), lambda x: F.struct(x.alias("x"), theirs.alias("y"), F.lit(False).alias("left")))
    dealt = dealt.select("v", "lane", "rep", "component", F.explode(F.when(F.col("own"), F.concat(as_left, as_right)).otherwise(visits)).alias("t")).select("v", "lane", "rep", "component", "t.*")
    dealt = dealt.join(classes.select("rep", "n", "counters"), "rep")
    dealt = dealt.repartition("v", "lane", "x", "y").sortWithinPartitions("v", "lane", "x", "y")
    crowds = dealt.select("v", "lane", "x", "y", "left", "rep", "component", "n", "counters").mapInPandas(_agreeing(least), "a bigint, b bigint")
    out = written(pairs.unionByName(crowds), "across")
    discard(mixed)
    return out


def near_documents(df: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, class_id (the smallest id of its class), copies (rows of the same text) and kept (id = class_id) of every row.

    Equal texts are in one class, and so are texts joined by links of at least ``similarity``. A null text links with
    nothing; an empty text or one without words only with texts equal to it. Rows with a null id have a null class and
    are kept. Rows that share an id share its class. An empty table gives an empty one; other columns are not read.
    The rows are those of a written table; all tables made on the way are deleted.
    """
    table = written(_sketched(df, id_col, text_col), "sketches", "zstd")
    named = table.where(F.col("id").isNotNull() & F.col("key").isNotNull())
    texts = written(named.groupBy("key").agg(F.min("id").alias("rep"), F.min_by("row", "id").alias("row"), F.count("*").alias("copies")), "texts")
    again = written(named.select("row").join(texts.select("row"), "row", "left_anti"), "again")  # rows whose text stands elsewhere
    marked = _marked(named.select("row", F.col("id").alias("rep"), "n", "sketches", "counters"), "row", again)
    classes = marked.where("not maybe").unionByName(marked.where("maybe").join(again, "row", "left_anti"))
    classes = written(classes.select("rep", "n", "sketches", "counters"), "classes")
    words = table.where(F.col("id").isNotNull() & (F.col("n") > 0)).select("id", "words")
    every = classes.select(F.explode("sketches").alias("v"), "rep")
    # most sketches are of one text alone and lead to no pair; those of the same texts get one name (v) and lead to their pairs once
    group = Window.partitionBy("v")
    shared = every.select(
        "rep", F.min("rep").over(group).alias("l1"), F.max("rep").over(group).alias("l2"), F.count("*").over(group).alias("size"),
        F.bit_xor(F.xxhash64("rep")).over(group).alias("all")).where("l1 < l2").withColumn("v", F.xxhash64("l1", "l2", "size", "all"))
    # one row per text: it has a bounded number of sketches
    shared = written(shared.groupBy("rep").agg(F.collect_set(F.struct("v", "l1", "l2", "size")).alias("s")), "shared")
    leaders = lambda s: F.array_except(F.array_union(s["l1"], s["l2"]), F.array("rep"))
    crowds = F.filter("s", lambda x: x["size"] > CROWD)
    pairs = shared.select("rep", F.explode(leaders(F.col("s"))).alias("leader"))
    known = None
    made = [table, texts, again, classes, shared]
    for number in range(ROUNDS):
        pairs = pairs.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
        if known is not None:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
        pairs = written(_possible(pairs, classes, similarity), "pairs")
        found = _verified(pairs, words, similarity)
        discard(pairs)
        made.append(found)
        known = found if known is None else known.unionByName(found)
        if number == ROUNDS - 1:
            break
        # texts of crowds that are near neither leader of a sketch, and are no leader themselves
        tried = shared.select("rep", F.explode(leaders(crowds)).alias("leader"))
        near = tried.join(known.where("linked"), (F.least("rep", "leader") == F.col("a")) & (F.greatest("rep", "leader") == F.col("b")), "left_semi")
        near = near.groupBy("rep").agg(F.collect_set("leader").alias("near"))  # of the few leaders of a text
        near = shared.select("rep", crowds.alias("s")).where(F.size("s") > 0).join(near, "rep", "left")
        met = F.array_append(F.coalesce("near", F.array().cast("array<bigint>")), F.col("rep"))
        rest = near.select("rep", F.explode(F.filter("s", lambda x: ~F.array_contains(met, x["l1"]) & ~F.array_contains(met, x["l2"]))["v"]).alias("v"))
        rest = written(rest, "rest")
        made.append(rest)
        led = rest.groupBy("v").agg(F.min("rep").alias("l1"), F.max("rep").alias("l2"), F.count("*").alias("size")).where((F.col("l1") < F.col("l2")) & (F.col("size") > CROWD))
        pairs = rest.join(led, "v").select("rep", F.explode(F.array("l1", "l2")).alias("leader")).where("rep != leader")
    roots = components(known.where("linked"), "a", "b")
    placed = classes.join(roots, F.col("rep") == F.col("id"), "left").select("rep", F.coalesce("component", "rep").alias("component"), "n")
    bands = written(shared.join(placed, "rep").select(F.explode(F.col("s.v")).alias("v"), "rep", "component", "n"), "bands")
    across = _across(bands, classes, similarity)
    more = written(across.distinct().join(known.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    found = _verified(more, words, similarity)
    roots2 = components(roots.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(found.where("linked").select("a", "b")), "a", "b")
    named = texts.join(roots2, F.col("rep") == F.col("id"), "left").select(F.col("key").alias("k"), F.coalesce("component", "rep").alias("component"), "copies")
    out = table.select("id", "key").join(named, F.col("key") == F.col("k"), "left")
    component = F.coalesce("component", "id")
    out = written(out.select(
        F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), component).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept")), "near")
    discard(*made, roots, bands, across, more, found, roots2)
    return out


def one_of_each(df: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all columns, of one document of each class: the one with the smallest id.

    Of rows that share that id one stays; rows with a null id all stay, and so does one row of each id with a null text.
    """
    kept = near_documents(df, similarity, id_col, text_col).where(F.col("kept") & F.col(f"`{id_col}`").isNotNull()).select(id_col).distinct()
    known = df.where(F.col(f"`{id_col}`").isNotNull()).join(kept, id_col, "left_semi").dropDuplicates([id_col])
    return known.select(df.columns).unionByName(df.where(F.col(f"`{id_col}`").isNull()))
