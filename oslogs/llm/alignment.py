"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and links between tokens that overlap.

Byte offsets where tokens of both sides end cut a text into groups. Any range of bytes of a text, wherever it is cut, yields a
fragment: an open prefix (tokens up to the first common end, whose group may have begun earlier), closed groups, and an open
suffix (tokens after the last common end). Fragments of neighbouring ranges compose, and the composition is associative: the
open suffix of the left one and the open prefix of the right one make one group. So a very long text is dealt in ranges over
tasks and its open ends are composed pair by pair, in a tree; closed groups stay where they are, and are only put in order for
the digest. A text of one range is a fragment without open ends.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oslogs.llm import bpe
from oslogs.llm.common import map_batches, written

RANGE = 1 << 16  # bytes of a text that make one fragment
BATCH = 1 << 18  # code points that are tokenized at a time
BLOCK = 1 << 22  # links whose counts are fetched together
STRIP = 1 << 19  # links that are summed at a time, where one row has no more
ID_BITS = 20  # an open token is kept as its end, shifted by this, and its id

_CUT = re.compile(r"(?<=\w) (?=\w)")  # a single blank between two words: a pre-token of either tokenizer starts here
_OPEN = "closed boolean, prefix_a array<bigint>, prefix_b array<bigint>, suffix_a array<bigint>, suffix_b array<bigint>"


class Tokenizers:
    """Both tokenizers and the bytes of their tokens, by id."""

    def __init__(self, path_a: str, path_b: str):
        vocabulary = bpe.Vocabulary(path_a)
        for special in vocabulary.added.values():
            vocabulary.bytes.pop(special, None)
        vocabulary.added = {}  # their strings are plain text
        self.a = bpe.Encoder(vocabulary, bpe.Rounds(vocabulary))
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError(f"pieces of {path_b} run over white space, so long texts can't be cut there")
        self.bytes_a = [vocabulary.bytes.get(i, b"") for i in range(vocabulary.size)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.width = len(self.bytes_b)
        self.pair = np.dtype("<u4" if len(self.bytes_a) * self.width < 1 << 32 else "<i8")
        ids = np.arange(max(len(self.bytes_a), self.width))
        powers = 10 ** np.arange(len(str(len(ids))) - 1, -1, -1)
        #: decimal digits of every id, and which of them are written
        self.digits = (ids[:, None] // powers % 10 + 48).astype(np.uint8)
        self.shown = (ids[:, None] >= powers) | (powers == 1)

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of both sides for texts that start with the blank that stands before every text, and whether both give its bytes."""
        for text, a, b in zip(texts, self.a.encode(texts), self.b.encode([t[1:] for t in texts], num_threads=1)):
            raw = text.encode()
            yield a, np.array(b, np.int64), all(b"".join(map(of.__getitem__, ids)) == raw for of, ids in ((self.bytes_a, a.tolist()), (self.bytes_b, b)))

    def links(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs of a stretch that both sides cover, in order, and where each ends: one at every end of either side."""
        ends = np.union1d(a_ends, b_ends)
        return (a[np.searchsorted(a_ends, ends)] * self.width + b[np.searchsorted(b_ends, ends)]).astype(self.pair), ends

    def text(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;`` for every group, as bytes, and where each group's text ends."""
        per_a, per_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        place_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[a_group]
        place_b = np.arange(len(b)) + np.cumsum(per_a)[b_group]
        total, wide = len(a) + len(b), self.digits.shape[1] + 1
        chars, shown = np.empty((total, wide), np.uint8), np.ones((total, wide), bool)
        for ids, place, group, last in ((a, place_a, a_group, b"|"), (b, place_b, b_group, b";")):
            chars[place, :-1], shown[place, :-1] = self.digits[ids], self.shown[ids]
            chars[place, -1] = np.where(np.append(group[1:] != group[:-1], True), last[0], ord(",")) if len(group) else 0
        sizes = np.concatenate([[0], np.cumsum(shown.sum(1))])
        return chars[shown], sizes[np.cumsum(per_a + per_b)]


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Once per worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Tokenizers(path_a, path_b)
    return _LOADED[path_a, path_b]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches that end at the given places, empty ones included."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends], prepend=0)


class _Blocks:
    """Numbers of blocks of a task's rows, of about ``BLOCK`` links each."""

    def __init__(self):
        from pyspark import TaskContext

        self.next, self.held = TaskContext.get().partitionId() << 32, 0

    def number(self, links: int) -> int:
        if self.held + links > BLOCK:
            self.next, self.held = self.next + 1, 0
        self.held += links
        return self.next


_ROW = "block bigint, row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"


def _short(few: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows of texts of one range."""

    def batch(both: Tokenizers, ids: list, texts: list[str], blocks: _Blocks) -> dict:
        found = [t if t[2] else (t[0][:0], t[1][:0], True) for t in both.tokens([" " + t if t else "" for t in texts])]
        a, b = (np.concatenate([t[i] for t in found]).astype(np.int64) for i in (0, 1))
        n_a, n_b = (np.array([len(t[i]) for t in found]) for i in (0, 1))
        a_ends, b_ends = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
        links, link_ends = both.links(a, a_ends, b, b_ends)
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        text, text_ends = both.text(a, np.searchsorted(common, a_ends), b, np.searchsorted(common, b_ends), len(common))
        doc_ends = np.concatenate([[0], a_ends])[np.cumsum(n_a)]
        group_ends, ends = np.searchsorted(common, doc_ends, "right"), np.searchsorted(link_ends, doc_ends, "right")
        text_cut = np.concatenate([[0], text_ends])[group_ends]
        raw, at, digests = text.tobytes(), 0, []
        for end in text_cut.tolist():
            digests.append(hashlib.sha256(raw[at : end - 1]).hexdigest() if end > at else "")
            at = end
        flat, first = links.tobytes(), np.concatenate([[0], ends[:-1]]) * links.itemsize
        return {
            "block": [blocks.number(len(links))] * len(ids), "row": [None] * len(ids), "doc_id": ids, "n_a": n_a, "n_b": n_b,
            "n_groups": np.diff(group_ends, prepend=0), "groups_sha256": digests,
            "links": [flat[i:j] for i, j in zip(first.tolist(), (ends * links.itemsize).tolist())],
        }

    def rows(batches):
        both, blocks = tokenizers(*paths), _Blocks()
        for table in batches:
            texts, ids = [t or "" for t in table.column(1).to_pylist()], table.column(0).to_pylist()
            part = np.cumsum([len(t) for t in texts]) // BATCH
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
            for i, j in zip(cuts, cuts[1:]):
                if j > i:
                    yield batch(both, ids[i:j], texts[i:j], blocks)

    return map_batches(few, rows, _ROW)


def ranges(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(lo, hi, start, part): byte ranges of a text with its blank, each with the part, from byte start on, that decides its tokens.

    A range may begin and end anywhere, within a word or a letter. The part reaches from the last cut before the range to the
    first one after it, where both tokenizers start anew. Where there is no cut for long, the range is made to reach further, so
    that no stretch is read by more than two ranges.
    """
    text = " " + text
    raw = np.frombuffer(text.encode(), np.uint8)
    total, lo, letters = len(raw), 0, 0  # letters: those that start before lo
    begin = begin_byte = 0  # last cut that is not after lo
    while lo < total:
        hi = min(lo + RANGE, total)
        at = letters + int(np.count_nonzero(raw[lo:hi] & 0xC0 != 0x80))
        found = _CUT.search(text, at)
        end = found.start() if found else len(text)
        span = len(text[at:end].encode())
        further = span // RANGE * RANGE
        if further and hi < total:
            at += int(np.count_nonzero(raw[hi : hi + further] & 0xC0 != 0x80))
            hi = min(hi + further, total)
        yield lo, hi, begin_byte, text[begin:end]
        # the next range's part begins at the last cut that is not after its first byte
        latest = at - int(hi < total and raw[hi] & 0xC0 == 0x80)
        back = 256
        while hi < total:
            low = max(begin, latest - back)
            last = None
            for last in _CUT.finditer(text, max(low, 1), latest + 2):
                pass
            if last and last.start() > begin:
                begin_byte += len(text[begin : last.start()].encode())
                begin = last.start()
                break
            if low == begin:
                break
            back *= 4
        lo, letters = hi, at


def _pieces(few: DataFrame) -> DataFrame:
    """One row per range of each long text."""

    def rows(batches):
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for k, (lo, hi, start, part) in enumerate(ranges(text)):
                    yield {"row": [row], "doc_id": [doc_id], "k": [k], "lo": [lo], "hi": [hi], "start": [start], "part": [part]}

    numbered = few.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    return map_batches(numbered, rows, "row bigint, doc_id bigint, k bigint, lo bigint, hi bigint, start bigint, part string")


def fragment(both: Tokenizers, lo: int, hi: int, start: int, part: str) -> dict:
    """The fragment of one range: open prefix, closed groups (their text and links), open suffix."""
    a, b, good = next(both.tokens([part]))
    a = a.astype(np.int64)
    empty = np.zeros(0, np.int64)
    out = {"good": good, "n_a": 0, "n_b": 0, "closed": False, "n_groups": 0, "body": b"", "links": b""} | dict.fromkeys(("prefix_a", "prefix_b", "suffix_a", "suffix_b"), empty)
    if not good:
        return out
    sides = []
    for ids, length in ((a, both.length_a), (b, both.length_b)):
        ends = start + np.cumsum(length[ids])
        mine = (ends > lo) & (ends <= hi)
        sides.append((ids[mine], ends[mine]))
    (a, a_ends), (b, b_ends) = sides
    out |= {"n_a": len(a), "n_b": len(b)}
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    packed_a, packed_b = a_ends << ID_BITS | a, b_ends << ID_BITS | b
    if not len(common):
        return out | {"prefix_a": packed_a, "prefix_b": packed_b}
    cut_a, cut_b = np.searchsorted(a_ends, common[[0, -1]], "right"), np.searchsorted(b_ends, common[[0, -1]], "right")
    out |= {"closed": True, "prefix_a": packed_a[: cut_a[0]], "prefix_b": packed_b[: cut_b[0]], "suffix_a": packed_a[cut_a[1] :], "suffix_b": packed_b[cut_b[1] :]}
    inner_a, inner_b = slice(*cut_a), slice(*cut_b)
    return out | _closed(both, a[inner_a], a_ends[inner_a], b[inner_b], b_ends[inner_b])


def _closed(both: Tokenizers, a, a_ends, b, b_ends) -> dict:
    """Whole groups: how many, their text, their links."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    text, _ = both.text(a, np.searchsorted(common, a_ends), b, np.searchsorted(common, b_ends), len(common))
    return {"n_groups": len(common), "body": text.tobytes(), "links": both.links(a, a_ends, b, b_ends)[0].tobytes()}


def _fragments(pieces: DataFrame, paths: tuple[str, str]) -> DataFrame:
    def rows(batches):
        both, blocks = tokenizers(*paths), _Blocks()
        for batch in batches:
            for doc in batch.to_pylist():
                made = fragment(both, doc["lo"], doc["hi"], doc["start"], doc["part"])
                number = blocks.number(len(made["links"]) // both.pair.itemsize)
                yield {name: [value] for name, value in made.items()} | {"block": [number]} | {c: [doc[c]] for c in ("row", "doc_id", "k")}

    return map_batches(pieces, rows, f"block bigint, row bigint, doc_id bigint, k bigint, good boolean, n_a bigint, n_b bigint, {_OPEN}, n_groups bigint, body binary, links binary")


def composed(opens: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The next level of the tree, from row, node and the open ends: (parents, groups that the composition closes).

    A group carries k, the first range right of where it was open; ``level`` widths of ranges are in node_width.
    """
    ends = F.struct("closed", "prefix_a", "prefix_b", "suffix_a", "suffix_b")
    even = F.col("node") % 2 == 0
    both = opens.groupBy("row", F.shiftright("node", 1).alias("node"), F.col("width")).agg(
        F.first(F.when(even, ends), ignorenulls=True).alias("l"), F.first(F.when(~even, ends), ignorenulls=True).alias("r"))
    alone, l, r = F.col("r").isNull(), F.col("l.closed"), F.col("r.closed")

    def side(s: str) -> list:
        prefix, suffix = f"prefix_{s}", f"suffix_{s}"
        return [
            F.when(alone | l, F.col(f"l.{prefix}")).otherwise(F.concat(f"l.{prefix}", f"r.{prefix}")).alias(prefix),
            F.when(alone | ~l & ~r, F.col(f"l.{suffix}")).when(r, F.col(f"r.{suffix}")).otherwise(F.concat(f"l.{suffix}", f"r.{prefix}")).alias(suffix),
        ]

    parents = both.select("row", "node", (F.col("width") * 2).alias("width"), (l | (~alone & r)).alias("closed"), *side("a"), *side("b"))
    # an open left part goes into the prefix as a whole; a closed right part then gives the suffix
    groups = both.where(~alone & l & r).select(
        "row", ((F.col("node") * 2 + 1) * F.col("width")).alias("k"),
        F.concat("l.suffix_a", "r.prefix_a").alias("a"), F.concat("l.suffix_b", "r.prefix_b").alias("b"))
    return written(parents, f"{name}-open"), written(groups, f"{name}-groups")


def _long(few: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows of texts of several ranges: one with the digest, and one for the links of each fragment and composed group."""
    pieces = written(_pieces(few), "ranges")
    most = pieces.agg(F.max("k")).first()[0]
    if most is None:
        return few.sparkSession.createDataFrame([], _ROW)
    fragments = written(_fragments(pieces.repartition("row", "k"), paths), "fragments")
    totals = fragments.groupBy("row").agg(F.min("good").alias("good"), F.max("doc_id").alias("doc_id"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    good = written(totals, "long-texts")
    keep = good.where("good").select("row")
    fragments = fragments.join(keep, "row")
    opens = fragments.select("row", F.col("k").alias("node"), F.lit(1).cast("bigint").alias("width"), "closed", "prefix_a", "prefix_b", "suffix_a", "suffix_b")
    groups = None
    for level in range(math.ceil(math.log2(most + 1)) if most else 0):
        opens, closed = composed(opens, f"level-{level}")
        groups = closed if groups is None else groups.union(closed)
    first = opens.select("row", F.lit(0).cast("bigint").alias("k"), F.col("prefix_a").alias("a"), F.col("prefix_b").alias("b"))
    groups = first if groups is None else groups.union(first)

    def close(batches):
        both, blocks = tokenizers(*paths), _Blocks()
        for batch in batches:
            for doc in batch.to_pylist():
                a, b = np.array(doc["a"], np.int64), np.array(doc["b"], np.int64)
                low = (1 << ID_BITS) - 1
                made = _closed(both, a & low, a >> ID_BITS, b & low, b >> ID_BITS)
                yield {name: [value] for name, value in made.items()} | {"row": [doc["row"]], "k": [doc["k"]], "inner": [0], "block": [blocks.number(len(a) + len(b))]}

    schema = "block bigint, row bigint, k bigint, inner int, n_groups bigint, body binary, links binary"
    inner = fragments.select("block", "row", "k", F.lit(1).alias("inner"), "n_groups", "body", "links")
    parts = written(map_batches(groups, close, schema).unionByName(inner), "closed-groups")

    def digest(batches):
        row, sha = None, None
        for batch in batches:
            for now, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now != row:
                    if sha is not None:
                        yield {"row": [row], "groups_sha256": [sha.hexdigest()]}
                    row, sha, begun = now, hashlib.sha256(), False
                if body:
                    sha.update(b";" + body[:-1] if begun else body[:-1])
                    begun = True
        if sha is not None:
            yield {"row": [row], "groups_sha256": [sha.hexdigest()]}

    in_order = parts.select("row", "body", "k", "inner").repartition("row").sortWithinPartitions("row", "k", "inner")
    digests = map_batches(in_order.select("row", "body"), digest, "row bigint, groups_sha256 string")
    none = F.lit(None).cast("binary").alias("links")
    zero = lambda c: F.when(F.col("good"), F.col(c)).otherwise(0).alias(c)
    whole = good.join(digests, "row", "left").select(
        F.lit(-1).cast("bigint").alias("block"), "row", "doc_id", zero("n_a"), zero("n_b"), F.lit(0).cast("bigint").alias("n_groups"),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"), none)
    blank = [F.lit(0).cast("bigint").alias(c) for c in ("n_a", "n_b")]
    linked = parts.select("block", "row", F.lit(None).cast("bigint").alias("doc_id"), *blank, "n_groups", F.lit(None).cast("string").alias("groups_sha256"), "links")
    return whole.unionByName(linked)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """block, row, doc_id, n_a, n_b, n_groups, groups_sha256, links: the alignment of every whole text.

    links are linked pairs in order, each as A's id times the size of B's vocabulary plus B's id. A short text has one row (row
    is null), a long one several that share a row number, to be summed. A null or empty text, and one whose bytes are not those
    of its tokens, has no tokens: zeros and an empty digest. Equal rows stay. Other columns are not read.
    """
    few = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    long = F.octet_length("text") >= RANGE
    paths = (path_a, path_b)
    return written(_short(few.where(~F.coalesce(long, F.lit(False))), paths).unionByName(_long(few.where(long), paths)), "aligned", "zstd")


def pair_counts(rows: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """((pair, count, best) over all rows, (block, pair) as it occurs); best: no pair of the same B id has more links."""
    both = tokenizers(path_a, path_b)
    kind, width = both.pair, both.width

    def seen(batches):
        for batch in batches:
            blocks, held = batch.column(0).to_numpy(), batch.column(1)
            for block in np.unique(blocks):
                links = b"".join(x for x in held.filter(pa.array(blocks == block)).to_pylist() if x)
                pairs, n = np.unique(np.frombuffer(links, kind), return_counts=True)
                yield {"block": np.full(len(pairs), block), "pair": pairs.astype(np.int64), "n": n}

    found = written(map_batches(rows.where("block >= 0").select("block", "links"), seen, "block bigint, pair bigint, n bigint"), "pairs")
    counts = found.groupBy("pair").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.pmod("pair", F.lit(width))))  # at most one row per A id
    return counts.select("pair", "count", (F.col("count") == most).alias("best")), found.select("block", "pair").distinct()


def link_summary(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row (see ``aligned``).

    Every block of rows fetches the counts of its own pairs, so no task holds those of the whole corpus.
    """
    rows = aligned(docs, path_a, path_b)
    counts, wanted = pair_counts(rows, path_a, path_b)
    kind = tokenizers(path_a, path_b).pair
    lexicon = wanted.join(counts, "pair").select("block", "pair", "count", "best")

    def score(group: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("pair").to_numpy())
        keys, count, best = (pairs.column(c).to_numpy()[order] for c in ("pair", "count", "best"))
        keys, held = keys.astype(kind), group.column("links").to_pylist()
        sizes = np.array([len(x or b"") // kind.itemsize for x in held], np.int64)
        made = {"n_links": sizes, "n_best": np.zeros(len(held), np.int64), "count_sum": np.zeros(len(held), np.int64)}
        strips = np.cumsum(sizes) // STRIP
        for rows_here in np.split(np.arange(len(held)), np.flatnonzero(np.diff(strips)) + 1):
            if sizes[rows_here].any():
                at = np.searchsorted(keys, np.frombuffer(b"".join(held[i] or b"" for i in rows_here), kind))
                ends = np.cumsum(sizes[rows_here])
                made["n_best"][rows_here], made["count_sum"][rows_here] = _sums(best[at], ends), _sums(count[at], ends)
        group = group.drop_columns(["links", "block"])
        for name, values in made.items():
            group = group.append_column(name, pa.array(values))
        return group

    schema = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint"
    scored = written(rows.groupBy("block").cogroup(lexicon.groupBy("block")).applyInArrow(score, schema), "alignment")
    sums = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    columns = ["doc_id", *sums, "groups_sha256"]
    long = scored.where(F.col("row").isNotNull()).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in sums), F.max("groups_sha256").alias("groups_sha256"))
    return scored.where(F.col("row").isNull()).select(columns).unionByName(long.select(columns))
