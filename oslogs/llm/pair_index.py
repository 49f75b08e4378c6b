"""BPE encoding by an index of pair occurrences, and decoding.

All different pre-tokens of a slice of a partition lie in one array of symbols. The index maps each pair that has a rank to
all its positions. Ranks that occur are taken in ascending order; each merges its pair at every position of its list and
enters the pairs that arise beside it under their own ranks, which are always higher. Positions that a neighbour's merge
has overtaken are recognised when their turn comes. Every different pre-token goes through the index; none is answered by a
table of whole tokens.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from oslogs.llm import bpe
from oslogs.llm.common import map_batches


class PairIndex:
    """Ids of many pre-tokens at once."""

    def __init__(self, vocabulary: bpe.Vocabulary):
        self.vocabulary = vocabulary
        self.first = np.full(1 << 16, -1, np.int64)  # rank of two bytes
        letter = {int(t): b for b, t in enumerate(vocabulary.base)}
        for rank, (a, b, _) in enumerate(vocabulary.merges):
            if a in letter and b in letter:
                self.first[letter[a] << 8 | letter[b]] = rank

    def flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each word has."""
        ranks, merges, size = self.vocabulary.ranks, self.vocabulary.merges, self.vocabulary.size
        raw = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length)
        n = len(raw)
        # a wall (-1) ends every word, so that no pair crosses it
        place = np.arange(n) + np.repeat(np.arange(len(words)), length)
        symbols = np.full(n + len(words), -1, np.int64)
        symbols[place] = self.vocabulary.base[raw]
        rank = self.first[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        rank[ends[:-1] - 1] = -1
        has = np.flatnonzero(rank >= 0)
        order = has[np.argsort(rank[has], kind="stable")]
        values, at = np.unique(rank[order], return_index=True)
        index = {int(r): p.tolist() for r, p in zip(values, np.split(place[order], at[1:]))}
        active = list(index)
        heapify(active)
        symbol = symbols.tolist()
        after = list(range(1, len(symbol) + 1))
        before = list(range(-1, len(symbol) - 1))
        while active:
            r = heappop(active)
            left, right, made = merges[r]
            places = index.pop(r)
            if left == right:
                places.sort()
            for i in places:
                if symbol[i] != left:
                    continue
                j = after[i]
                if symbol[j] != right:
                    continue
                symbol[i], symbol[j] = made, -2
                k = after[i] = after[j]
                before[k] = i
                s = symbol[k]
                if s >= 0 and (q := ranks.get(made * size + s)) is not None:
                    if q in index:
                        index[q].append(i)
                    else:
                        index[q] = [i]
                        heappush(active, q)
                h = before[i]
                if h >= 0 and (s := symbol[h]) >= 0 and (q := ranks.get(s * size + made)) is not None:
                    if q in index:
                        index[q].append(h)
                    else:
                        index[q] = [h]
                        heappush(active, q)
        left = np.array(symbol, np.int64)
        kept = left[left != -2]
        walls = np.flatnonzero(kept == -1)
        return kept[kept != -1], np.diff(walls, prepend=-1) - 1


class Decoder:
    """Texts of ids."""

    def __init__(self, vocabulary: bpe.Vocabulary):
        tokens = [vocabulary.bytes.get(i, b"") for i in range(vocabulary.size)]
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.first = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def __call__(self, ids: np.ndarray) -> str:
        """The bytes of all ids as UTF-8; what is no UTF-8 becomes replacement signs."""
        return self.pool[bpe.ragged(self.first[ids], self.length[ids])].tobytes().decode("utf-8", "replace") if len(ids) else ""


_LOADED: dict[str, tuple[bpe.Encoder, Decoder]] = {}


def coder(path: str) -> tuple[bpe.Encoder, Decoder]:
    """Encoder and decoder of a vocabulary file, once per worker."""
    if path not in _LOADED:
        vocabulary = bpe.Vocabulary(path)
        _LOADED[path] = bpe.Encoder(vocabulary, PairIndex(vocabulary), shortcut=False), Decoder(vocabulary)
    return _LOADED[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ids (array<int>) of every row's whole text.

    A null text counts as an empty one and has no ids; rows are treated alone, so repeated rows and ids stay as they are, an
    empty table gives an empty one, and other columns are not read.
    """

    def rows(batches):
        encoder, _ = coder(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                yield {"id": part.column(0), "ids": list(encoder.encode(part.column(1).to_pylist()))}

    return _named(map_batches(_two(df, id_col, text_col), rows, "id bigint, ids array<int>"), id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and text of every row's ids (null: empty text)."""

    def rows(batches):
        _, decoder = coder(path)
        for batch in batches:
            yield {"id": batch.column(0), "text": [decoder(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]}

    return _named(map_batches(_two(df, id_col, ids_col), rows, "id bigint, text string"), id_col)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoding and decoding in one pass: id_col, n_tokens, and the SHA-256 of the ids and of the decoded text."""

    def rows(batches):
        encoder, decoder = coder(path)
        for batch in batches:
            n, coded, decoded = [], [], []
            for ids in encoder.encode(batch.column(1).to_pylist()):
                n.append(len(ids))
                coded.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decoder(ids).encode()).hexdigest())
            yield {"id": batch.column(0), "n_tokens": n, "ids_sha256": coded, "decoded_sha256": decoded}

    return _named(map_batches(_two(df, id_col, text_col), rows, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"), id_col)


def _two(df: DataFrame, id_col: str, other: str) -> DataFrame:
    return df.select(df[id_col].cast("bigint").alias("id"), df[other].alias("value"))


def _named(df: DataFrame, id_col: str) -> DataFrame:
    return df.withColumnRenamed("id", id_col)
