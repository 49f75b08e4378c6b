"""Token operators against the tokenizers library and by round trip."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from oslogs.llm import bpe, packing, pair_index, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "don't 's  've", "x\n\n y \t", "<|endoftext|>a<|endoftext|>", "日本語 é １２", "aaaaaaaaaaaaaaa", "a" * 5000, "word " * 400_000, "\u0000　'll"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoders():
    vocabulary = bpe.Vocabulary(PATH)
    return bpe.Encoder(vocabulary, bpe.Rounds(vocabulary)), bpe.Encoder(vocabulary, pair_index.PairIndex(vocabulary), shortcut=False)


def test_texts_of_all_kinds(library, encoders):
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    for encoder in encoders:
        assert [x.tolist() for x in encoder.encode(TEXTS)] == wanted
    assert list(encoders[0].counts(TEXTS)) == [len(w) for w in wanted]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab 's\n\trevl1é!<|>日", "<|endoftext|>", "'ve", "  "]), max_size=12).map("".join), max_size=4))
def test_any_texts(library, encoders, texts):
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for encoder in encoders:
        assert [x.tolist() for x in encoder.encode(texts)] == wanted


def test_every_code_point(library, encoders):
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}\n" for c in range(lo, lo + 64)) for lo in range(0, 0x30000, 64) if not 0xD800 <= lo < 0xE000]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoders[0].encode(texts)] == wanted


def test_colliding_hashes_are_told_apart(library, encoders, monkeypatch):
    monkeypatch.setattr(bpe, "hashes", lambda chars, begin, end: np.zeros(len(begin), np.uint64))
    vocabulary = encoders[0].vocabulary
    text = "the cat and thexat zzq zzr"
    assert next(bpe.Encoder(vocabulary, bpe.Rounds(vocabulary)).encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_pre_token_goes_through_the_index(library, sf_dir, monkeypatch):
    """Also those that are one token of the vocabulary: each different one once, and no other way leads to ids."""
    import pyarrow.parquet as pq
    texts = [t or "" for t in pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()]
    entered = []
    flat = pair_index.PairIndex.flat
    monkeypatch.setattr(pair_index.PairIndex, "flat", lambda self, words: entered.extend(words) or flat(self, words))
    monkeypatch.setattr(pair_index, "_LOADED", {})
    encoder, _ = pair_index.coder(PATH)
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    letters = {c: b for b, c in enumerate(bpe.byte_letters())}
    wanted = {bytes(letters[c] for c in piece) for t in texts for piece, _ in library.pre_tokenizer.pre_tokenize_str(t)}
    assert len(entered) == len(set(entered)) and set(entered) == wanted and b" the" in wanted


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "x", 1.0) for i, t in enumerate(TEXTS)] + [(3, "a", "x", 1.0), (None, "b c", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens double")


def test_digests(docs, library):
    for row, got in zip(docs.collect(), pair_index.digests(docs, PATH).collect()):
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got.doc_id, got.n_tokens) == (row.doc_id, len(ids))
        assert got.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_round_trip(docs):
    back = pair_index.decode(pair_index.encode(docs, PATH), PATH)
    assert [r.text for r in back.collect()] == [r.text or "" for r in docs.collect()]


def test_counts(docs, library):
    for row, got in zip(docs.collect(), token_counts.token_counts(docs, PATH).collect()):
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert tuple(got) == (row.doc_id, len((row.text or "").encode()), n, n > 1024)


def test_packing_documents(docs, library):
    rows = packing.pack_documents(docs, PATH).toPandas()
    ids = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    assert rows["length"].sum() == sum(len(ids[r.doc_id]) for r in docs.collect())
    for row in rows.itertuples():
        key = None if row.doc_id != row.doc_id else int(row.doc_id)
        part = np.array(ids[key][row.start : row.start + row.length], "<u4")
        assert len(part) == row.length and zlib.crc32(part.tobytes()) == row.ids_crc32 and row.doc_tokens == len(ids[key])
    for _, sequence in rows.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence["offset"] == sequence["length"].cumsum() - sequence["length"]).all() and sequence["length"].sum() <= 2048


def test_packing_keeps_all_three_limits(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(n), int(rng.integers(0, n + 1)), -5) for i, n in enumerate(rng.integers(1, 300, 9000))]
    rows += [(-1, None, 1, 0), (-2, 5000, 1, 0), (-3, 10, 600, 0), (-4, 0, 0, 0)]
    items = spark.createDataFrame(rows, "item long, tokens long, loss long, offset long")
    got = packing.pack(items, "tokens", "loss", capacity=1000, max_segments=8, max_loss=400).toPandas()
    assert sorted(got["item"]) == sorted(r[0] for r in rows)
    fits = got[got["item"] >= 0].groupby("sequence_id").agg(tokens=("tokens", "sum"), n=("item", "count"), loss=("loss", "sum"))
    assert fits["tokens"].max() <= 1000 and fits["n"].max() <= 8 and fits["loss"].max() <= 400
    odd = got[got["item"] < 0]
    assert odd["sequence_id"].nunique() == len(odd) and not set(odd["sequence_id"]) & set(fits.index)
    least = max(sum(r[1] or 0 for r in rows[:9000]) / 1000, 9000 / 8, sum(r[2] for r in rows[:9000]) / 400)
    assert len(fits) < 1.12 * least


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    for query in (pair_index.digests, token_counts.token_counts, packing.pack_documents, pair_index.encode):
        assert query(none, PATH).count() == 0
