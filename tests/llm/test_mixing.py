"""Language-model scores: the base against a plain count, the mixer against scalars, and probabilities that sum to one."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oslogs.llm import mixing
from oslogs.llm.common import fold
from oslogs.llm.queries import QUERIES


def plain_base(rows):
    fold7 = lambda d: 0 if d is None else zlib.crc32(str(d).encode()) % 7
    tokens = [(d, fold7(d) == 2, re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None]) for d, t in rows]
    count = collections.Counter(x for _, held, ts in tokens if not held for x in ts)
    n, v = sum(count.values()), len(count)
    out = [(d, held, len(ts), sum(count[x] > 0 for x in ts), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ts)) for d, held, ts in tokens]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[2:]))


def scored(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' block", "1 row", "'b' body", "2 word", "3 n", "4 key", "5 held_out")
    return [r.asDict() for r in mixing.scores(docs, fold(F.col("doc_id"), 7) == 2, **more).collect()]


def same_base(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2:])
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    wanted = plain_base(rows)
    assert [m[:5] for m in mine] == [w[:5] for w in wanted]
    assert np.allclose([m[5] for m in mine], [w[5] for w in wanted])


def counts_of(texts, order):
    keys = np.concatenate([mixing.contexts([b""], [t], order) for t in texts])
    kinds, n = np.unique(keys, return_counts=True)
    ctx, first = np.unique(kinds >> 8, return_index=True)
    return ctx, np.append(first, len(kinds)), n * 256 + (kinds & 255)


def read(texts, learned, mixer, rate=0.0, teach=False):
    tables, places = [], []
    for order in mixing.ORDERS:
        keys = mixing.contexts([b""] * len(texts), texts, order)
        kinds = np.unique(keys)
        tables.append(mixing.logits(kinds, *counts_of(learned, order), 0))
        places.append(mixing._Places(kinds)(keys))
    end = np.cumsum([len(t) for t in texts])
    return mixer.read(tables, places, end - [len(t) for t in texts], end, rate, teach), tables, places


def test_next_bytes_sum_to_one():
    """Whatever was read before and however weights have moved, the 256 next bytes share a probability of one."""
    learned = [b"the cat sat on the mat\0", b"that hat\0", bytes(range(256))]
    mixer = mixing.Mixer()
    read([b"the cat that sat on that mat the cat"], learned, mixer, 0.05, teach=True)
    for prefix in (b"", b"the", b"the cat sat on tha", b"zzz\xff"):
        # all stretches read the same prefix, so their weights are the same when they come to the last byte
        bits = read([prefix + bytes([b]) for b in range(256)], learned, mixer, 0.05)[0]
        before = read([prefix], learned, mixer, 0.05)[0][0] if prefix else 0
        assert abs(np.exp2(bits - before).sum() - 1) < 1e-3


def test_logits_are_counts_below_each_node():
    learned = [b"ab", b"ab", b"ac", b"aq\0"]
    ctx, first, counts = counts_of(learned, 1)  # any order will do
    keys = mixing.contexts([b""] * 3, [b"ab", b"az", b"xb"], 1)
    table = mixing.logits(keys, ctx, first, counts, 0)
    value = lambda byte, bit: byte >> (7 - bit) & 1
    for key, (last, byte) in zip(table[[1, 3, 5]], ((97, 98), (97, 122), (120, 98))):
        follows = [t[1] for t in learned] if last == 97 else []
        for bit in range(8):
            below = [f for f in follows if f >> (8 - bit) == byte >> (8 - bit)]
            agree = sum(value(f, bit) == value(byte, bit) for f in below)
            assert math.isclose(key[bit], math.log((agree + 0.3) / (len(below) - agree + 0.3)), abs_tol=1e-6)
    own = mixing.logits(keys[1:2], ctx, first, counts, 1)[0]
    assert math.isclose(own[7], math.log((1 + 0.3) / (1 + 0.3)), abs_tol=1e-6) and own[7] < table[1][7]


def test_mixer_equals_scalars():
    rng = np.random.default_rng(5)
    learned = [bytes(rng.choice(list(b"abcde "), 300).tolist()) for _ in range(4)]
    texts = [bytes(rng.choice(list(b"abcdeX "), n).tolist()) for n in (40, 7, 1, 23)]
    got, tables, places = read(texts, learned, mixing.Mixer(), 0.03)
    at = 0
    for text, mine in zip(texts, got):
        mixer, bits = mixing.Mixer(), 0.0
        w, curve = mixer.weights.astype(float), mixer.curve.astype(float)
        for _ in text:
            x = np.array([t[p[at]] for t, p in zip(tables, places)], float)
            for bit in range(8):
                g = sum(x[o][bit] != 0 for o in range(len(x))) * 8 + bit
                mixed = float(np.clip(w[g] @ x[:, bit], -7.99, 7.99))
                knot, share = int(abs(mixed) / 0.5), abs(mixed) / 0.5 % 1
                sign = np.sign(mixed)
                bent = sign * (curve[g][knot] * (1 - share) + curve[g][knot + 1] * share)
                p = 1 / (1 + math.exp(-(mixed + bent) / 2))
                bits += math.log2(p)
                w[g] += 0.03 * (1 - p) * x[:, bit]
                curve[g][knot] += 0.12 * sign * (1 - p) * (1 - share)
                curve[g][knot + 1] += 0.12 * sign * (1 - p) * share
            at += 1
        assert math.isclose(mine, bits, rel_tol=1e-3)


def test_places():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5000))
    asked = np.random.default_rng(2).integers(0, len(keys), 20_000)
    assert (mixing._Places(keys)(keys[asked]) == asked).all()


@pytest.mark.parametrize("block, segment", [(1 << 24, 1 << 14), (3000, 200)])
def test_odd_documents(spark, monkeypatch, block, segment):
    """Nulls, empty and very long texts, one endless word, zero bytes, equal rows, clashing columns; blocks don't matter."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "SEGMENT", segment)
    rows = [(i, f"Some words {i % 7} that Repeat\tand repeat\n number {i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "a\0b \0"), (104, "x" * 9000), (105, "many words here " * 1500), (None, "no id"), (1, "twice"), (1, "twice"), (106, "naïve 你好")]
    got = scored(spark, rows)
    same_base(got, rows)
    assert all(r["score"] < 0 for r in got) and scored(spark, rows[:0]) == []
    twice = [r["score"] for r in got if r["doc_id"] == 1 and r["n_tokens"] == 2]
    assert len(twice) == 2 and math.isclose(*twice, rel_tol=1e-6)
    only = next(r for r in got if r["doc_id"] == 104)
    assert only["bits_per_byte"] < 0.2
    if block < 1 << 24:
        return
    monkeypatch.setattr(mixing, "BLOCK", 2000)
    again = {(r["doc_id"], r["n_tokens"], r["n_known"]): r["score"] for r in scored(spark, rows)}
    for r in got:
        assert math.isclose(again[r["doc_id"], r["n_tokens"], r["n_known"]], r["score"], rel_tol=1e-4)


def test_all_texts_are_held_out(spark):
    got = scored(spark, [(d, "text " * d) for d in range(300) if zlib.crc32(str(d).encode()) % 7 == 2])
    assert len(got) > 20 and all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert math.isclose(got[0]["score"] / (got[0]["n_tokens"] * 5 - 4), 8 * math.log10(0.5), rel_tol=0.2)


def test_query_learns_from_the_whole_corpus(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [r.asDict() for r in QUERIES["op13_context_mixing"](spark, sf_dir).collect()]
    same_base(got, docs)
    held = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert np.mean([r["bits_per_byte"] for r in held]) < 2.8
    # a held-out text of which a copy was learned, and one that was not
    rare = "Zyxomma quobble frantid wexle orbunt " * 3
    free = [d for d in range(10**6, 10**6 + 200) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    texts = [(free[0], rare), (free[1], "Klompert viddish ganfle truxo bemwick " * 3), (10**7 + 2, "before " + rare)]
    assert zlib.crc32(str(10**7 + 2).encode()) % 7 != 2
    planted = {r["doc_id"]: r["bits_per_byte"] for r in scored(spark, docs[:100] + texts)}
    assert planted[free[0]] < 0.6 * planted[free[1]]


@pytest.mark.parametrize("block", [1 << 24, 4000])
def test_first_weights_come_from_all_training_texts(spark, monkeypatch, block):
    """More segments than any bounded sample held: each bit of each training text counts, and none of a held-out one."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "SEGMENT", 8)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list("abcd"), 3)) for _ in range(30))) for i in range(200)] + [(500, None), (501, ""), (502, "naïve"), (1, "abc"), (1, "abc")]
    kept = []
    real = mixing.evidence
    monkeypatch.setattr(mixing, "evidence", lambda lexicon: kept.append(real(lexicon).toPandas()) or real(lexicon))
    scored(spark, rows)
    texts = [(t or "").encode() + b"\0" for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    assert sum(-(-len(t) // 12) for t in texts) > 1024 and kept[0]["n"].sum() == 8 * sum(map(len, texts))
    # the sums of logits are those of every byte, looked up one by one without its own count
    for order in mixing.ORDERS:
        keys = np.concatenate([mixing.contexts([b""], [t], order) for t in texts])
        wanted = mixing.logits(keys, *counts_of(texts, order), 1).astype(float).sum()
        assert math.isclose(kept[0][f"x{order}"].sum(), wanted, rel_tol=1e-5)


def test_fitted_is_the_least():
    rng = np.random.default_rng(4)
    x, n, start = rng.normal(1, 2, (300, 3)), rng.integers(1, 50, 300).astype(float), np.full(3, 1 / 3)
    loss = lambda w: float(n @ np.logaddexp(0, -(x @ w)) + 5 / 2 * ((w - start) ** 2).sum())
    best = mixing.fitted(x, n, start, 5.0)
    assert all(loss(best) <= loss(best + d) for d in rng.normal(0, 1e-3, (50, 3))) and loss(best) < loss(start)
