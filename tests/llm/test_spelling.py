"""Spelling variants against a plain search, and the trie's parts."""

import collections
import re
import zlib

import compare
import numpy as np
import pytest

from oslogs.llm import spelling
from oslogs.llm.queries import ORACLE, QUERIES


def plain_words(rows):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 6
    return {w: n for w, n in count.items() if n >= 5}


def plain_variants(count):
    near = {a: [b for b in count if spelling.one_apart(a, b)] for a in count}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form[word] = best if best and count[best] >= 5 * count[word] else None

    def root(word):
        return root(form[word]) if form[word] else word

    return sorted((w, form[w], root(w), n, len(near[w]), count[form[w]] if form[w] else None) for w, n in count.items())


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_one_apart():
    assert all(spelling.one_apart(*p) for p in (("abc", "abd"), ("abc", "abcd"), ("abc", "xabc"), ("aab", "ab"), ("a", ""), ("íab", "iab")))
    assert not any(spelling.one_apart(*p) for p in (("abc", "abc"), ("abc", "acb"), ("abc", "abcde"), ("abc", "bcd"), ("", "")))


@pytest.mark.parametrize("block, slice_", [(20_000, 100_000), (40, 25), (1, 1)])
def test_variants_equal_a_plain_search(spark, monkeypatch, block, slice_):
    """Chains of forms, ties, anagrams, long words and many blocks and slices change nothing."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "SLICE", slice_)
    rng = np.random.default_rng(4)
    count = {}
    for _ in range(60 if block == 1 else 150):
        word = "".join(rng.choice(list("abcçde"), int(rng.choice([6, 7, 9, 70, 130]))))
        for n in (5000, 900, 40, 8):
            count[word] = int(n + rng.integers(0, 3) * (n == 8))
            at, letter = int(rng.integers(0, len(word))), rng.choice(list("abcçdeÿ"))
            word = word[:at] + letter * int(rng.integers(0, 2)) + word[at + int(rng.integers(0, 2)) :]
    count |= {"".join(p): 7 for p in ("abcdef", "fedcba", "badcfe", "abcdfe")} | {"a" * n: n for n in range(28, 40)} | {"a" * n + "b": 9 for n in range(60, 67)}
    rows = [(w, n) for w, n in count.items() if len(w) >= 6]
    assert found(spelling.variants(spark.createDataFrame(rows, "word string, n long").repartition(5))) == plain_variants(dict(rows))


def test_reach_covers_every_near_word():
    rng = np.random.default_rng(1)
    near = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(300)]
    near += [w[:i] + c + w[i + 1 :] for w in near[:80] for i, c in ((0, "h"), (6, "a"), (3, ""))]
    groups = {c: i % spelling.GROUPS for i, c in enumerate("abcdefgh")}
    code = spelling.codes(near, groups)
    cuts = np.unique(np.sort(code)[:: 17][1:])
    who, block = spelling.reach(code, cuts)
    routed = set(zip(who.tolist(), block.tolist()))
    home = np.searchsorted(cuts, code, "right")
    for i, a in enumerate(near):
        for j, b in enumerate(near):
            if spelling.one_apart(a, b):
                assert (i, home[j]) in routed or (j, home[i]) in routed
    assert len(routed) < len(near) * (len(cuts) + 1) / 2


def test_words_of_odd_documents(spark):
    """Nulls, empty and very long texts, repeated rows, clashing columns, slips."""
    long_ = "wörters Straßen abcdefg " * 30_000
    rows = [(1, "Reading reading READING readinG Reading Àbcdef àbcdef"), (1, "Reading reading READING readinG Reading"), (None, "reading"), (2, None), (3, ""), (4, "x" * 100_000), (5, long_), (6, "abc 12 ××××××")]
    rows += [(i, f"letters{chr(97 + i % 5)} slipping words") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' word", "1 n", "text run", "1 h", "2 block", "3 code")
    assert dict(tuple(r) for r in spelling.words(docs).collect()) == plain_words(rows)
    assert found(spelling.variants(spelling.words(docs))) == plain_variants(plain_words(rows))
    assert found(spelling.variants(spelling.words(docs.where("false")))) == []
    assert found(spelling.variants(spelling.words(docs.where("doc_id = 6")))) == []


def test_query_equals_its_sql(spark, sf_dir):
    name = "op12_letter_trie"
    assert compare.spark_rows(QUERIES[name](spark, sf_dir)) == compare.duck_rows(compare.connect(sf_dir), ORACLE[name])
