"""Tokenizer alignment against a plain version that goes through the libraries' tokens one by one."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from oslogs.llm import alignment
from oslogs.llm.queries import BPE_FILE, PIECE_FILE, QUERIES

PATHS = public_tokenizers.path(BPE_FILE), public_tokenizers.path(PIECE_FILE)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = {c: b for b, c in enumerate(alignment.bpe.byte_letters())}
    docs, count = [], collections.Counter()
    for doc_id, text in rows:
        raw, tokens = (" " + (text or "")).encode(), ([], [])
        if text:
            for i in a_side.encode(" " + text, add_special_tokens=False).ids:
                tokens[0].append((i, bytes(letters[c] for c in a_side.id_to_token(i))))
            for i in b_side.encode(text):
                p = b_side.id_to_piece(i)
                tokens[1].append((i, bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()))
        if any(b"".join(x for _, x in side) != raw for side in tokens):
            tokens = ([], [])
        spans = []
        for side in tokens:
            at = 0
            spans.append([(i, at, at := at + len(x)) for i, x in side])
        ends = [{e for _, _, e in side} for side in spans]
        groups, links, at = [], [], [0, 0]
        for end in sorted(ends[0] & ends[1]):
            pair = []
            for k, side in enumerate(spans):
                first = at[k]
                while at[k] < len(side) and side[at[k]][2] <= end:
                    at[k] += 1
                pair.append(side[first : at[k]])
            one, two = pair
            groups.append(",".join(str(t[0]) for t in one) + "|" + ",".join(str(t[0]) for t in two))
            links += [(x[0], y[0]) for x in one for y in two if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        docs.append((doc_id, len(tokens[0]), len(tokens[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = collections.Counter()
    for (a, b), c in count.items():
        best[b] = max(best[b], c)
    return sorted((d, a, b, g, len(l), sum(count[x] == best[x[1]] for x in l), sum(count[x] for x in l), s) for d, a, b, g, l, s in docs)


def found(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


ODD = [
    "", " ", "  two  blanks ", "a", "<|endoftext|> and <s> are </s> text", "a▁b", "tab\tand\r\nlines\n\n", "ﬁne 你好 世界 🙂🙂 naïve",
    "nul\x00 here", "x" * 5000, "don't we'll they've I'D", "1234567 89 3.14", " wide blanks", "word_ _word __", "é combining",
]


def test_ranges_cover_texts_and_tokens(monkeypatch):
    both = alignment.tokenizers(*PATHS)
    texts = [t for t in ODD if t] + ["some words of a longer text, with é and 你好 " * 40, "é" * 999 + " tail and end", "no" * 700 + " a b c " + "你好" * 400]
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(alignment, "RANGE", size)
        for text in texts:
            got = list(alignment.ranges(text))
            raw = (" " + text).encode()
            assert [r[0] for r in got] + [len(raw)] == [0] + [r[1] for r in got]
            a, b, good = next(both.tokens([" " + text]))
            for side, ids, length in ((0, a, both.length_a), (1, b, both.length_b)):
                ends, mine = np.cumsum(length[ids]), []
                for lo, hi, start, part in got:
                    assert raw[start : start + len(part.encode())] == part.encode() and start <= lo
                    tokens = next(both.tokens([part]))
                    part_ends = start + np.cumsum(length[tokens[side]])
                    mine += [(e, i) for e, i in zip(part_ends.tolist(), tokens[side].tolist()) if lo < e <= hi]
                if good:
                    assert mine == list(zip(ends.tolist(), ids.tolist()))
            assert sum(len(r[3].encode()) for r in got) <= 3 * len(raw) + 30 * size * len(got)


@pytest.mark.parametrize("size", [1 << 16, 40, 3])
def test_alignment_equals_a_plain_one(spark, sf_dir, monkeypatch, size):
    """Whatever the ranges: within letters, words and groups; texts of one range and of hundreds."""
    monkeypatch.setattr(alignment, "RANGE", size)
    monkeypatch.setattr(alignment, "BLOCK", 1 << 23 if size > 100 else 2000)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 1500").limit(100 if size > 3 else 12)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD if size > 3 else [t[:200] for t in ODD])] + [(2000, None), (None, "no id"), (1, "one id twice"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "'x' links", "1 row", "2 block", "3 pair", "4 k")
    key = lambda r: tuple((x is None, x) if x is None else (False, x) for x in r)
    got = [tuple(r) for r in alignment.link_summary(docs, *PATHS).select(COLUMNS).collect()]
    wanted = plain([(-1 if d is None else d, t) for d, t in rows])
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == wanted
    assert [f for f, _ in alignment.link_summary(docs.limit(0), *PATHS).dtypes] == COLUMNS


def test_composition_is_associative(spark):
    """Trees over the same ranges of a few bytes, shifted by empty ranges, give the same groups."""
    text = "thndinger Unaffordable whthand naïveté, 你好 éllecionouent oererblendin x" * 2
    both = alignment.tokenizers(*PATHS)
    size = len(text.encode()) + 1
    cuts = [*range(0, 30, 2), *range(30, size, 3), size]
    made = [alignment.fragment(both, lo, hi, 0, " " + text) for lo, hi in zip(cuts, cuts[1:])]
    names = ("closed", "prefix_a", "prefix_b", "suffix_a", "suffix_b")

    def tree(shift):
        rows = [(0, i + shift, 1, *(bool(f[n]) if n == "closed" else [int(x) for x in f[n]] for n in names)) for i, f in enumerate(made)]
        rows += [(0, i, 1, False, [], [], [], []) for i in range(shift)]
        opens = spark.createDataFrame(rows, "row long, node long, width long, " + alignment._OPEN)
        groups = []
        for level in range(len(rows).bit_length()):
            opens, closed = alignment.composed(opens, "t")
            groups += [(r.k - shift, r.a, r.b) for r in closed.collect()]
        root = opens.first()
        assert root.closed and not root.suffix_a and not root.suffix_b
        return [group for _, *group in sorted(groups)], root.prefix_a, root.prefix_b

    assert any(not f["closed"] for f in made) and any(len(f["suffix_a"]) + len(f["suffix_b"]) for f in made)
    assert tree(0) == tree(1) == tree(3)


def test_long_text_over_many_ranges(spark):
    rows = [(1, "Reallylongwords and naïveté 你好 12345 " * 6_000), (2, "x" * 100_000), (3, "short")]
    got = found(alignment.link_summary(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS))
    assert got == plain(rows)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op11_fragment_monoid"](spark, sf_dir)) == plain([tuple(d) for d in docs])
