"""Near-duplicates and the pipeline against plain versions, and the queries that have SQL."""

import collections
import tracemalloc

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oslogs.llm import components, language_id, order_minhash, toxicity
from oslogs.llm.queries import ORACLE, QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_banded_edits():
    rng = np.random.default_rng(2)
    for _ in range(1500):
        a = rng.integers(0, rng.choice([3, 40]), rng.integers(0, 45)).tolist()
        b = list(a)
        for _ in range(rng.integers(0, 9)):
            at, what = int(rng.integers(0, len(b) + 1)), rng.integers(0, 3)
            b[at : at + int(what > 0)] = [int(rng.integers(0, 40))] if what != 1 else []
        most, true = int(rng.integers(0, 12)), distance(a, b)
        wanted = true if true <= most else most + 1
        assert order_minhash.edits(np.array(a, np.uint32), np.array(b, np.uint32), most) == wanted
        short, long_ = sorted((a, b), key=len)
        if len(long_) - len(short) <= most:
            assert order_minhash._banded(short, long_, most) == wanted
        x, y = (np.frombuffer(order_minhash.counted(np.array(t, np.uint32)), np.uint8).astype(int) for t in (a, b))
        assert max(np.maximum(x - y, 0).sum(), np.maximum(y - x, 0).sum()) <= true


def test_sketches_follow_order_and_occurrence():
    number = order_minhash.Words()
    text = " ".join(f"w{i}" for i in range(60))
    same, turned = order_minhash.sketches(number(text)), order_minhash.sketches(number(" ".join(text.split()[30:] + text.split()[:30])))
    assert (same == order_minhash.sketches(number(text.upper() + "!"))).all()
    assert 0 < (same == turned).mean() < 0.9  # most shingles are the same, but not their order
    assert len(order_minhash.sketches(number("one"))) == order_minhash.SKETCHES


def test_sketches_in_strips(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 50, n).astype(np.uint32) for n in (1, 2, 6, 7, 100, 1000)]
    whole = [order_minhash.sketches(t) for t in texts]
    for strip in (1, 2, 7, 64):
        monkeypatch.setattr(order_minhash, "STRIP", strip)
        assert all((order_minhash.sketches(t) == w).all() for t, w in zip(texts, whole))


def test_sketches_of_a_million_words_stay_small():
    words = np.random.default_rng(5).integers(0, 1 << 32, 1_000_000, dtype=np.uint32)
    tracemalloc.start()
    order_minhash.sketches(words)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_counters_never_exceed_the_edits():
    """Also between texts of few and of many counters, and where counters are full."""
    rng = np.random.default_rng(6)
    for n in (200, 500, 515, 3000):
        for words in (1, 30, 5000):
            a = rng.integers(0, words, n).astype(np.uint32)
            b = np.delete(a, rng.choice(n, n // 10, replace=False))
            f, g = [order_minhash.counted(a)], [order_minhash.counted(b)]
            zero = np.zeros(1, int)
            assert order_minhash._room(f, g, zero, zero, np.array([n // 10]))[0]
            if words == 5000:
                other = [order_minhash.counted(rng.integers(0, words, n).astype(np.uint32))]
                assert not order_minhash._room(f, other, zero, zero, np.array([n // 10]))[0]


def documents(rng, n=120):
    """Originals, exact and near copies, and texts that share a passage of 60 words and nothing else."""
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    passage = [word() for _ in range(60)]
    out = []
    for i in range(n):
        base = [word() for _ in range(int(rng.integers(30, 160)))]
        out.append(" ".join(base))
        for _ in range(int(rng.integers(0, 4))):
            copy = list(base)
            for at in rng.integers(0, len(copy), int(len(copy) * rng.choice([0, 0.03, 0.08]))):
                copy[at] = word()
            out.append(" ".join(copy))
        if i % 2:
            out.append(" ".join(base[:40] + passage + [word() for _ in range(40)]))
    crowd = [word() for _ in range(100)]
    for _ in range(150):
        copy = list(crowd)
        for at in rng.integers(0, 100, 5):
            copy[at] = word()
        out.append(" ".join(copy))
    return out


def plain_classes(texts):
    number = order_minhash.Words()
    words = [number(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(words):
        for j in range(i):
            same = texts[i] is not None and texts[i] == texts[j]
            near = len(a) and len(words[j]) and min(len(a), len(words[j])) >= 0.8 * max(len(a), len(words[j])) and order_minhash.similar(a, words[j])
            if same or near and texts[i] is not None and texts[j] is not None:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize(("block", "crowd", "few"), [(512, 64, 16), (16, 1000, 1)])
def test_near_documents(spark, monkeypatch, block, crowd, few):
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    monkeypatch.setattr(order_minhash, "FEW", few)
    monkeypatch.setattr(order_minhash, "CROWD", crowd)
    texts = [*documents(np.random.default_rng(8)), None, None, "", "", "?!", "one", "one", "One!", "two words"]
    df = spark.createDataFrame([(i, t, 7, "k") for i, t in enumerate(texts)] + [(None, texts[0], 7, "k"), (0, texts[0], 7, "k")], "doc_id long, text string, copies int, key string")
    got = order_minhash.near_documents(df).collect()
    assert len(got) == len(texts) + 2
    found, plain = {r.doc_id: r.class_id for r in got if r.doc_id is not None}, plain_classes(texts)
    assert all(plain[found[i]] == plain[i] for i in found)  # nothing is joined that no links join
    assert sum(found[i] != plain[i] for i in found) <= 0.005 * len(texts)  # sketches miss a few links of little more than 0.8
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.class_id) for r in got)
    kept = order_minhash.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(found.values()))
    assert kept.where("doc_id is null").count() == 1
    assert order_minhash.near_documents(df.limit(0)).count() == 0 == order_minhash.one_of_each(df.limit(0)).count()


def test_marked_rows(spark):
    """A row is marked false only where its id is not asked for; with far fewer ids than bits hardly another row is marked true."""
    ids = spark.range(0, 5000, 5)
    marked = order_minhash._marked(spark.range(5000).withColumn("text", F.lit("t")), "id", ids)
    assert marked.columns == ["id", "text", "maybe"] and marked.count() == 5000
    assert marked.where("maybe and id % 5 = 0").count() == 1000 and marked.where("maybe").count() < 1050
    assert order_minhash._marked(ids, "id", ids.limit(0)).where("maybe").count() == 0


def test_sketches_of_the_same_texts_are_compared_once(spark, monkeypatch):
    """Texts of different lengths that share a passage are dealt to blocks once for all sketches of the same texts, and by lengths."""
    monkeypatch.setattr(order_minhash, "BLOCK", 4)
    monkeypatch.setattr(order_minhash, "FEW", 4)
    seen, plain = spark.sparkContext.accumulator(0), order_minhash._agreeing

    def agreeing(least):
        def counted(frames):
            for frame in frames:
                seen.add(len(frame))
                yield frame

        run = plain(least)
        return lambda frames: run(counted(frames))

    monkeypatch.setattr(order_minhash, "_agreeing", agreeing)
    passage = " ".join(f"p{i}" for i in range(300))
    texts = [" ".join([passage, *(f"w{i}x{j}" for j in range(100 + 20 * i))]) for i in range(8)]
    texts.append(texts[5] + " more")
    got = {r.doc_id: r.class_id for r in order_minhash.near_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: 5 if i == 8 else i for i in range(9)}
    held = collections.Counter(k for t in texts for k in keys(t))
    several = [frozenset(i for i, t in enumerate(texts) if k in keys(t)) for k, n in held.items() if n > 4]
    assert len(several) > len(set(several))  # some sketches are shared by the same texts
    whole = sum(len(s) * -(-len(s) // 4) for s in several)
    assert 0 < seen.value < whole


def keys(text):
    words = order_minhash.Words()(text)
    return {*order_minhash.sketches(words).tolist(), *order_minhash.brief(words).tolist()} if len(words) else set()


@pytest.mark.parametrize(("crowd", "few"), [(1, 16), (1000, 1), (1000, 1000)])
def test_one_shared_sketch_is_enough(spark, monkeypatch, crowd, few):
    """The classes are those of all similar pairs that share a sketch, however many texts share it."""
    monkeypatch.setattr(order_minhash, "CROWD", crowd)
    monkeypatch.setattr(order_minhash, "FEW", few)
    rng = np.random.default_rng(11)
    passage, texts = [f"p{i}" for i in range(12)], []
    for i in range(60):
        base = [f"w{i}x{j}" for j in range(38)]
        base = base[:20] + passage + base[20:]
        texts.append(" ".join(base))
        for at in rng.choice(50, 9, replace=False):
            base[at] = f"e{i}x{at}"
        texts.append(" ".join(base))
    texts = [texts[i] for i in rng.permutation(len(texts))]
    held, number = [keys(t) for t in texts], order_minhash.Words()
    words = [number(t) for t in texts]
    wanted = {(i, j) for j in range(len(texts)) for i in range(j) if held[i] & held[j] and order_minhash.similar(words[i], words[j])}
    assert len(wanted) > 20
    got = {r.doc_id: r.class_id for r in order_minhash.near_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {(got[i], i) for i in got if got[i] != i} == wanted


def test_short_links_always_share_a_sketch():
    rng = np.random.default_rng(4)
    for n in range(1, order_minhash.EXACT + 1):
        for _ in range(60):
            a = [f"w{x}" for x in rng.integers(0, 30, n)]
            b = list(a)
            for _ in range(rng.integers(1, 4)):
                at, what = int(rng.integers(0, len(b) + 1)), rng.integers(0, 3)
                b[at : at + int(what > 0)] = [f"e{rng.integers(0, 9)}"] if what != 1 else []
            if 0 < len(b) <= order_minhash.EXACT and distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                assert keys(" ".join(a)) & keys(" ".join(b))


def test_scattered_edits_share_a_sketch():
    rng = np.random.default_rng(6)
    for n in (15, 20, 40, 64, 100, 250):
        for share in (0.2, 0.15, 0.1):
            found = 0
            for i in range(100):
                a = [f"{i}w{j}" for j in range(n)]
                b = list(a)
                for at in rng.choice(n, int(n * share), replace=False):
                    b[at] += "e"
                found += bool(keys(" ".join(a)) & keys(" ".join(b)))
            assert found >= 95


def test_changed_word_in_short_texts(spark):
    texts = ["one two three four five", "one two other four five", "a b c d e f g", "a b c x e f g", "one two three four", "a b c d x f h"]
    texts += [f"u v w{i} x y" for i in range(600)] + ["g h i j k l m n o p", "g h z j k l m q o p"]
    got = {r.doc_id: r.class_id for r in order_minhash.near_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(6)] == [0, 0, 2, 2, 0, 5] and {got[6 + i] for i in range(600)} == {6} and got[607] == got[606] == 606


def test_components(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(3, 3), (9, 8), (200, 150), (200, 150)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert got == {i: 100 for i in [*range(100, 161), 200]} | {i: 5 for i in range(5, 40)}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = list(toxicity.Scorer(toxicity.fit(toxicity.labelled(docs, labels)))(list(rows.values())))
    clean = {i: t for (i, t), s in zip(rows.items(), score) if s < 0.5}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language_id", "near_duplicates", "packing"]
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert first.schema == docs.schema and {r.doc_id for r in first.collect()} == set(clean)
    net = language_id.fit(first)
    known = {i for (i, _), (lang, s) in zip(clean.items(), net.predict(list(clean.values()))) if lang != "und" and s >= 0.35}
    second = corpus_pipeline.STAGES[1][1](spark, first, sf_dir)
    assert second.schema == docs.schema and {r.doc_id for r in second.collect()} == known
    order = sorted(known)
    kept = {order[c] for c in plain_classes([rows[i] for i in order])}  # none of these texts' links is missed
    out = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(out["doc_id"]) == kept and len(kept) < len(known) < len(rows) + 1
    assert (out.groupby("doc_id")["length"].sum() == out.groupby("doc_id")["doc_tokens"].first()).all()
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048


def test_stages_of_odd_documents(spark, sf_dir):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "plain words here", "en", "s", 3), (2, "", "en", "s", 0), (3, "plain words here", "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() <= max(5, docs.count())


@pytest.mark.parametrize("name", ORACLE)
def test_queries_with_sql(spark, sf_dir, name):
    assert compare.spark_rows(QUERIES[name](spark, sf_dir)) == compare.duck_rows(compare.connect(sf_dir), ORACLE[name])


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 11)]
