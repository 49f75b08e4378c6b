"""Vector operators against brute force."""

import numpy as np
import pytest

from oslogs.llm import multi_index, va_file


def linked(rows, threshold=0.98):
    """n_links and component of every row, by comparing all."""
    good = {}
    for i, (key, v, g) in enumerate(rows):
        if g is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = (g, x / np.linalg.norm(x))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for i in good:
        for j in good:
            if i < j and good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1]) and good[i][1] @ good[j][1] >= threshold:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {key: (n[i], least[find(i)]) for i, (key, _, _) in enumerate(rows)}


def vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dims)) * 0.14
    return x.astype(np.float32), rng.integers(0, 3, n)


@pytest.mark.parametrize(("n", "block"), [(600, 1024), (700, 32)])
def test_near_vectors(spark, monkeypatch, n, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    x, g = vectors(n, 16)
    x[5] = x[6] = x[7]
    g[5] = g[6] = g[7] = 1
    rows = [(1000 - i, x[i].tolist(), int(g[i])) for i in range(n)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [None] + [1.0] * 15, 1), (2003, [float("nan")] + [1.0] * 15, 1), (2004, x[0].tolist(), None), (2005, [float("inf")] * 16, 2), (2006, [], 1)]
    df = spark.createDataFrame([(*r, 7, True) for r in rows], "vec_id long, embedding array<float>, label int, n_links int, kept boolean")
    got = multi_index.near_vectors(df).collect()
    wanted = linked(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert max(n for n, _ in wanted.values()) > 5


def test_vectors_of_many_lengths_and_none(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.001], 1), (3, [1.0, 0.0, 0.0], 1), (4, [5.0], 1), (5, [7.0], 1), (6, [-7.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: (r.n_links, r.component_id) for r in multi_index.near_vectors(df).collect()} == linked(rows)
    assert multi_index.near_vectors(df.where("vec_id < 0")).count() == 0
    assert multi_index.near_vectors(df.where("vec_id = 1")).collect()[0].n_links == 0


def test_recall_of_the_traversal():
    x, _ = vectors(1500, 16, seed=4)
    x = multi_index._unit(list(x))
    books = multi_index.codebook(x[:400, :8], 8), multi_index.codebook(x[:400, 8:], 8)
    (n1, w1), (n2, w2) = multi_index.half_bounds(x[:, :8], books[0]), multi_index.half_bounds(x[:, 8:], books[1])
    near = x @ x.T >= 0.98
    found = total = 0
    for i in range(len(x)):
        cells = set(multi_index.traversal(w1[i], w2[i], 0.04 + 1e-9))
        partners = np.flatnonzero(near[i])
        total += len(partners)
        found += sum((n1[j], n2[j]) in cells for j in partners)
    assert total > 5000 and found == total  # recall 1; 0.9 is asked for


def test_traversal_order():
    rng = np.random.default_rng(2)
    a, b = rng.random(7), rng.random(5)
    got = multi_index.traversal(a, b, 1.1)
    sums = [a[i] + b[j] for i, j in got]
    assert sums == sorted(sums) and len(set(got)) == len(got) == (a[:, None] + b[None, :] <= 1.1).sum()


@pytest.mark.parametrize("bits", [2, 6])
def test_top_k(spark, monkeypatch, bits):
    monkeypatch.setattr(va_file, "CANDIDATES", 150)
    monkeypatch.setattr(va_file, "QUERIES", 8)
    x, _ = vectors(700, 8, seed=1)
    x = np.round(x, 1).astype(np.float32)  # many ties
    rows = [(i, x[i].tolist(), "v") for i in range(700)] + [(700, None, "v"), (750, [float("nan")] * 8, "v"), (800, [None] * 8, "v"), (None, [1.0] * 8, "v"), (0, x[0].tolist(), "v")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    ints = va_file.integer_vectors(df)
    got = va_file.top_k(ints, ints.where("id % 50 = 0"), 5, bits).collect()
    v = np.floor(256 * x.astype(float)).astype(int)
    for q in range(0, 700, 50):
        score = v @ v[q]
        order = [int(i) for i in np.lexsort((np.arange(700), -score)) if i != q][:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert mine == [(k + 1, i, int(score[i])) for k, i in enumerate(order)]
    assert len(got) == 14 * 5


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (50, [0.5, 1.0])], "vec_id long, embedding array<double>")
    ints = va_file.integer_vectors(df)
    assert [tuple(r) for r in va_file.top_k(ints, ints.where("id % 50 = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert va_file.top_k(ints.limit(0), ints.limit(0)).count() == 0
