from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from galegrid.llm import dual_tree as T

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def brute(rows, k, every):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = set()
    for q in good:
        if q % every == 0:
            others = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(others[:k], 1)}
    return out


@pytest.mark.parametrize("kind", ["clusters", "noise", "ties"])
def test_same_as_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(T, "DATA_BLOCK", 100)
    monkeypatch.setattr(T, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(4)
    n, dim = 700, 8
    x = rng.normal(size=(n, dim))
    if kind == "clusters":
        x = x * 0.03 + rng.normal(size=(6, dim))[rng.integers(0, 6, n)]
    if kind == "ties":
        x = rng.integers(-1, 2, (n, dim)).astype(float)
        x[100:400] = x[0]
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x)]
    rows += [(2000, None, None), (2005, [1.0, None] + [0.0] * 6, None), (2010, [float("nan")] * dim, None), (2015, [float("inf")] * dim, None)]
    rows += [(None, [1.0] * dim, None), (3000, [0.5, 0.25], None), (3005, [1.0, 1.0], None), (4000, [2.0], None), (4005, [], None)]
    out = T.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0)
    assert {tuple(r) for r in out.collect()} == brute(rows, 5, 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**20 * (i % 7 - 3), 2.0**21 + i, 1.0 + i], None) for i in range(60)]
    out = T.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0, k=3)
    assert {tuple(r) for r in out.collect()} == brute(rows, 3, 5)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], None), (50, [2.0], None), (51, [2.0], None)], SCHEMA)
    out = T.top_k(df, F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in out.collect()} == brute([tuple(r) for r in df.collect()], 5, 50)
    assert T.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert T.top_k(df, F.lit(False)).collect() == []


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_tree_covers_and_bounds(spread):
    rng = np.random.default_rng(1)
    x = np.unique(np.floor(256 * (rng.normal(size=(900, 6)) * spread + rng.normal(size=(9, 6))[rng.integers(0, 9, 900)])), axis=0).astype(np.int64)
    order, nodes = T.cover_tree(x, leaf=16)
    assert sorted(order) == list(range(len(x)))
    tree = T.Tree(x[order].tobytes(), nodes.tobytes(), 6)
    for a in range(len(nodes)):
        part = tree.x[tree.start[a] : tree.stop[a]]
        assert np.sqrt(((part - tree.x[tree.centre[a]]) ** 2).sum(axis=1)).max() <= tree.radius[a] + 1e-9
        kids = range(tree.child[a], tree.child[a] + tree.children[a])
        assert sum(tree.stop[c] - tree.start[c] for c in kids) in (0, len(part))
    for a, b in rng.integers(0, len(nodes), (300, 2)):
        q, d = tree.centre[a], tree.centre[b]
        top = T.bound(float(tree.x[q] @ tree.x[d]), tree.radius[a], tree.norm[q], tree.radius[b], tree.norm[d])
        pair = T.scores(tree.vectors[tree.start[a] : tree.stop[a]], tree.vectors[tree.start[b] : tree.stop[b]])
        assert pair.max() <= top


def test_search_prunes():
    """Far clusters are not compared point by point."""
    rng = np.random.default_rng(2)
    x = (np.floor(rng.normal(size=(2000, 4)) * 5) + 1000 * rng.integers(0, 2, (2000, 1)) * [[1, 0, 0, 0]]).astype(np.int64)
    order, nodes = T.cover_tree(x, leaf=16)
    tree, seen = T.Tree(x[order].tobytes(), nodes.tobytes(), 4), 0
    original = T.scores

    def counted(a, b):
        nonlocal seen
        seen += a.shape[0] * b.shape[0]
        return original(a, b)

    T.scores = counted
    try:
        near = x[x[:, 0] > 500][:40]
        o2, n2 = T.cover_tree(near, leaf=16)
        T.search(T.Tree(near[o2].tobytes(), n2.tobytes(), 4), tree, np.arange(len(x)), np.full(40, -np.inf), 5)
    finally:
        T.scores = original
    assert seen < 0.8 * 40 * len(x)
