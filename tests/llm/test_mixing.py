from __future__ import annotations

import math
import random

import pytest

from galegrid.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string, taken string"


def targets(sizes: dict, weights=(5, 2, 1), percent=150):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, done = sum(sizes.values()) * percent / 100, {}
    while True:
        rest = [s for s in names if s not in done]
        share = sum(weight[s] for s in rest)
        given = {s: (total - sum(done.values())) * weight[s] / share for s in rest}
        over = [s for s in rest if given[s] >= 2 * sizes[s]]
        if not over:
            return {**done, **given}
        done |= {s: 2.0 * sizes[s] for s in over}
        if len(done) == len(names):
            return done


def corpus(seed, n=900):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", None, "", "hot", "hot", "hot", "hot"]
    rows = []
    for i in range(n):
        words = int(math.exp(rng.uniform(0, 6)))
        rows.append((i, rng.choice((" ", "\n", "\t ")).join(["w"] * words) + " ", rng.choice(sources), "x"))
    return rows + [(n, None, "a", None), (n + 1, "", "empty", None), (n + 2, "   x", None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_are_met(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.mix(df).collect()
    size = {r[0]: len([w for w in (r[1] or "").replace(" ", "x").split()]) for r in rows}
    assert {r.doc_id: r.size for r in out} == size
    by_source, taken = {}, {}
    source = {r[0]: r[2] for r in rows}
    for r in out:
        by_source[source[r.doc_id]] = by_source.get(source[r.doc_id], 0) + r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    expected = targets(by_source)
    for r in out:
        assert r.source_size == by_source[source[r.doc_id]]
        assert math.isclose(r.target, expected[source[r.doc_id]], rel_tol=1e-12, abs_tol=1e-9)
    for s, t in expected.items():
        assert abs(taken[s] - t) <= max(2, 0.01 * t), (s, taken[s], t)


def test_rates_are_exponentially_tilted(spark):
    """The rates that solve the dual: one multiplier for a source, the sum on target."""
    sizes = [1, 3, 5, 8, 20, 40, 100, 100, 250]
    rows = spark.createDataFrame([(0, s) for s in sizes], "sid bigint, size bigint")
    total = sum(sizes)
    for share in (0.4, 0.9, 1.0, 1.3, 1.9, 2.0):
        goal = spark.createDataFrame([(0, total, share * total)], "sid bigint, source_size bigint, target double")
        (r,) = M.multipliers(rows, goal).collect()
        rates = [min(2.0, math.exp(r.multiplier * s / r.mean)) for s in sizes]
        assert math.isclose(sum(a * s for a, s in zip(rates, sizes)), share * total, rel_tol=1e-5), share


def test_reruns_agree_for_any_partitioning(spark):
    df = spark.createDataFrame(corpus(3, 300), SCHEMA)
    key = lambda out: sorted(tuple(r) for r in out.collect())
    assert key(M.mix(df)) == key(M.mix(df.repartition(7, "text")))


def test_edges(spark):
    one = spark.createDataFrame([(1, "a b c", None, None), (1, "a b c", None, None), (None, "d", None, None)], SCHEMA)
    out = M.mix(one).collect()
    assert len(out) == 3 and all(r.target == 10.5 and r.taken <= 2 * r.size for r in out)
    empty = spark.createDataFrame([(1, None, "a", None), (2, "", "b", None)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in M.mix(empty).collect()] == [(0, 0.0, 0)] * 2
    assert M.mix(one.limit(0)).collect() == []
