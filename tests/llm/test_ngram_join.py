from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from galegrid.llm import ngram_join as J
from galegrid.llm.components import components

SCHEMA = "doc_id bigint, text string, n_shingles string"


def brute(rows, size, percent):
    """doc -> (set size, component) by comparing all pairs."""
    sets = {}
    for doc, text, *_ in rows:
        w = (text or "").encode().lower().split()
        n = min(size, len(w))
        sets[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: (len(sets[d]), top(d)) for d in sets}


def texts(seed: int, n: int):
    """Texts of very different length, near copies in chains, and junk."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.55:
            words = rng.choice(out).split()
            for _ in range(rng.randint(0, 1 + len(words) // 40)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words += rng.choices(vocabulary, k=rng.randint(1, 3))
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 4, 5, 7, 9, 14, 20, 30, 60, 200]))))
    return out


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (2, 60)])
def test_same_as_all_pairs(spark, size, percent):
    rows = [(i, t, "clash") for i, t in enumerate(texts(size, 260))]
    rows += [(900, None, None), (901, "", ""), (902, " \t\n ", None), (903, "One two", None), (904, "oNE  TWO", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r[0]: (r[1], r[2]) for r in J.ngram_jaccard(df, size, percent).collect()}
    assert found == brute(rows, size, percent)
    assert found[904] == (1, 903) and found[901] == (0, 901)


def test_large_group_of_near_copies_costs_no_pairs(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:50], f"x{i}", *base[51:]])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = J.indexed(df, 4, 85, "doc_id", "text")
    shared = J.shared_signatures(sets)
    assert shared.where("doc <> pivot").select("doc", "pivot").distinct().count() <= 3 * len(rows)
    assert {r[2] for r in J.ngram_jaccard(df, 4, 85).collect()} == {0}


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "a b c d e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(map(tuple, J.ngram_jaccard(df, 4, 85).collect()), key=str)
    assert found == sorted([(5, 2, 5), (5, 2, 5), (7, 2, 5), (None, 2, None)], key=str)
    assert J.ngram_jaccard(df.limit(0), 4, 85).collect() == []


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_signatures_are_complete(percent):
    """Any two sets that reach the threshold share a signature."""
    rng = np.random.default_rng(3)
    for size in [*range(1, 40), 60, 100, 150, 300, 1000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            differ = int((100 - percent) * len(a) / percent)
            swap = rng.integers(0, differ + 1)
            gone = int(min(swap, len(a) - 1)) // 2
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, swap - gone, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common) and not np.array_equal(a, b):
                assert len(np.intersect1d(J.signatures(a, percent), J.signatures(b, percent)))


def test_bands_hold_all_partners():
    starts = J.band_starts(85)
    for size in range(1, 3000):
        band = int(np.searchsorted(starts, size, "right")) - 1
        largest = size * 100 // 85
        assert int(np.searchsorted(starts, largest, "right")) - 1 <= band + 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    df = spark.createDataFrame(edges + [(None, 3)], "u bigint, v bigint")
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r[0]: r[1] for r in components(df).collect()} == {x: top(x) for x in linked}
    assert components(df.limit(0)).collect() == []


def test_null_columns(spark):
    df = spark.createDataFrame([(1, None)], "doc_id bigint, text string").withColumn("component_id", F.lit("x"))
    assert [tuple(r) for r in J.ngram_jaccard(df).collect()] == [(1, 0, 1)]


def test_sketches_never_differ_in_more_bits_than_tokens(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for size in (1, 30, 500, 511, 513, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for gone in (0, 1, size // 10, size // 2):
            b = np.union1d(a[gone:], rng.integers(0, 1 << 63, 2 * gone, dtype=np.uint64))
            rows = [J.sketch(x).view(np.int64).tolist() for x in (a, b)]
            pairs.append((*rows, len(np.setxor1d(a, b)), abs(len(a) - len(b)) < 0.5 * len(a)))
    df = spark.createDataFrame(pairs, "x array<bigint>, y array<bigint>, differ long, near boolean")
    told = df.withColumns({"u": J._folded(F.col("x")), "v": J._folded(F.col("y"))}).select(
        "differ", "near", J._turned("x", "y").alias("long"), J._turned("u", "v").alias("short")
    )
    for r in told.collect():
        assert r.long <= r.differ and r.short <= r.differ
        assert r.long >= 0.6 * r.differ or not r.near


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("size", [60, 190, 300, 900, 1500, 6000])
def test_unrelated_sets_of_any_size_share_no_signature(size, percent):
    """A segment without a token is the same in all sets: pairs grew with the square of their number."""
    rng = np.random.default_rng(size)
    seen = {}
    for k in range(60):
        for code in J.signatures(np.unique(rng.integers(0, 1 << 63, size + k, dtype=np.uint64)), percent).tolist():
            assert seen.setdefault(code, k) == k


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_signatures_are_complete_at_the_threshold(percent):
    """Sets that differ in as many tokens as may be, by loss, gain or both, share a signature.

    The lost and new tokens are those of whole segments of one scheme, so that agreement is rarest.
    """
    rng = np.random.default_rng(7)
    for size in (8, 20, 55, 70, 150, 200, 450, 1000, 1400, 3000):
        for share in (0, 0.5, 1):
            for _ in range(4):
                a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
                differ = (100 - percent) * len(a) // percent
                gone = int(differ * share) * percent // 100
                new = max(0, (len(a) - gone) * 100 // percent - len(a))
                scheme = int(np.searchsorted(J.band_starts(percent), len(a), "right")) - 1
                largest = J.band_starts(percent)[scheme + 1] - 1
                once, double, _ = J.allocate(largest, (100 - percent) * largest // percent)
                dealt = J._mixed(a + np.uint64((scheme + 1) * 0x632BE59BD9B4E019 & J._MASK)) % np.uint64(once + double)
                tokens = np.bincount(dealt.astype(np.int64), minlength=once + double)
                heavy = np.argsort(-tokens[dealt.astype(np.int64)], kind="stable")
                b = np.union1d(np.delete(a, heavy[:gone]), rng.integers(0, 1 << 63, new, dtype=np.uint64))
                common = len(np.intersect1d(a, b))
                assert 100 * common >= percent * (len(a) + len(b) - common)
                if not np.array_equal(a, b):
                    assert len(np.intersect1d(J.signatures(a, percent), J.signatures(b, percent)))


def test_unrelated_long_texts_make_no_pairs(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(1500 + i))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert J.shared_signatures(J.indexed(df, 5, 80, "doc_id", "text")).isEmpty()
