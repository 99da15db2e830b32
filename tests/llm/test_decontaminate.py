from __future__ import annotations

import itertools
import random

import pytest

from galegrid.llm import decontaminate as D

DOCS, ITEMS = "doc_id bigint, text string, item_id string", "item_id bigint, text string, doc_id string"


def brute(docs, items):
    """Best overlap of each pair by trying every placing."""
    out = {}
    for d, text, *_ in docs:
        w = (text or "").lower().split()
        for i, item, *_ in items:
            v = (item or "").lower().split()
            if d is None or i is None or len(v) < D.LEAST_WORDS:
                continue
            width = min(len(v), D.WINDOW)
            errors = D.ERRORS if len(v) >= D.WINDOW else 0
            best = None
            for a in range(len(w) - width + 1):
                for b in range(len(v) - width + 1):
                    same = sum(x == y for x, y in zip(w[a : a + width], v[b : b + width]))
                    if same >= width - errors and (best is None or (-same, a, b) < best):
                        best = (-same, a, b)
            if best:
                out[d, i] = (best[1], best[2], width, -best[0])
    return out


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate((3, 5, 8, 12, 13, 14, 20, 35, 50))]
    items += [(20, None), (21, ""), (None, items[-1][1]), (22, items[6][1].upper())]
    docs = []
    for k in range(60):
        words = rng.choices(vocabulary, k=rng.choice((0, 4, 30, 90)))
        if k % 2:
            part = items[rng.randrange(9)][1].split()
            lo = rng.randrange(max(1, len(part) - 13))
            part = part[lo:]
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((k, " ".join(words)))
    return docs + [(100, None), (101, " "), (None, items[7][1])], items


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_placings(spark, seed):
    docs, items = fixture(seed)
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    other = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    found = {(r.doc_id, r.item_id): (r.start, r.item_start, r.n_words, r.n_equal) for r in D.leaks(df, other).collect()}
    expected = brute(docs, items)
    assert found == expected and len(expected) > 15
    kept = {r.doc_id for r in D.decontaminate(df, other).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in expected}


def test_masks_fit_between_any_errors():
    for errors in itertools.combinations(range(D.WINDOW), D.ERRORS):
        assert any(
            not {p + at for p in mask} & set(errors)
            for mask in D.MASKS
            for at in range(D.WINDOW - mask[-1])
        )


def test_empty_tables_and_columns(spark):
    docs, items = fixture(3)
    df, other = spark.createDataFrame([(*d, None) for d in docs], DOCS), spark.createDataFrame([(*i, None) for i in items], ITEMS)
    assert D.leaks(df.limit(0), other).collect() == []
    assert D.leaks(df, other.limit(0)).collect() == []
    assert D.decontaminate(df, other.limit(0)).columns == df.columns
    twice = D.leaks(df.unionByName(df), other)
    assert twice.count() == D.leaks(df, other).count()
