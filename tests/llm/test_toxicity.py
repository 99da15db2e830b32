from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from galegrid.llm import toxicity as T
from galegrid.session import arrow_rows

BAD = ("grubble", "snarfle", "vexous")


def corpus(n, seed=5):
    """(doc_id, text, quality, toxic): toxic ones hold bad words, also under unseen endings."""
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 60))
        toxic, junk = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            words[:2] = [rng.choice(BAD) + rng.choice(("", "ish", str(i))) for _ in range(2)]
        if junk:
            words += ["zzjunk"] * 3
        rng.shuffle(words)
        rows.append((i, " ".join(words), 0 if junk else 1, int(toxic)))
    return rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t, "old") for i, t, _, _ in rows], "doc_id bigint, text string, p_toxic string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows[:350]], "doc_id bigint, quality int, toxic int")
    return rows, docs, labels, T.toxicity(docs, labels)


def test_held_out_accuracy(scored):
    rows, docs, _, out = scored
    said = {r.doc_id: (r.p_low_quality >= 0.5, r.is_toxic) for r in out.collect()}
    held = rows[350:]
    assert sum(said[i][1] == bool(t) for i, _, _, t in held) >= 0.97 * len(held)
    assert sum(said[i][0] == (q == 0) for i, _, q, _ in held) >= 0.95 * len(held)
    assert out.columns == [*docs.columns, "p_low_quality", "is_toxic"]


def test_later_links_use_earlier_log_odds(spark):
    """A category that no word tells, but the first category does."""
    rng = np.random.default_rng(2)
    y = (rng.random(400) < 0.4).astype(float)
    before = np.where(y > 0, 2.0, -2.0)[:, None]
    weights, earlier, bias = T.fit_linear([["same", f"only{i}"] for i in range(400)] + [], before, y)
    link = T.Link("late", weights, earlier, bias)
    assert not weights and earlier[0] > 0.5
    assert link.logit(["same"], [2.0]) > 0 > link.logit(["same"], [-2.0])


def test_reruns_agree(scored):
    _, docs, labels, out = scored
    again = T.toxicity(docs, labels)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_nulls_empty_texts_and_tables(spark, scored):
    _, _, labels, _ = scored
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "grubble snarfle"), (3, "grubble snarfle"), (None, "vexous"), (5, "w1 " * 50_000)],
        "doc_id bigint, text string",
    )
    out = T.toxicity(docs, labels)
    assert out.count() == 6
    none = T.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == 6 and not any(r.is_toxic for r in none)
    assert T.toxicity(docs.limit(0), labels).collect() == []
    clash = T.toxicity(docs.withColumn("_p", F.lit("mine")), labels)
    assert {r["_p"] for r in clash.collect()} == {"mine"} and "_p_" not in clash.columns
    odd = spark.createDataFrame([(None, 1, 1), (2, None, 0), (3, 1, None), (3, 1, 1)], labels.schema)
    assert T.toxicity(docs, odd).count() == 6


def test_one_class_is_its_base_rate():
    weights, earlier, bias = T.fit_linear([["a"], ["b"]], np.zeros((2, 1)), np.zeros(2))
    assert not weights and earlier == (0.0,) and bias < 0


def test_texts_share_the_strings_of_their_features():
    first, second, none = T.shared_features(["ample words", "words again", None])
    assert set(first) == set(T.features("ample words")) and none == []
    assert {id(f) for f in first if f == "words"} == {id(f) for f in second if f == "words"}


def test_a_fit_holds_numbers_not_lists_of_words():
    """Of every word of every text a fit keeps four bytes, no reference to a string."""
    plain = [f"w{i}" for i in range(1000)]
    tracemalloc.start()
    rows = ([*plain, "bad"] if k % 2 else list(plain) for k in range(600))
    weights, _, _ = T.fit_linear(rows, np.zeros((600, 0)), np.arange(600) % 2.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(weights) == ["bad"] and peak < 600 * 1000 * 6


def test_whole_texts_are_not_sent_in_large_batches(spark, scored):
    _, _, _, out = scored
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    with arrow_rows(spark, T.FIT_BATCH):
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(T.FIT_BATCH)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
