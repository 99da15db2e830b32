"""Importance resampling against brute force; the sort on ties, repeats and many segments."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from galegrid.llm import importance

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text, size, buckets):
    words = WORDS.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, size + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def expected(docs, target, percent=5, least_words=20, size=3, buckets=10_000):
    found = [(k, *buckets_of(t, size, buckets)) for k, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in buckets_of(x, size, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in s}
    rows = []
    for k, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    part = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = Counter()
    drawn = [(*r, i + 1) for i, r in enumerate(part[: percent * len(part) // 100])]
    for r in drawn:
        rank[r[:5]] += 1
    rest = []
    for r in rows:
        if rank[r]:
            rank[r] -= 1
        else:
            rest.append((*r, None))
    return sorted(drawn + rest, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "n_words", "rank").collect()), key=str)


@pytest.mark.parametrize("rows_of_a_segment", [1, 64, 2000])
def test_as_brute_force(spark, sf_dir, monkeypatch, rows_of_a_segment):
    monkeypatch.setattr(importance, "SEGMENT_ROWS", rows_of_a_segment)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    want = expected([tuple(r) for r in docs.collect()], [r[0] for r in target.collect()], percent=40)
    assert got(importance.resample(docs.repartition(7), target, percent=40)) == want


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 5)
    docs = [(1, "One two  three FOUR five six seven"), (2, "a" * 40 + " b"), (3, "x\x00y\x7fz é日本 Ünder-score 42")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    target = ["three four", None]
    for size in (1, 2, 4):
        made = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), 50, 1, size, 97)
        assert got(made) == expected(docs, target, 50, 1, size, 97)


def test_nulls_repeats_empty_tables_and_clashing_names(spark):
    docs = [(1, "a b c"), (1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (2, ""), (3, "!!!"), (4, "c d")]
    df = spark.createDataFrame([(*d, 9, "k") for d in docs], "doc_id bigint, text string, RANK int, part string")
    no_target = spark.createDataFrame([], "text string")
    made = importance.resample(df, no_target, percent=60, least_words=1)
    assert made.columns == ["doc_id", "part", "n_features", "weight", "score", "n_words", "rank"]
    assert got(made) == expected(docs, [], 60, 1)
    assert importance.resample(df.limit(0), no_target).count() == 0


def test_ranks_of_equal_scores_are_cut_into_segments(spark, monkeypatch):
    monkeypatch.setattr(importance, "SEGMENT_ROWS", 64)
    rows = spark.range(5000).select((F.col("id") % 3).alias("score"), (F.col("id") % 7).alias("doc_id"), "id")
    made = importance.ranked(rows.repartition(5), "id % 10 < 8", 60, "doc_id").where("rank IS NOT NULL")
    order = sorted([(-(i % 3), i % 7) for i in range(5000) if i % 10 < 8])[: 4000 * 60 // 100]
    assert [(-r["score"], r["doc_id"], r["rank"]) for r in made.orderBy("rank").collect()] == [(*o, k + 1) for k, o in enumerate(order)]
    assert made.select("id").distinct().count() == len(order)


def test_none_takes_part(spark):
    rows = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(None).cast("bigint").alias("score"))
    assert importance.ranked(rows, "true", 50, "doc_id").where("rank IS NULL").count() == 10
