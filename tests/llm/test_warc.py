from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from galegrid.llm import warc as A

SCHEMA = "page_id bigint, url string, html string, kind string"


def brute(rows):
    best = {}
    for i, _, h, *_ in rows:
        best[h or ""] = max(best.get(h or "", i), i)
    out = set()
    for i, _, h, *_ in rows:
        p = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        first = best[h or ""] == i
        out.add((i, len(p), digest, "response" if first else "revisit", None if first else best[h or ""]))
    return out


def fixture(seed=1):
    rng = random.Random(seed)
    texts = ["", None, "é" * 700, "x\r\n\r\nWARC/1.1\r\n", "0\r\n\r\n", "a" * 5000] + ["".join(rng.choices("ab<é\n", k=rng.randint(1, 900))) for _ in range(12)]
    return [(i, rng.choice([None, f"http://h/{i}", "http://h/a b\r\nWARC-Type: x"]), rng.choice(texts), "k") for i in range(80)]


@pytest.mark.parametrize("segment", [50, 400, 1 << 16])
def test_round_trip(spark, tmp_path, segment):
    rows = fixture()
    A.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(5), str(tmp_path / "w"), segment_bytes=segment)
    records = A.read_archives(spark, str(tmp_path / "w"))
    assert records.where("problem is not null").count() == 0
    assert {tuple(r) for r in A.page_digests(records).collect()} == brute(rows)
    texts = {r[2] or "" for r in rows}
    assert {bytes(r.payload).decode() for r in records.where("kind = 'response'").collect()} == texts


def test_files_are_archives(spark, tmp_path):
    A.write_archives(spark.createDataFrame(fixture(), SCHEMA).coalesce(1), str(tmp_path / "w"), segment_bytes=300)
    seen = 0
    for file in (tmp_path / "w").glob("part-*"):
        for headers, block in A.parsed(gzip.decompress(file.read_bytes())):
            seen += 1
            assert len(block) <= 300 and headers["warc-type"] in ("response", "revisit", "continuation")
            assert headers["warc-block-digest"] == "sha1:" + A.sha1_base32(block)
    assert seen > 80


def test_least_size(spark, tmp_path):
    rows = [(1, None, "ab", None), (2, None, "ab", None), (3, None, "abcdef", None), (4, None, "abcdef", None)]
    A.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"), least_bytes=3)
    found = {r.page_id: r.record_type for r in A.page_digests(A.read_archives(spark, str(tmp_path / "w"))).collect()}
    assert found == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_ties_nulls_and_empty_tables(spark, tmp_path):
    rows = [(5, "u", "same", None), (5, "u", "same", None), (None, "u", "same", None), (None, None, None, None)]
    A.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"))
    found = sorted(((r.page_id, r.record_type, r.refers_to) for r in A.page_digests(A.read_archives(spark, str(tmp_path / "w"))).collect()), key=str)
    assert found == sorted([(5, "response", None), (5, "revisit", 5), (None, "revisit", 5), (None, "response", None)], key=str)
    A.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert A.read_archives(spark, str(tmp_path / "e")).collect() == []


def test_broken_records_are_told(spark, tmp_path):
    rows = [(i, None, chr(97 + i) * 1000, None) for i in range(5)]
    A.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"), segment_bytes=300)
    records = A.read_records(spark, str(tmp_path / "w")).cache()
    page = F.split_part("record_id", F.lit(":"), F.lit(3)).cast("int")
    broken = (
        records.where(~((page == 0) & (F.col("number") == 2)))
        .where(~((page == 1) & F.col("total").isNotNull()))
        .withColumn("total", F.when(page == 2, F.col("total") + 1).otherwise(F.col("total")))
        .withColumn("digest", F.when(page == 3, F.lit("sha1:X")).otherwise(F.col("digest")))
    )
    found = {r.record_id.split(":")[2]: r.problem for r in A.payloads(A.reassembled(broken.unionByName(broken))).collect()}
    assert "missing" in found["0"] and "last" in found["1"] and "length" in found["2"] and "digest" in found["3"]
    assert found["4"] is None


def test_chunks():
    for n in (0, 1, 9, 10, 11, 100):
        data = bytes(range(n % 256)) * 1
        assert A.dechunked(A.chunked(data, 10)) == data
    assert A.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: t\r\n\r\n") == b"abc"
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b""):
        with pytest.raises(ValueError):
            A.dechunked(bad)
