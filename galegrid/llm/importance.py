"""Target-distribution importance resampling: documents drawn by how much they read like a target.

Features are runs of words, hashed into buckets. An array holds each bucket's gain, the logarithm
of how much more often the target uses it; a document's weight is the sum of the gains of its
features, looked up in that array, and a repeatable Gumbel draw is added, so that the highest
scores are a sample without replacement.

Ranks come from parallel sorting by regular sampling. Every task sorts its rows into a run. Regular
samples of the runs, sorted, give regular splitters. Splitters cut all runs into segments of about
equal size, whatever the scores are: a row's place in its run is part of its sort key, so equal
scores and repeated rows are cut as well. Rows of one segment are exchanged and merged; counts of
the segments before give the exact rank. Only segments that begin among the drawn ranks need
exchange; all others hold no drawn row.

What reaches the driver has fixed bounds: one count for each bucket, `SAMPLES` samples for each of
`MAX_SEGMENTS` segments, and one count for each segment.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import with_arrow_columns

#: A segment holds about as many rows; more when there would be more than MAX_SEGMENTS of them.
SEGMENT_ROWS = 2_000
MAX_SEGMENTS = 10_000
#: Regular samples for each segment.
SAMPLES = 32
#: Texts are cut into pieces of about as many bytes, at the end of a word.
PIECE = 1 << 20

#: Bytes of words: a-z, 0-9 and all beyond ASCII; A-Z become a-z, all else separates.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)
_PLACE_BITS = 33  # of monotonically_increasing_id: the partition's number, then the row's


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in pieces."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def features(text: str | None, size: int, buckets: int) -> tuple[int, list[np.ndarray]]:
    """The number of words, and the buckets of all runs of 1 to `size` words, repeats included."""
    count, found, before = 0, [], []
    for piece in words(text):
        count += len(piece)
        told = len(before)  # words that belong to runs which end in this piece
        piece = before + piece
        codes = [zlib.crc32(w) for w in piece]
        found.append(np.array(codes[told:], np.int64) % buckets)
        spaced = [b" " + w for w in piece]
        for n in range(1, size):
            # codes[i] is that of the run of n words from i; one more word goes on from there
            codes = list(map(zlib.crc32, islice(spaced, n, None), codes))
            found.append(np.array(codes[max(0, told - n) :], np.int64) % buckets)
        before = piece[-(size - 1) :] if size > 1 else []
    return count, found


def counts(docs: DataFrame, text: str, size: int, buckets: int) -> np.ndarray:
    """How often each bucket comes in all texts; tasks add up before anything is exchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for found in features(value.as_py(), size, buckets)[1]:
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    told = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for row in told.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * ln) of the ratio of the smoothed shares in the target and in the source."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(scale * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def draw(seed: int, key: int | None, scale: int) -> int:
    """The Gumbel number of a key; a null key draws as an empty one."""
    name = f"{seed}:{'' if key is None else key}".encode()
    h = int.from_bytes(hashlib.sha256(name).digest()[:4], "big")
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, size: int, seed: int, scale: int, key: str, text: str) -> DataFrame:
    """`docs` without `text`, with n_features, weight, score and n_words."""
    buckets = len(gain)

    def make() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            made = []
            for k, value in zip(batch.column(key), batch.column(text)):
                n_words, found = features(value.as_py(), size, buckets)
                weight = sum(int(gain[x].sum()) for x in found)
                made.append((sum(map(len, found)), weight, weight + draw(seed, k.as_py(), scale), n_words))
            return [pa.array([m[c] for m in made], pa.int64()) for c in range(4)]

        return run

    fields = [T.StructField(n, T.LongType()) for n in ("n_features", "weight", "score", "n_words")]
    return with_arrow_columns(docs, fields, make, reads=[key, text], keep=[c for c in docs.columns if c != text])


def _order(scores: np.ndarray, keys: np.ndarray, no_key: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte strings that sort as the highest score, the least key, null keys last, the first place do."""
    out = np.zeros(len(scores), np.dtype([("s", ">u8"), ("n", "u1"), ("k", ">u8"), ("p", ">u8")]))
    out["s"] = ~(scores.astype(np.uint64) ^ np.uint64(1 << 63))
    out["n"], out["k"], out["p"] = no_key, keys.astype(np.uint64) ^ np.uint64(1 << 63), places
    return out.view("S25")


def _arrays(rows: pa.RecordBatch) -> np.ndarray:
    score, key, place = (rows.column(c) for c in ("score", "key", "place"))
    return _order(
        score.to_numpy(zero_copy_only=False),
        key.fill_null(0).to_numpy(zero_copy_only=False),
        key.is_null().to_numpy(zero_copy_only=False),
        place.to_numpy(zero_copy_only=False),
    )


def ranked(rows: DataFrame, takes_part: str, percent: int, key: str, score: str = "score", rank: str = "rank") -> DataFrame:
    """`rows` with the rank, from 1, of the `percent` per cent highest scores among those that take part.

    `takes_part` is SQL for which rows do. Equal scores go by the smaller key, null keys last, rows
    that are equal in both in an order of their own. All other rows have a null rank.
    """
    names = rows.columns
    inner = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]
    told = rows.select(
        *inner, F.expr(takes_part).alias("part"), F.col(f"`{score}`").cast("bigint").alias("score"), F.col(f"`{key}`").cast("bigint").alias("key")
    ).withColumn("part", F.coalesce("part", F.lit(False)) & F.col("score").isNotNull())
    runs = told.sortWithinPartitions(F.desc("part"), F.desc("score"), F.asc_nulls_last("key"))
    runs = cut_lineage(runs.withColumn("place", F.monotonically_increasing_id()))

    n = runs.where("part").count()
    wanted = n * percent // 100
    per_segment = max(SEGMENT_ROWS, -(-n // MAX_SEGMENTS))
    stride = max(1, per_segment // SAMPLES)
    run, row = F.shiftrightunsigned("place", _PLACE_BITS), F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)
    # a run's first sample comes at a place of its own, so runs shorter than the stride count as well
    sampled = runs.where(F.col("part") & (F.pmod(row + F.xxhash64(run), F.lit(stride)) == 0))
    picked = np.sort(_arrays(_batch(sampled.select("score", "key", "place"))))
    splitters = picked[SAMPLES - 1 :: SAMPLES]

    def make() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        return lambda batch: [pa.array(np.searchsorted(splitters, _arrays(batch), "right").astype(np.int32))]

    dealt = with_arrow_columns(runs.where("part"), [T.StructField("segment", T.IntegerType())], make, ["score", "key", "place"], rows=10_000)
    sizes = sorted(map(tuple, dealt.groupBy("segment").count().collect()))
    offsets, before = [], 0
    for segment, size in sizes:
        if before < wanted:
            offsets.append((segment, before))
        before += size
    last = offsets[-1][0] if offsets else -1
    spark = rows.sparkSession
    firsts = F.broadcast(spark.createDataFrame(offsets, "segment int, before bigint"))
    merged = Window.partitionBy("segment").orderBy(F.desc("score"), F.asc_nulls_last("key"), "place")
    head = dealt.where(F.col("segment") <= last).withColumn("row", F.row_number().over(merged)).join(firsts, "segment")
    place = F.col("before") + F.col("row")
    out = [F.col(f"c{k}").alias(c) for k, c in enumerate(names) if c.lower() != rank.lower()]
    none = F.lit(None).cast("bigint").alias(rank)
    return (
        head.select(*out, F.when(place <= wanted, place).alias(rank))
        .unionByName(dealt.where(F.col("segment") > last).select(*out, none))
        .unionByName(runs.where(~F.col("part")).select(*out, none))
    )


def _batch(df: DataFrame) -> pa.RecordBatch:
    """The rows of a bounded sample on the driver."""
    return df.toArrow().combine_chunks().to_batches()[0] if not df.isEmpty() else pa.RecordBatch.from_pylist([], pa.schema([("score", pa.int64()), ("key", pa.int64()), ("place", pa.int64())]))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    size: int = 3,
    buckets: int = 10_000,
    seed: int = 42,
    scale: int = 1000,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """`docs` without `text`, with n_features, weight, score, n_words and rank.

    Drawn are `percent` per cent of the documents with at least `least_words` words; their rank
    counts from 1, all others have none. `key` is an integer; rows with a null key draw alike and
    come last among equal scores. Repeated rows count and are drawn separately. A null text has
    no words: weight 0. Without any documents, or any target text, all still holds. Columns of
    `docs` that have the name of a new one are replaced.
    """
    gain = gains(counts(docs, text, size, buckets), counts(target, target_text, size, buckets), scale)
    return ranked(scored(docs, gain, size, seed, scale, key, text), f"n_words >= {least_words}", percent, key)
