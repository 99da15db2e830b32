"""Rows picked by exact rank, without sorting: narrowing counts over an integer order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..session import cut_lineage

#: Bins that a pass counts; as many rows come to the driver at most.
BINS = 4096


def smallest(df: DataFrame, value: Column, k: int) -> tuple[int, int, int]:
    """The k-th smallest value (from 1) of an integer expression, and how many rows are below and equal.

    Each pass counts the rows of the bins of a bracket of values and goes on with the bin that holds
    the rank, so 64 bits take six passes at most whatever the number of rows; a pass combines before
    its shuffle. Nulls do not count; k must not exceed the number of the others.
    """
    values = df.select(value.cast("bigint").alias("v")).where("v IS NOT NULL")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    below, equal = 0, None
    while equal is None:
        width = -(-(high - low + 1) // BINS)
        # the difference of two 64-bit numbers needs more than 64 bits
        number = F.floor((F.col("v").cast("decimal(20,0)") - F.lit(str(low)).cast("decimal(20,0)")) / F.lit(str(width)).cast("decimal(20,0)"))
        inside = values.where(F.col("v").between(low, high))
        counted = inside.groupBy(number.cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for row in sorted(counted.collect(), key=lambda r: r["low"]):
            if k <= below + row["n"]:
                low, high = row["low"], row["high"]
                equal = row["n"] if low == high else None
                break
            below += row["n"]
    return low, below, equal


def draw(keys: Sequence[str], seed: int) -> Column:
    """60 bits of the MD5 of the seed and the key columns as text; a null key counts as empty text."""
    texts = [F.coalesce(quoted(k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *texts)), 1, 15), 16, 10).cast("bigint")


def exact_split(df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, out: str = "is_train") -> DataFrame:
    """Add `is_train`: false for exactly the share of the rows, rounded up, with the smallest draws.

    Which rows those are follows from the key columns alone, so partitioning and retries do not
    change it. Rows with equal draws go by all their columns; rows that are equal throughout are told
    apart by where they are stored, so their number is exact as well. A column named `out` is
    replaced. The rows are stored once; then counts find the last test row.
    """
    if not 0 <= test_share <= 1:
        raise ValueError("test_share is between 0 and 1")
    kept = [c for c in df.columns if c.lower() != out.lower()]
    rows = df.select(
        F.struct(*[quoted(c) for c in kept]).alias("row"),
        draw(keys, seed).alias("draw"),
        F.xxhash64(*[quoted(c) for c in kept], *[quoted(c).isNull() for c in kept]).alias("code"),
        F.monotonically_increasing_id().alias("place"),
    )
    stored = cut_lineage(rows)
    n = stored.count()
    # the share as it is written, so that 0.2 of 5 rows is 1
    wanted = -(-n * round(test_share * 10**9) // 10**9)
    is_test, left = F.lit(False), wanted
    ties, tied = stored, F.lit(True)
    for order in ("draw", "code", "place") if wanted else ():
        value, below, equal = smallest(ties, F.col(order), left)
        is_test = is_test | (tied & (F.col(order) < value))
        tied, left = tied & (F.col(order) == value), left - below
        if left == equal:
            break
        ties = stored.where(tied)
    if wanted:
        is_test = is_test | tied if left == equal else is_test
    return stored.select("row.*", (~is_test).alias(out))
