"""Joins that hold when one key owns a large share of the rows.

A side is broadcast only after its size was measured against a bound. Beyond the bound the
join shuffles. Keys with too many rows for one task are then looked up (one narrow pass over
the big side); when there are any, their rows get a salt and the rows of the other side are
copied once per salt of that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quoted
from ..session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 2_000_000
ESTIMATE_SLACK = 64
UNKNOWN_BYTES = 2**60


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory size of a row, from the lengths of its variable columns."""
    total = F.lit(16)
    for field in df.schema.fields:
        col, kind = quoted(field.name), field.dataType
        if isinstance(kind, T.StringType):
            size = F.coalesce(F.octet_length(col), F.lit(0)) + 16
        elif isinstance(kind, T.ArrayType):
            width = 8 * len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 32
            size = F.coalesce(F.size(col), F.lit(0)) * (width + 16) + 16
        elif isinstance(kind, (T.StructType, T.MapType, T.BinaryType)):
            size = F.coalesce(F.octet_length(col.cast("string")), F.lit(0)) + 16
        else:
            size = F.lit(8)
        total = total + size
    return total


def _far_beyond(df: DataFrame, max_bytes: int) -> bool:
    """Whether the tables that `df` reads are far larger than the bound."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max_bytes * ESTIMATE_SLACK < read < UNKNOWN_BYTES


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the whole of `df` stays below `max_bytes`, measured by one aggregate.

    When the tables it reads are already far beyond the bound, nothing is run: the answer is
    no, and adaptive execution may still broadcast what turns out to be small.
    """
    if max_bytes <= 0 or _far_beyond(df, max_bytes):
        return False
    total = df.agg(F.sum(row_bytes(df).cast("bigint")).alias("bytes")).first()["bytes"]
    return (total or 0) <= max_bytes


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    weight: str | None = None,
) -> DataFrame | None:
    """Keys with more than `rows_per_task` rows and the salts each one needs; None when none.

    With `weight` a row stands for that many rows of the table that will be joined. At most one
    key in `rows_per_task` rows qualifies; the joins measure the list before broadcasting it.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(quoted(weight))
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(size.alias("_rows"))
    salts = F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_salts")
    hot = cut_lineage(
        counts.where(F.col("_rows") > rows_per_task).select(*[quoted(k) for k in keys], salts)
    )
    return None if hot.isEmpty() else hot


def _salt(keys: Sequence[str], spread: Sequence[str], salts: Column) -> Column:
    """Salt of a row; rows with a null key, which never match, are spread as well."""
    code = F.xxhash64(*[quoted(c) for c in spread])
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | quoted(k).isNull()
    return F.when(no_key, -1 - F.pmod(code, F.lit(1000))).otherwise(F.pmod(code, salts)).cast("int")


def _with_salts(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    marked = df.join(F.broadcast(hot) if fits(hot) else hot, list(keys), "left")
    return marked.withColumn("_salts", F.coalesce("_salts", F.lit(1)))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    shuffled: bool = False,
) -> DataFrame:
    """`big` join `small` on equally named `keys`; hot keys of `big` are split over tasks.

    `spread` names columns of `big` whose hash picks the salt (a hash, not a random number,
    so a recomputed task gives the same rows). `how` is inner, left (keeps `big`), left_semi
    or left_anti. `shuffled` says that `small` was measured to be too large for a broadcast: the
    planner knows its compressed files only, which may be a thousand times smaller.
    """
    return join_with_hot_keys(big, small, keys, spread, hot_keys(big, keys, rows_per_task), how, shuffled)


def join_with_hot_keys(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    hot: DataFrame | None,
    how: str = "inner",
    shuffled: bool = False,
) -> DataFrame:
    """The salted join where the hot keys are known already; a plain one without any."""
    if hot is None:
        return big.join(small.hint("merge") if shuffled else small, list(keys), how)
    salt = _salt(keys, spread, F.col("_salts"))
    left = _with_salts(big, hot, keys).withColumn("_salt", salt).drop("_salts")
    right = (
        _with_salts(small, hot, keys)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        .drop("_salts")
    )
    return left.join(right.hint("merge") if shuffled else right, [*keys, "_salt"], how).drop("_salt")


def checked_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast `small` when it was measured to fit, else the salted join."""
    if fits(small, max_bytes):
        return big.join(F.broadcast(small), list(keys), how)
    return salted_join(big, small, keys, spread, how, shuffled=not _far_beyond(small, max_bytes))


def salted_outer_join(
    kept: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`kept` left join `facts` where hot keys of `facts`, the nullable side, are split.

    A kept row is copied once per salt of its key; a copy that met no fact is dropped when
    the key is hot, as such a key has facts under another salt.
    """
    hot = hot_keys(facts, keys, rows_per_task)
    if hot is None:
        return kept.join(facts, list(keys), "left")
    right = (
        _with_salts(facts, hot, keys)
        .withColumn("_salt", _salt(keys, spread, F.col("_salts")))
        .withColumn("_met", F.lit(True))
        .drop("_salts")
    )
    left = (
        _with_salts(kept, hot, keys)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        .withColumn("_salt", F.least("_copy", _salt(keys, kept.columns, F.lit(1)) + F.col("_copy")))
        .drop("_copy")
    )
    joined = left.join(right, [*keys, "_salt"], "left")
    return joined.where(F.col("_met") | (F.col("_salts") == 1)).drop("_met", "_salts", "_salt")
