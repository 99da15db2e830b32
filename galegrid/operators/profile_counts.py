"""Per-area counts of points, in total and per value of category columns (wide)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import distinct_values, feature_name, quoted, unique_names
from ..session import cut_lineage
from .skew import BROADCAST_BYTES
from .spatial import points_in_areas


def count_per_key(df: DataFrame, key: str, id_col: str = "id", out: str = "Trees_Totaal") -> DataFrame:
    """Non-null ids per key."""
    return df.groupBy(quoted(key)).agg(F.count(quoted(id_col)).alias(out))


def count_per_category(df: DataFrame, key: str, category: str, out: str) -> DataFrame:
    """Rows per (key, category) without null keys or null categories."""
    counted = df.groupBy(quoted(key), quoted(category)).agg(F.count(quoted(category)).alias(out))
    return counted.na.drop("any")


def pivot_counts(
    long: DataFrame, key: str, category: str, counts: str, values: Sequence[str], prefix: str = "Trees"
) -> DataFrame:
    """Long counts to one column per value, missing combinations 0."""
    names = unique_names([feature_name(prefix, category, v) for v in values])
    wide = long.groupBy(quoted(key)).pivot(category, list(values)).agg(F.sum(quoted(counts)))
    return wide.na.fill(0).toDF(key, *names)


def join_pivots(base: DataFrame, pivots: Sequence[DataFrame], key: str) -> DataFrame:
    """Left join every pivot onto the base and fill numeric nulls with 0."""
    for pivot in pivots:
        base = base.join(pivot, key, "left").na.fill(0)
    return base


def wide_counts(
    points: DataFrame,
    key: str,
    categories: Sequence[str] | Mapping[str, Sequence[object]],
    id_col: str = "id",
    prefix: str = "Trees",
    total: str = "Trees_Totaal",
) -> DataFrame:
    """Total and per-category counts of every key in one pass.

    Rows are first counted per combination of key and categories (combined before the
    shuffle, so a crowded area costs its combinations, not its rows); the wide sums then run
    over those. Given as a mapping, `categories` names the values; else they are looked up.
    """
    names = list(categories)
    combos = points.groupBy(quoted(key), *[quoted(c) for c in names]).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(quoted(id_col)).alias("_ids")
    )
    if isinstance(categories, Mapping):
        values = {c: list(v) for c, v in categories.items()}
    else:
        combos = cut_lineage(combos)
        values = distinct_values(combos, names)

    def share(category: str, value: object) -> Column:
        # A null key has a total but no category counts, as a join on it never matches.
        wanted = quoted(key).isNotNull() & (quoted(category) == F.lit(value))
        return F.sum(F.when(wanted, F.col("_rows")).otherwise(0)).cast("bigint")

    columns = [(feature_name(prefix, c, v), share(c, v)) for c in names for v in values[c]]
    unique_names([n for n, _ in columns] + [key, total])
    return combos.groupBy(quoted(key)).agg(
        F.sum("_ids").cast("bigint").alias(total), *[e.alias(n) for n, e in columns]
    )


def long_counts(
    points: DataFrame, key: str, categories: Sequence[str], id_col: str = "id"
) -> DataFrame:
    """(key, column, value, n_rows, n_ids): counts of every value of every category column.

    The long form of `wide_counts`, for any number of values. The total of a key has the column
    name null; null values and values of a null key are left out, as they have no wide column.
    """
    combos = points.groupBy(quoted(key), *[quoted(c) for c in categories]).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(quoted(id_col)).alias("n_ids")
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in categories
    ]
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"))
    long = combos.select(quoted(key), F.explode(F.array(whole, *pairs)).alias("_p"), "n_rows", "n_ids")
    kept = long.select(quoted(key), "_p.column", "_p.value", "n_rows", "n_ids").where(
        F.col("column").isNull() | F.col("value").isNotNull() & quoted(key).isNotNull()
    )
    return kept.groupBy(quoted(key), "column", "value").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_ids").alias("n_ids")
    )


def area_profile(
    areas: DataFrame,
    points: DataFrame,
    key: str,
    categories: Sequence[str] | Mapping[str, Sequence[object]],
    id_col: str = "id",
    x: str = "x",
    y: str = "y",
    edges: str = "edges",
    prefix: str = "Trees",
    total: str = "Trees_Totaal",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Points per area `key` (a name or a code), in total and per category value.

    Equal keys of several areas are merged. Only the needed columns reach the join.
    """
    needed = list(dict.fromkeys([id_col, *categories, x, y]))
    narrow = points.select(*[quoted(c) for c in needed])
    joined = points_in_areas(
        areas.select(quoted(key), quoted(edges)), narrow, [key], x, y, edges, max_bytes=max_bytes
    )
    return wide_counts(joined, key, categories, id_col, prefix, total)
