"""Table profiling as tidy DataFrames: coverage, shape, nulls, describe, exact quantiles."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns, quoted

BINS = 4096
# Value brackets that one pass counts, at most: BINS rows of each come to the driver.
BRACKETS = 32
DESCRIBE_METRICS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def _tidy(row: DataFrame, cells: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One aggregate row to (column, metric, value) rows; `cells` names the sources."""
    parts = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(metric).alias("metric"),
            quoted(source).cast("double").alias("value"),
        )
        for column, metric, source in cells
    ]
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return df.agg(F.min(quoted(column)).alias("min_value"), F.max(quoted(column)).alias("max_value"))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    row = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns])
    parts = [F.struct(F.lit(c).alias("column"), quoted(c).alias("nulls")) for c in df.columns]
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def group_sizes(df: DataFrame, by: str, out: str = "n_rows") -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(quoted(by)).agg(F.count(F.lit(1)).alias(out))


def _share(value: Column, low: float, high: float) -> Column:
    """Position of a value between two others, safe where their difference overflows."""
    low, high = max(low, -sys.float_info.max), min(high, sys.float_info.max)
    if math.isinf(high - low):
        return (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    return (value - F.lit(low)) / F.lit(high - low)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[tuple[str, float], float | None]:
    """Exact quantiles with linear interpolation, without sorting or gathering the column.

    The wanted order statistics are bracketed by value. Every pass counts the rows of each
    bracket in BINS bins and narrows the bracket to the true minimum and maximum of the bin
    that holds the rank; it ends when that bin holds one value. A pass is one aggregate with
    at most BINS groups per bracket, so it combines before the shuffle at any table size. A
    pass takes BRACKETS brackets; those of further columns wait for the next one.
    """
    narrow = df.select(*[quoted(c).cast("double").alias(c) for c in columns])

    def usable(c: str):
        return F.when(~F.isnan(quoted(c)), quoted(c))

    first = narrow.agg(
        *[
            F.struct(F.count(usable(c)), F.min(usable(c)), F.max(usable(c))).alias(c)
            for c in columns
        ]
    ).first()
    ranks: dict[tuple[str, int], float | None] = {}
    open_ranks: dict[tuple[str, int], tuple[float, float, int]] = {}
    needed: dict[tuple[str, float], tuple[int, int, float]] = {}
    for c in columns:
        n, low, high = first[c]
        for p in probabilities:
            if n == 0:
                continue
            position = (n - 1) * p
            k0, k1 = math.floor(position), math.ceil(position)
            needed[(c, p)] = (k0, k1, position - k0)
            for k in (k0, k1):
                open_ranks[(c, k)] = (low, high, k)
    while open_ranks:
        for key, (low, high, _) in list(open_ranks.items()):
            if low == high:
                ranks[key] = low
                del open_ranks[key]
        brackets = sorted({(c, low, high) for (c, _), (low, high, _) in open_ranks.items()})[:BRACKETS]
        if not brackets:
            break
        hits = []
        for i, (c, low, high) in enumerate(brackets):
            number = F.floor(_share(quoted(c), low, high) * BINS)
            hit = F.struct(
                F.lit(i).alias("i"),
                F.least(F.greatest(number, F.lit(0)), F.lit(BINS - 1)).alias("bin"),
                quoted(c).alias("v"),
            )
            hits.append(F.when(quoted(c).between(low, high), hit))
        binned = (
            narrow.select(F.explode(F.array_compact(F.array(*hits))).alias("h"))
            .groupBy("h.i", "h.bin")
            .agg(F.count(F.lit(1)).alias("n"), F.min("h.v").alias("low"), F.max("h.v").alias("high"))
            .collect()
        )
        bins: dict[int, list] = {}
        for row in sorted(binned, key=lambda r: (r["i"], r["bin"])):
            bins.setdefault(row["i"], []).append(row)
        index = {bracket: i for i, bracket in enumerate(brackets)}
        for key, (low, high, rank) in list(open_ranks.items()):
            if (key[0], low, high) not in index:
                continue
            for row in bins[index[(key[0], low, high)]]:
                if rank < row["n"]:
                    open_ranks[key] = (row["low"], row["high"], rank)
                    break
                rank -= row["n"]
    result: dict[tuple[str, float], float | None] = {}
    for c in columns:
        for p in probabilities:
            if (c, p) not in needed:
                result[(c, p)] = None
                continue
            k0, k1, share = needed[(c, p)]
            v0, v1 = ranks[(c, k0)], ranks[(c, k1)]
            result[(c, p)] = v0 if v0 == v1 else v0 + (v1 - v0) * share
    return result


def _description(
    df: DataFrame, columns: Sequence[str], exact: bool
) -> tuple[list[Column], list[tuple[str, str, str]]]:
    """The aggregates of `describe` and where each of its values comes from."""
    quartiles = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    found = exact_quantiles(df, columns, list(quartiles.values())) if exact else {}
    aggregates, cells = [], []
    for c in columns:
        value = quoted(c).cast("double")
        # Empty input rows carry the literal quartiles through max().
        plans = {
            "count": F.count(value).cast("double"),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            **{
                name: F.max(F.lit(found[(c, p)]).cast("double"))
                if exact
                else F.percentile_approx(value, p).cast("double")
                for name, p in quartiles.items()
            },
            "max": F.max(value),
        }
        for metric in DESCRIBE_METRICS:
            aggregates.append(plans[metric].alias(f"{c}|{metric}"))
            cells.append((c, metric, f"{c}|{metric}"))
    return aggregates, cells


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """(column, metric, value) of the numeric columns: count, mean, std, min, quartiles, max.

    `exact=False` takes approximate quartiles from the same single pass.
    """
    aggregates, cells = _description(df, list(columns or numeric_columns(df)), exact)
    return _tidy(df.agg(*aggregates), cells)


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Shape, null counts and describe of a table as one tidy (column, metric, value) table.

    One aggregate over the table, beside the passes for exact quartiles.
    """
    aggregates, cells = _description(df, list(columns or numeric_columns(df)), exact)
    nulls = [F.count_if(quoted(c).isNull()).alias(f"{c}|nulls") for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("|rows"), *nulls, *aggregates)
    row = row.withColumn("|columns", F.lit(len(df.columns)))
    whole = [("*", "n_rows", "|rows"), ("*", "n_columns", "|columns")]
    return _tidy(row, [*whole, *[(c, "nulls", f"{c}|nulls") for c in df.columns], *cells])


def observe_profile(
    df: DataFrame, columns: Sequence[str] | None = None, dates: str | None = None
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """`df` that is observed while it is written, and what gives its profile once it was.

    The profile has the number of rows and columns, nulls of all columns, count, mean, std, min and max
    of the numeric ones, and the first and last day (as days since 1970) of the column `dates`. The
    observation rides on the write, so it scans nothing; quartiles would need passes of their own
    (`profile`). Write the frame once: the profile is that of the first action.
    """
    numeric = list(columns or numeric_columns(df))
    aggregates, cells = [], []
    for c in numeric:
        value = quoted(c).cast("double")
        plans = {"count": F.count(value), "mean": F.avg(value), "std": F.stddev_samp(value), "min": F.min(value), "max": F.max(value)}
        for metric, plan in plans.items():
            aggregates.append(plan.cast("double").alias(f"m{len(cells)}"))
            cells.append((c, metric))
    for c in df.columns:
        aggregates.append(F.count_if(quoted(c).isNull()).cast("double").alias(f"m{len(cells)}"))
        cells.append((c, "nulls"))
    if dates is not None:
        day = F.unix_date(quoted(dates).cast("date"))
        for metric, plan in (("first_day", F.min(day)), ("last_day", F.max(day))):
            aggregates.append(plan.cast("double").alias(f"m{len(cells)}"))
            cells.append((dates, metric))
    aggregates.append(F.count(F.lit(1)).cast("double").alias(f"m{len(cells)}"))
    cells.append(("*", "n_rows"))
    observation = Observation()

    def told() -> DataFrame:
        found = observation.get
        rows = [(c, metric, found[f"m{k}"]) for k, (c, metric) in enumerate(cells)]
        rows.append(("*", "n_columns", float(len(df.columns))))
        return df.sparkSession.createDataFrame(rows, "column string, metric string, value double")

    return df.observe(observation, *aggregates), told


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first `n` rows by the order columns; without any some rows, which is not defined."""
    return (df.orderBy(*[quoted(c) for c in order]) if order else df).limit(n)


def top_n(df: DataFrame, by: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The `n` largest rows by a column, ties ordered by the tie-break columns."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie_break]).limit(n)
