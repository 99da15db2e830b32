"""Area-by-condition grids, labels on them, and their expansion to training rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted, select_except
from ..session import cut_lineage
from .align import CONDITIONS
from .skew import BROADCAST_BYTES, checked_join, fits, hot_keys, join_with_hot_keys

ROWS_PER_BLOCK = 2_000
CHUNK = 10_000


def distinct_conditions(weather: DataFrame, conditions: Sequence[str] = CONDITIONS) -> DataFrame:
    """Distinct combinations of the condition columns; a null combination is one row."""
    return weather.select(*[quoted(c) for c in conditions]).distinct()


def all_combinations(few: DataFrame, many: DataFrame) -> DataFrame:
    """Every row of `few` with every row of `many`, as an equi join on block numbers.

    Rows are cut into blocks by hash; each side is copied once per block of the other, so
    every task builds one block of the grid and no side is broadcast. `few` counts its rows
    to choose its number of blocks.
    """
    few_blocks = max(1, math.ceil(few.count() / ROWS_PER_BLOCK))
    many_blocks = 2 * int(few.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def block(df: DataFrame, blocks: int):
        return F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(blocks)).cast("int")

    def copies(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = few.withColumn("_few", block(few, few_blocks)).withColumn("_many", copies(many_blocks))
    right = many.withColumn("_many", block(many, many_blocks)).withColumn("_few", copies(few_blocks))
    return left.join(right, ["_few", "_many"]).drop("_few", "_many")


def condition_grid(
    areas: DataFrame,
    weather: DataFrame,
    profile: DataFrame,
    code: str,
    name: str,
    conditions: Sequence[str] = CONDITIONS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Areas with a profile x distinct conditions, with the profile columns of their name.

    Areas without a profile vanish before the grid is built; the wide profile columns are
    attached after it. The profile, one row per area name, is stored as it is read twice.
    """
    profile = cut_lineage(profile)
    known = areas.select(quoted(code), quoted(name)).join(
        profile.select(quoted(name)).distinct(), name, "left_semi"
    )
    distinct = distinct_conditions(weather, conditions)
    keys = all_combinations(known.select(quoted(code), quoted(name)), distinct)
    if fits(profile, max_bytes):
        grid = keys.join(F.broadcast(profile), [name])
    else:
        # a name's rows of the grid follow from its areas, so the grid is not run to count them
        weight, times = "_weight", distinct.count()
        per_name = known.groupBy(quoted(name)).agg((F.count(F.lit(1)) * times).alias(weight))
        hot = hot_keys(per_name, [name], weight=weight)
        grid = join_with_hot_keys(keys, profile, [name], [code, *conditions], hot)
    wide = [c for c in profile.columns if c != name]
    return grid.select(*[quoted(c) for c in [code, name, *conditions, *wide]])


def label_grid(
    grid: DataFrame,
    counts: DataFrame,
    conditions: Sequence[str] = CONDITIONS,
    by: Sequence[str] = (),
    zero_label: str | None = None,
    damage: str = "Damage_Type",
    count_col: str = "Total_Incidents",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Grid left join label counts on the conditions; null conditions find no counts.

    `by` adds join columns such as an area code, for counts of located incidents. Areas then
    have no counts for most conditions: `zero_label` gives those rows that label and count 0.
    The counts, one row per condition and type, are stored, as their size decides the join.
    """
    counts = cut_lineage(counts)
    keys = [*conditions, *by]
    spread = [c for c in grid.columns if c not in keys][:2] or keys
    joined = checked_join(grid, counts, keys, spread, "left", max_bytes)
    rest = [c for c in counts.columns if c not in keys]
    labelled = joined.select(*[quoted(c) for c in [*grid.columns, *rest]])
    if zero_label is None:
        return labelled
    return labelled.withColumns(
        {
            damage: F.coalesce(quoted(damage), F.lit(zero_label)),
            count_col: F.coalesce(quoted(count_col), F.lit(0)),
        }
    )


def _repeated(df: DataFrame, times: Column, numbered: bool = False) -> DataFrame:
    """Every row `times` times, spread over the tasks however large a single count is.

    `numbered` keeps what tells the copies apart, `_chunk` and `_copy`.

    A row first becomes one row per CHUNK copies; those are dealt out by hash (a fixed number
    of partitions, as their small size before the expansion must not merge them again) and
    each then makes its at most CHUNK copies.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = F.ceil(F.col("_times") / CHUNK).cast("int")
    dealt = (
        df.withColumn("_times", times.cast("bigint"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .repartition(partitions, *[quoted(c) for c in df.columns], "_chunk")
    )
    left = F.least(F.col("_times") - F.col("_chunk").cast("bigint") * CHUNK, F.lit(CHUNK))
    copies = F.sequence(F.lit(1), left.cast("int"))
    made = dealt.withColumn("_copy", F.explode(copies)).drop("_times")
    return made if numbered else made.drop("_chunk", "_copy")


def repeat_rows(df: DataFrame, count_col: str) -> DataFrame:
    """Every row as often as its count says; rows with a count of 0 or null vanish."""
    positive = df.where(quoted(count_col) > 0)
    return select_except(_repeated(positive, quoted(count_col)), {count_col})


def training_rows(
    labelled: DataFrame, count_col: str = "Total_Incidents", drop: Sequence[str] = ()
) -> DataFrame:
    """Rows with count 0 once, count n > 0 n times, null counts not at all; one pass."""
    kept = labelled.where(quoted(count_col) >= 0)
    times = F.greatest(quoted(count_col), F.lit(1))
    return select_except(_repeated(kept, times), {count_col, *drop})


def labelled_set(
    areas: DataFrame,
    weather: DataFrame,
    profile: DataFrame,
    counts: DataFrame,
    code: str,
    name: str,
    conditions: Sequence[str] = CONDITIONS,
    damage: str = "Damage_Type",
    count_col: str = "Total_Incidents",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`label_grid(condition_grid(...), counts)` in the cheap order.

    Counts depend on the conditions only, so they are joined to the distinct conditions
    before the grid multiplies them by the areas; the wide profile comes last. The profile,
    one row per area name, is stored as it is read twice.
    """
    profile = cut_lineage(profile)
    known = areas.select(quoted(code), quoted(name)).join(
        profile.select(quoted(name)).distinct(), name, "left_semi"
    )
    labelled = distinct_conditions(weather, conditions).join(counts, list(conditions), "left")
    grid = all_combinations(known.select(quoted(code), quoted(name)), labelled)
    wide = [c for c in profile.columns if c != name]
    joined = checked_join(grid, profile, [name], [code, *conditions, damage], "inner", max_bytes)
    return joined.select(*[quoted(c) for c in [code, name, *conditions, *wide, damage, count_col]])


def training_set(
    areas: DataFrame,
    weather: DataFrame,
    profile: DataFrame,
    counts: DataFrame,
    code: str,
    name: str,
    conditions: Sequence[str] = CONDITIONS,
    damage: str = "Damage_Type",
    count_col: str = "Total_Incidents",
    drop: Sequence[str] = (),
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`training_rows(labelled_set(...))` in the cheap order.

    The narrow rows of conditions and counts are repeated first; the copies, told apart by
    number so that they spread, are then multiplied by the areas, and the wide profile comes last.
    """
    profile = cut_lineage(profile)
    known = areas.select(quoted(code), quoted(name)).join(
        profile.select(quoted(name)).distinct(), name, "left_semi"
    )
    labelled = distinct_conditions(weather, conditions).join(counts, list(conditions), "left")
    kept = labelled.where(quoted(count_col) >= 0)
    copies = _repeated(kept, F.greatest(quoted(count_col), F.lit(1)), numbered=True).drop(count_col)
    grid = all_combinations(known.select(quoted(code), quoted(name)), copies)
    wide = [c for c in profile.columns if c != name]
    spread = [code, *conditions, damage, "_chunk", "_copy"]
    joined = checked_join(grid, profile, [name], spread, "inner", max_bytes)
    out = [c for c in [code, name, *conditions, *wide, damage] if c not in set(drop)]
    return joined.select(*[quoted(c) for c in out])


def concat_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union all of tables with equal column names and types; other schemas are an error."""
    shape = {f.name: f.dataType for f in first.schema.fields}
    for other in others:
        theirs = {f.name: f.dataType for f in other.schema.fields}
        if theirs != shape:
            raise ValueError(f"schemas differ: {shape} and {theirs}")
        first = first.unionByName(other)
    return first
