"""Scalar and column-list helpers: dates, nulls, names, indicator columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Values of one column that may become columns, unless a call says otherwise.
VALUES_PER_COLUMN = 10_000

# The weather provider's named variable sets.
VARIABLE_SETS = {
    "WIND": ["DD", "FH", "FF", "FX"],
    "TEMP": ["T", "T10N", "TD"],
    "SUNR": ["SQ", "Q"],
    "PRCP": ["DR", "RH"],
    "VICL": ["VV", "N", "U"],
    "WEER": ["M", "R", "S", "O", "Y", "WW"],
}


def quoted(name: str) -> Column:
    """`col(name)` for any name, also one with dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_header(df: DataFrame) -> DataFrame:
    """Remove blanks and tabs from every column name."""
    return df.toDF(*[re.sub(r"[ \t]", "", c) for c in df.columns])


def front_columns(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """The named columns first, the rest sorted by name (code-point order)."""
    rest = sorted(c for c in df.columns if c not in set(front))
    return df.select(*[quoted(c) for c in [*front, *rest]])


def select_except(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """All columns but the excluded ones."""
    gone = set(excluded)
    return df.select(*[quoted(c) for c in df.columns if c not in gone])


def expand_variables(text: str, available: Sequence[str]) -> list[str]:
    """Column names meant by a `:`-separated list of names and set names; `ALL` means all."""
    wanted: list[str] = []
    for part in text.split(":"):
        wanted += list(available) if part == "ALL" else VARIABLE_SETS.get(part, [part])
    unknown = [w for w in wanted if w not in available]
    if unknown:
        raise ValueError(f"unknown variables: {unknown}")
    return list(dict.fromkeys(wanted))


def select_variables(
    df: DataFrame,
    variables: str = "ALL",
    stations: Sequence[int] | None = None,
    keys: Sequence[str] = ("STN", "YYYYMMDD", "HH"),
    station_col: str = "STN",
) -> DataFrame:
    """Keep the key columns and the chosen variables, for the chosen stations.

    Projection and `IN` filter both reach the file scan.
    """
    measures = [c for c in df.columns if c not in set(keys)]
    chosen = expand_variables(variables, measures)
    if stations is not None:
        df = df.where(quoted(station_col).isin(list(stations)))
    return df.select(*[quoted(c) for c in [*keys, *chosen]])


def feature_name(prefix: str, column: str, value: object) -> str:
    """`{prefix}_{column}_{value}` with blanks in the value turned into hyphens."""
    return f"{prefix}_{column}_{str(value).replace(' ', '-')}"


def unique_names(names: Sequence[str]) -> list[str]:
    """The names as given; an error when two are equal but for case, which Spark ignores."""
    seen: dict[str, str] = {}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"two values give the same column name: {seen[name.lower()]!r} and {name!r}")
        seen[name.lower()] = name
    return list(names)


def hyphenate(col: Column) -> Column:
    """Blanks to hyphens in a string column."""
    return F.replace(col, F.lit(" "), F.lit("-"))


def parse_yyyymmdd(col: Column, lenient: bool = False) -> Column:
    """`20200131` (integer or text) to a date; bad values raise unless lenient."""
    text = col.cast("string")
    return F.try_to_date(text, "yyyyMMdd") if lenient else F.to_date(text, "yyyyMMdd")


def parse_hour_stamp(col: Column) -> Column:
    """`YYYYMMDDHH` (integer or text) to a timestamp."""
    return F.to_timestamp(col.cast("string"), "yyyyMMddHH")


def format_hour_stamp(col: Column) -> Column:
    """A timestamp as `YYYYMMDDHH` text."""
    return F.date_format(col, "yyyyMMddHH")


def age_in_years(year: Column, as_of_year: int | None = None) -> Column:
    """Current (or given) year minus `year`."""
    now = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    return now - year


def clashing(columns: Iterable[str], others: Iterable[str]) -> set[str]:
    """Names in `columns` that Spark cannot tell from one in `others` (case is ignored)."""
    taken = {c.lower() for c in others}
    return {c for c in columns if c.lower() in taken}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def distinct_values(
    df: DataFrame,
    columns: Sequence[str],
    nulls: bool = False,
    most: int = VALUES_PER_COLUMN,
) -> dict[str, list[str | None]]:
    """Sorted values, as text, of columns whose values are to become columns.

    `nulls` lists None last where a column has nulls. What comes to the driver is bounded by
    `most` values for each column; a column with more is an error that names it. Such a column
    belongs in the long form, which has no limit, or needs its values named by the caller.
    """
    pairs = [
        F.struct(F.lit(i).alias("i"), quoted(c).cast("string").alias("v"))
        for i, c in enumerate(columns)
    ]
    found = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()
    if not nulls:
        found = found.where("v IS NOT NULL")
    found = cut_lineage(found)
    counts = {r["i"]: r["count"] for r in found.groupBy("i").count().collect()}
    wide = [f"{columns[i]} ({n})" for i, n in sorted(counts.items()) if n > most]
    if wide:
        raise ValueError(f"more than {most} values would become columns: {', '.join(wide)}")
    values: dict[str, list[str | None]] = {c: [] for c in columns}
    for row in sorted(found.collect(), key=lambda r: (r["i"], r["v"] is None, r["v"] or "")):
        values[columns[row["i"]]].append(row["v"])
    return values


def one_hot(
    df: DataFrame, values: Mapping[str, Sequence[object]] | Sequence[str]
) -> DataFrame:
    """Replace each named column by one 0/1 column `{column}_{value}` per value.

    A mapping names the values of each column; for a plain list of columns they are looked
    up. A null value (None) gives the column `{column}_null`.
    """
    if not isinstance(values, Mapping):
        values = distinct_values(df, list(values), nulls=True)
    kept = [quoted(c) for c in df.columns if c not in values]
    names, flags = [], []
    for column, options in values.items():
        for value in options:
            names.append(f"{column}_{'null' if value is None else value}")
            flags.append(quoted(column).eqNullSafe(F.lit(value)).cast("int"))
    unique_names([c for c in df.columns if c not in values] + names)
    return df.select(*kept, *[f.alias(n) for f, n in zip(flags, names)])


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise when a needed column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; present: {df.columns}")
