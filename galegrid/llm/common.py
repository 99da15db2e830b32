"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as the contracts define it, for regular expressions.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """`text` with A-Z lower-cased and every other character kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of `text` as an array; null text and text without words give an empty one."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda w: w != "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that `df` does not have, in whatever case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def columns_of(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of `like`, in its order, out of `df`."""
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def with_arrow_columns(
    df: DataFrame,
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    reads: Sequence[str],
    keep: Sequence[str] | None = None,
    rows: int = 256,
) -> DataFrame:
    """The columns `keep` of `df` (all, if None) and the ones that a function over Arrow slices gives.

    `make` is called once in each task and returns the function; it gets the columns `reads` of at
    most `rows` rows at a time, named as asked, and returns one array for each of `fields`. Kept
    columns of the same name, in any case, are replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    sent = df.select(
        *[F.col(f"`{c}`").alias(f"k{k}") for k, c in enumerate(kept)],
        *[F.col(f"`{c}`").alias(f"r{k}") for k, c in enumerate(reads)],
    )
    inner = T.StructType(
        [T.StructField(f"k{k}", sent.schema[k].dataType) for k in range(len(kept))]
        + [T.StructField(f"n{k}", f.dataType) for k, f in enumerate(fields)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                columns = part.columns
                read = pa.RecordBatch.from_arrays(columns[len(kept) :], names=list(reads))
                arrays = columns[: len(kept)] + function(read)
                yield pa.RecordBatch.from_arrays(arrays, names=inner.names)

    made = sent.mapInArrow(run, inner)
    names = [*kept, *[f.name for f in fields]]
    return made.select(*[F.col(a).alias(b) for a, b in zip(inner.names, names)])
