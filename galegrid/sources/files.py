"""File scans: delimited text, JSON records, paged GeoJSON feature collections."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_header, quoted
from ..functions.geometry import geojson_edges, geojson_point, geojson_wkt
from ..schemas import feature_collection
from .splitting import read_split_collections

Paths = str | Sequence[str]


def read_commented(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Comma-separated files with `#` comment lines and padded headers and values, as one table.

    Columns are found by their cleaned header name, and every file is read by its own header, so
    their columns may be in any order, in one folder as well. The table has the columns of the first
    file's header; a file that lacks one, or has another, is an error. A column missing in `schema`
    stays text, one missing in the files is an error. A value that is not of its type is an error
    as well, whatever the session's ANSI mode.
    """
    groups = [g for p in ([paths] if isinstance(paths, str) else paths) for g in _by_header(spark, p)]
    first, *others = [_read_commented(spark, g, schema) for g in groups]
    for other in others:
        first = first.unionByName(other)
    return first


def _by_header(spark: SparkSession, path: str) -> list[Paths]:
    """The files of a path by their headers; the path itself where they have one.

    The first line of each file that is no comment comes from one pass over the text, which combines
    before its shuffle; the driver gets the file names, as it does to list them.
    """
    read = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")).alias("place"),
    )
    lines = read.where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    names = F.regexp_replace("header", r"[ \t]", "")
    found = first.groupBy(names.alias("header")).agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    if len(found) <= 1:
        return [path]
    return [[unquote(f) for f in row["files"]] for row in sorted(found, key=lambda r: r["files"][0])]


def _read_commented(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    options = {"header": True, "comment": "#", "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    header = spark.read.csv(path, **options).schema
    # With a schema and without enforcing it the reader compares the header of every file.
    raw = clean_header(spark.read.csv(path, schema=header, enforceSchema=False, **options))
    types = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in types if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not in the files: {missing}")
    return raw.select(*[_typed(c, types[c]) if c in types else quoted(c) for c in raw.columns])


def _typed(column: str, kind: T.DataType) -> Column:
    """A text column as `kind`; text that is none is an error, empty text is null."""
    text = quoted(column)
    value = text.try_cast(kind)
    bad = value.isNull() & (F.trim(text) != "")
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{column}: "), text)).cast(kind)).otherwise(value).alias(column)


def read_csv(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType | None = None,
    null_value: str | None = None,
    bad_rows: str | None = None,
    infer: bool = False,
) -> DataFrame:
    """Comma-separated files with a header.

    A value that is not of its type is an error; with `bad_rows` the row is kept instead, with
    nulls for such values and its text in a column of that name. Without a schema types are only
    inferred, by reading the data once more, when `infer` says so.
    """
    options: dict[str, object] = {"header": True, "mode": "FAILFAST"}
    if null_value is not None:
        options["nullValue"] = null_value
    if schema is None:
        if not infer:
            raise ValueError("give a schema, or infer=True to have the data read twice")
        options["inferSchema"] = True
    elif bad_rows is None:
        options |= {"schema": schema, "enforceSchema": False}
    else:
        options |= {"schema": T.StructType([*schema.fields, T.StructField(bad_rows, T.StringType())])}
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad_rows}
    return spark.read.csv(list(paths) if not isinstance(paths, str) else paths, **options)


def read_json_records(spark: SparkSession, path: Paths, schema: T.StructType) -> DataFrame:
    """Files that each hold a JSON array of objects: one row per object.

    A file that is not JSON, or a value that is not of its type, is an error.
    """
    return spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST")


def read_pages(
    spark: SparkSession,
    path: Paths,
    properties: T.StructType,
    page_pattern: str = r".*page[=_-]?(\d+)",
) -> DataFrame:
    """Staged page files with their `type`, `features` and the `page` number in the file path.

    A file that is not JSON gives a row with null type.
    """
    pages = spark.read.json(
        path, schema=feature_collection(properties), multiLine=True, mode="PERMISSIVE"
    )
    number = F.regexp_extract(F.col("_metadata.file_path"), page_pattern, 1)
    return pages.select(
        "type", "features", F.when(number != "", number).cast("int").alias("page")
    )


def require_first_page(pages: DataFrame, first_page: int = 1) -> None:
    """Raise unless the first page is a FeatureCollection."""
    good = pages.where((F.col("page") == first_page) & (F.col("type") == "FeatureCollection"))
    if not good.select("page").take(1):
        raise ValueError("the first page is not a FeatureCollection")


def flatten_features(
    pages: DataFrame, swap_axes: bool = False, decoded: str | None = None
) -> DataFrame:
    """One row per feature of the good pages: its properties and its geometry as WKT.

    `decoded` adds what joins use without a detour through text: `x`, `y` for "point",
    `edges` for "polygon".
    """
    features = pages.where("type = 'FeatureCollection'").select(F.explode("features").alias("f"))
    return flat_features(features, swap_axes, decoded)


def flat_features(features: DataFrame, swap_axes: bool = False, decoded: str | None = None) -> DataFrame:
    """One row per feature struct `f`; `decoded` as for `flatten_features`."""
    shape = (F.col("f.geometry.type"), F.col("f.geometry.coordinates"), swap_axes)
    extra: list[Column] = []
    if decoded == "point":
        extra = [c.alias(n) for c, n in zip(geojson_point(*shape), ("x", "y"))]
    elif decoded == "polygon":
        extra = [geojson_edges(*shape).alias("edges")]
    elif decoded is not None:
        raise ValueError(f"decoded is {decoded!r}, not 'point' or 'polygon'")
    return features.select("f.properties.*", geojson_wkt(*shape).alias("geometry"), *extra)


def read_features(
    spark: SparkSession,
    path: Paths,
    properties: T.StructType,
    first_page: int | None = 1,
    swap_axes: bool = False,
    decoded: str | None = None,
    split: bool = False,
) -> DataFrame:
    """Paged feature collections as a flat table; pages that failed are skipped.

    A document is read by one task, or with `split` by as many as its size asks for.
    """
    if split:
        features, documents = read_split_collections(spark, path, properties)
        if first_page is not None:
            require_first_page(documents, first_page)
        return flat_features(features, swap_axes, decoded)
    pages = read_pages(spark, path, properties)
    if first_page is not None:
        require_first_page(pages, first_page)
    return flatten_features(pages, swap_axes, decoded)
