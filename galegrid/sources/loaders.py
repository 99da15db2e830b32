"""Loaders of the landed tables: a scan plus the clean-up each source needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import datum
from ..functions.columns import parse_yyyymmdd, quoted, require_columns
from ..functions.geometry import point_wkt, reproject_wkt
from ..schemas import INCIDENTS, WEATHER, area_properties
from .files import Paths, read_commented, read_csv, read_features, read_json_records

# The municipalities whose areas are kept by default.
MUNICIPALITIES = ["Zaanstad", "Diemen", "Ouder-Amstel", "Amstelveen", "Amsterdam"]


def clean_weather(raw: DataFrame, ordered: bool = True, deduplicate: bool = False) -> DataFrame:
    """Date and hour typed, newest first.

    `deduplicate` drops the repeated border hours of adjacent fetch windows; `ordered=False`
    spares the global sort where a later step does not need it.
    """
    if deduplicate:
        raw = raw.dropDuplicates([c for c in ("STN", "YYYYMMDD", "HH") if c in raw.columns])
    typed = raw.withColumns(
        {"YYYYMMDD": parse_yyyymmdd(F.col("YYYYMMDD")), "HH": F.col("HH").cast("tinyint")}
    )
    return typed.orderBy(F.desc("YYYYMMDD"), F.desc("HH")) if ordered else typed


def load_weather(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType = WEATHER,
    ordered: bool = True,
    deduplicate: bool = False,
) -> DataFrame:
    """Hourly weather from comment-headed text files."""
    return clean_weather(read_commented(spark, paths, schema), ordered, deduplicate)


def load_weather_json(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType = WEATHER,
    ordered: bool = True,
    deduplicate: bool = True,
) -> DataFrame:
    """Hourly weather from staged JSON responses, one file per fetch window."""
    return clean_weather(read_json_records(spark, paths, schema), ordered, deduplicate)


def load_incidents(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType | None = INCIDENTS,
    decoded: bool = False,
    bad_rows: str | None = None,
) -> DataFrame:
    """Incidents with a WKT point and `Incident_Date` in place of LON, LAT and Date.

    `decoded` also keeps the coordinates as `x`, `y`. An unreadable value is an error, or, with
    `bad_rows`, a null beside the row's text in a column of that name. Without a schema types are
    inferred.
    """
    raw = read_csv(spark, paths, schema, "NULL", bad_rows, infer=schema is None)
    require_columns(raw, "LON", "LAT", "Date")
    if decoded:
        raw = raw.withColumns({"x": F.col("LON"), "y": F.col("LAT")})
    return (
        raw.withColumn("geometry", point_wkt(F.col("LON"), F.col("LAT")))
        .withColumn("Incident_Date", F.to_date("Date"))
        .drop("LON", "LAT", "Date")
    )


def load_plain(
    spark: SparkSession, paths: Paths, schema: T.StructType | None = None, infer: bool = False
) -> DataFrame:
    """Deployments, stations and vehicles: read as they are."""
    return read_csv(spark, paths, schema, infer=infer)


def load_service_areas(
    spark: SparkSession, paths: Paths, schema: T.StructType | None = None, infer: bool = False, exact: bool = False
) -> DataFrame:
    """Service areas moved from the national grid to longitude and latitude.

    With `exact` by the datum transformation, else by the polynomial, which is faster.
    """
    raw = read_csv(spark, paths, schema, infer=infer)
    require_columns(raw, "geomtext")
    text = F.col("geomtext")
    moved = reproject_wkt(text, lambda v: datum.rd_to_wgs84(v[0], v[1])) if exact else reproject_wkt(text)
    return raw.withColumn("geometry", moved).drop("geomtext", "geom")


def load_features(
    spark: SparkSession,
    path: Paths,
    properties: T.StructType,
    first_page: int | None = 1,
    decoded: str | None = None,
    split: bool = False,
) -> DataFrame:
    """Trees, soil, ground water or buildings from staged pages, or with `split` from large documents."""
    return read_features(spark, path, properties, first_page, decoded=decoded, split=split)


def keep_named_areas(
    areas: DataFrame,
    name: str,
    municipalities: Sequence[str] | None = None,
    municipality_col: str = "gemeentenaam",
) -> DataFrame:
    """Areas of the given municipalities whose name is not the blank placeholder."""
    if municipalities is not None:
        areas = areas.where(quoted(municipality_col).isin(list(municipalities)))
    return areas.where(quoted(name) != " ")


def load_areas(
    spark: SparkSession,
    path: Paths,
    code: str,
    name: str,
    municipalities: Sequence[str] | None = tuple(MUNICIPALITIES),
    first_page: int | None = None,
    swap_axes: bool = False,
    decoded: str | None = None,
    split: bool = False,
) -> DataFrame:
    """One administrative level, such as (wijkcode, wijknaam) or (buurtcode, buurtnaam)."""
    areas = read_features(spark, path, area_properties(code, name), first_page, swap_axes, decoded, split)
    return keep_named_areas(areas, name, municipalities)
