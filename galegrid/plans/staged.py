"""Queries that write tables as files of the source formats and read them back.

The files go below the shared folder of the session. Each query returns what the reader
makes of them, so it can be compared with the table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import with_points
from ..operators import align, quality
from ..schemas import WEATHER_COLUMNS
from ..session import staging_path
from ..sources import catalog, loaders
from . import inputs
from .inputs import table

PAGE_SIZE = 500


def _weather_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The weather with its date as an integer, as the provider writes it."""
    return inputs.weather(spark, sf).withColumn(
        "YYYYMMDD", F.date_format("YYYYMMDD", "yyyyMMdd").cast("int")
    )


def weather_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Weather through padded text files with comment lines, loaded newest first."""
    path = staging_path(spark, "weather-text")
    padded = _weather_numbers(spark, sf).select(
        *[
            F.lpad(F.coalesce(F.col(c).cast("string"), F.lit("")), 9, " ").alias(f"  {c}\t")
            for c in WEATHER_COLUMNS
        ]
    )
    first, *others = padded.columns
    # One comment line per day, all but its first field empty.
    notes = (
        inputs.weather(spark, sf)
        .select("YYYYMMDD")
        .distinct()
        .select(
            F.concat(F.lit("# "), F.col("YYYYMMDD").cast("string")).alias(first),
            *[F.lit("").alias(c) for c in others],
        )
    )
    # The writer would quote a field that starts with its comment sign, so it gets another.
    padded.unionByName(notes).write.option("comment", "~").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return loaders.load_weather(spark, path)


def weather_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Weather through two folders of text files whose columns are in opposite order."""
    paths = []
    for k, columns in enumerate((WEATHER_COLUMNS, tuple(reversed(WEATHER_COLUMNS)))):
        paths.append(staging_path(spark, f"weather-mixed-{k}"))
        hours = _weather_numbers(spark, sf).where(F.col("HH") % 2 == k)
        hours.select(*columns).write.csv(paths[-1], header=True)
    return loaders.load_weather(spark, paths)


def weather_mixed_folder(spark: SparkSession, sf: str) -> DataFrame:
    """Weather through one folder whose files have their columns in two orders."""
    path = staging_path(spark, "weather-folder")
    for k, columns in enumerate((WEATHER_COLUMNS, tuple(reversed(WEATHER_COLUMNS)))):
        hours = _weather_numbers(spark, sf).where(F.col("HH") % 2 == k)
        hours.select(*columns).write.mode("append").csv(path, header=True)
    return loaders.load_weather(spark, path)


def bucketed_align(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly alignment of tables that are stored in buckets of date and hour."""
    location = staging_path(spark, "bucketed")
    schema = "galegrid_check_" + location[-8:]
    keys = ["YYYYMMDD", "HH"]
    incidents = align.incident_features(inputs.incidents(spark, sf))
    slots = incidents.select(
        "Incident_ID", "Damage_Type", "Incident_Starttime",
        F.col("Incident_Date").alias("YYYYMMDD"), F.col("IncStrt_Hour").cast("int").alias("HH"),
    )
    hours = inputs.weather(spark, sf).withColumn("HH", F.col("HH").cast("int"))
    catalog.save_table(hours, schema, "weather", location, buckets=8, by=keys)
    catalog.save_table(slots, schema, "incidents", buckets=8, by=keys)
    stored = catalog.read_table(spark, schema, "incidents").hint("merge")
    joined = catalog.read_table(spark, schema, "weather").join(stored, keys, "left")
    return joined.select(*keys, *align.CONDITIONS, "Incident_ID", "Damage_Type", "Incident_Starttime")


def weather_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Weather through one JSON array per day whose last hour is repeated in the next file."""
    path = staging_path(spark, "weather-json")
    hours = _weather_numbers(spark, sf)
    record = F.struct(*[F.col(c) for c in WEATHER_COLUMNS])
    shared = hours.where("HH = 24").withColumn("file", F.col("YYYYMMDD") + 1)
    # A file holds the hours of one day: at most 25 records.
    arrays = (
        hours.withColumn("file", F.col("YYYYMMDD"))
        .unionByName(shared)
        .groupBy("file")
        .agg(F.to_json(F.collect_list(record)).alias("value"))
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return loaders.load_weather_json(spark, path)


def incident_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents through CSV files with the literal NULL."""
    path = staging_path(spark, "incidents")
    raw = inputs.incidents(spark, sf).select(
        "Incident_ID",
        F.to_timestamp("Incident_Date").alias("Date"),
        (F.col("x") / 10).alias("LON"),
        (F.col("y") / 10).alias("LAT"),
        F.col("Incident_Starttime").cast("timestamp"),
        "Service_Area",
        "Damage_Type",
    )
    raw.write.options(
        header=True, nullValue="NULL", timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    return loaders.load_incidents(spark, path, raw.schema).withColumn(
        "Incident_Starttime", F.col("Incident_Starttime").cast("timestamp_ntz")
    )


def plain_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through plain CSV files whose types are inferred on request."""
    path = staging_path(spark, "plain")
    table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").write.option(
        "header", True
    ).csv(path)
    return loaders.load_plain(spark, path, infer=True).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def service_area_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customer points in the national grid as WKT in CSV files, reprojected on load."""
    path = staging_path(spark, "service-areas")
    points = table(spark, sf, "customer").select(
        "c_custkey",
        F.format_string(
            "POINT (%d %d)", F.col("c_custkey") % 50000 + 100000, F.col("c_custkey") * 7 % 90000 + 420000
        ).alias("geomtext"),
        F.lit("unused").alias("geom"),
    )
    points.write.option("header", True).csv(path)
    loaded = loaders.load_service_areas(spark, path, points.schema)
    return with_points(loaded, x="lon", y="lat").select(
        "c_custkey", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat")
    )


_POINT_PROPERTIES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("segment", T.StringType()),
        T.StructField("balance", T.DoubleType()),
    ]
)


def _collections(features: DataFrame) -> DataFrame:
    """`page`, `geometry` and `properties` to a feature collection for each page, as `value`.

    A page holds PAGE_SIZE features at most, as its number is the key divided by that.
    """
    collections = features.groupBy("page").agg(
        F.collect_list(F.struct(F.lit("Feature").alias("type"), "geometry", "properties")).alias("features")
    )
    body = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"))
    return collections.select("page", body.alias("value"))


def _write_pages(bodies: DataFrame, path: str) -> None:
    """One file for each `page` with its `value`.

    Files cost time, not bytes: pages are dealt to all cores, however small they are, and each task
    moves its own files to their place, not the driver all of them.
    """
    cores = bodies.sparkSession.sparkContext.defaultParallelism
    bodies.repartition(cores, "page").write.partitionBy("page").option("maxRecordsPerFile", 1).option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2"
    ).text(path)


def feature_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as points through paged GeoJSON."""
    path = staging_path(spark, "pages")
    _write_pages(_collections(_customer_features(spark, sf, PAGE_SIZE)), path)
    return loaders.load_features(spark, path, _POINT_PROPERTIES)


def feature_document(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as points through one GeoJSON document that as many tasks read as its size asks for."""
    path = staging_path(spark, "document")
    features = _customer_features(spark, sf, PAGE_SIZE).select(
        F.col("properties.id").alias("n"), F.to_json(F.struct(F.lit("Feature").alias("type"), "geometry", "properties")).alias("value")
    )
    # the document is one file: its features follow each other, a comma before all but the first
    first = features.agg(F.min("n")).first()[0]
    lines = features.withColumn("value", F.concat(F.when(F.col("n") == first, "").otherwise(","), "value"))
    ends = spark.createDataFrame([(None, '{"type":"FeatureCollection","features":['), (2**62, "]}")], "n bigint, value string")
    lines.unionByName(ends).repartition(1).sortWithinPartitions(F.asc_nulls_first("n")).select("value").write.text(path)
    return loaders.load_features(spark, path, _POINT_PROPERTIES, first_page=None, split=True)


def feature_pages_with_bad_ones(spark: SparkSession, sf: str) -> DataFrame:
    """The same where every fourth page is an error page, not JSON, or did not land."""
    path = staging_path(spark, "bad-pages")
    features = _customer_features(spark, sf, inputs.BAD_PAGE_SIZE)
    good = _collections(features.where("page % 4 <> 3"))
    bad = features.where("page % 4 = 3 and page % 12 <> 11").select("page").distinct()
    body = F.when(F.col("page") % 12 == 3, '{"type": "Error", "features": null}').otherwise("<html>error 500</html>")
    _write_pages(good.unionByName(bad.select("page", body.alias("value"))), path)
    return loaders.load_features(spark, path, _POINT_PROPERTIES)


def _customer_features(spark: SparkSession, sf: str, page_size: int) -> DataFrame:
    return table(spark, sf, "customer").select(
        (F.floor(F.col("c_custkey") / page_size) + 1).cast("int").alias("page"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(F.col("c_acctbal") / 100, (F.col("c_custkey") / 8).cast("double")).alias("coordinates"),
        ).alias("geometry"),
        F.struct(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"),
            F.col("c_acctbal").alias("balance"),
        ).alias("properties"),
    )


def area_features(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier squares through paged GeoJSON; blank names and other municipalities dropped."""
    path = staging_path(spark, "areas")
    west, south = F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double")
    corners = [(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.array(west + dx, south + dy) for dx, dy in corners])
    supplier = table(spark, sf, "supplier")
    features = supplier.select(
        (F.floor(F.col("s_suppkey") / PAGE_SIZE) + 1).cast("int").alias("page"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(
            F.concat(F.lit("WK"), F.col("s_suppkey").cast("string")).alias("wijkcode"),
            F.when(F.col("s_acctbal") < 1000, F.lit(" ")).otherwise(F.col("s_name")).alias("wijknaam"),
            F.concat(F.lit("M"), F.col("s_nationkey").cast("string")).alias("gemeentenaam"),
        ).alias("properties"),
    )
    _write_pages(_collections(features), path)
    return loaders.load_areas(
        spark, path, "wijkcode", "wijknaam", ["M1", "M4", "M9", "M16", "M20", "M23"], first_page=1
    )


def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables saved, listed, one dropped; nulls per listed column of the table read back."""
    location = staging_path(spark, "tables")
    schema = "galegrid_check_" + location[-8:]
    incidents = inputs.incidents(spark, sf).select("Incident_ID", "Incident_Date", "Damage_Type")
    catalog.save_table(incidents.select("Incident_ID"), schema, "dropped", location)
    catalog.save_table(incidents, schema, "incidents")
    catalog.drop_table(spark, schema, "dropped")
    listed = catalog.list_tables(spark).where(F.col("schema") == schema)
    columns = listed.select(
        F.col("name").alias("table_name"),
        F.explode(F.arrays_zip("column_names", "column_types")).alias("c"),
    ).select("table_name", F.col("c.column_names").alias("column"), F.col("c.column_types").alias("type"))
    return columns.join(quality.null_counts(catalog.read_table(spark, schema, "incidents")), "column")


def written_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the incidents that their write observes, after it replaced an older table."""
    location = staging_path(spark, "profiled")
    schema = "galegrid_check_" + location[-8:]
    incidents = inputs.incidents(spark, sf).select("Incident_ID", "Incident_Date", "Damage_Type", "Incident_Priority", "x", "y")
    catalog.save_table(incidents, schema, "incidents", location)
    kept = catalog.read_table(spark, schema, "incidents").where("Damage_Type IS NOT NULL OR x > 9")
    told = catalog.save_table(kept, schema, "incidents", profile=True, dates="Incident_Date")
    return told.select("column", "metric", F.round("value", 6).alias("value"))
