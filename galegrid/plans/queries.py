"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as col
from ..functions import datum
from ..functions import geometry as geo
from ..operators import align, grid, model, nearest, profile_counts, quality, ranks, spatial
from ..session import cut_lineage
from ..sources import fetch
from . import inputs
from .inputs import TREE_CATEGORIES, table

Query = Callable[[SparkSession, str], DataFrame]
WIND = list(align.CONDITIONS)


# -- alignment and labels ------------------------------------------------------


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents per wind condition and damage type."""
    incidents = align.incident_features(inputs.incidents(spark, sf))
    return align.label_counts_direct(inputs.weather(spark, sf), incidents)


def label_counts_aligned(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the row-level aligned table."""
    return align.label_counts(_aligned(spark, sf))


def _aligned(spark: SparkSession, sf: str, zone: str | None = None) -> DataFrame:
    incidents = align.incident_features(inputs.incidents(spark, sf))
    return align.align_hourly(inputs.weather(spark, sf), incidents, zone=zone)


_ALIGNED = ["YYYYMMDD", "HH", *WIND, "Incident_ID", "Damage_Type", "Incident_Starttime"]


def hourly_align(spark: SparkSession, sf: str) -> DataFrame:
    """Weather left join incidents on the hour number as it is."""
    return _aligned(spark, sf).select(*_ALIGNED)


def hourly_align_utc(spark: SparkSession, sf: str) -> DataFrame:
    """The same with incident times moved to UT and its 1..24 slots."""
    return _aligned(spark, sf, zone="Europe/Amsterdam").select(*_ALIGNED)


def incident_features(spark: SparkSession, sf: str) -> DataFrame:
    """Start hour added, id, date and hour first."""
    return align.incident_features(inputs.incidents(spark, sf))


def located_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Labels per area: incidents are placed in areas before they are counted."""
    incidents = align.incident_features(inputs.incidents(spark, sf))
    placed = spatial.points_in_areas(inputs.areas(spark, sf), incidents, ["code"])
    return align.label_counts_direct(inputs.weather(spark, sf), placed, by=["code"]).where(
        "code is not null"
    )


def incidents_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents per date, hour, service area, damage type and all weather measures, sorted."""
    incidents = align.incident_features(inputs.incidents(spark, sf))
    counted = align.hourly_counts(inputs.weather(spark, sf), incidents, inputs.WEATHER_MEASURES)
    return counted.orderBy("YYYYMMDD", "HH")


def incidents_by_condition(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents per ten weather measures and service area."""
    by = [*WIND, "T", "WW", "R", "S", "O", "Service_Area", "Damage_Type"]
    return align.count_incidents(_aligned(spark, sf), by, out="Incident_Counts")


def incidents_by_area_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents per area, date, hour and damage type."""
    incidents = align.incident_features(inputs.incidents(spark, sf))
    placed = spatial.points_in_areas(inputs.areas(spark, sf), incidents, ["code"])
    return align.count_incidents(
        placed, ["code", "Incident_Date", "IncStrt_Hour", "Damage_Type"], out="Totaal"
    )


def incidents_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents per damage type."""
    return align.count_incidents(inputs.incidents(spark, sf), ["Damage_Type"], out="Total")


# -- scalars, projections, filters ---------------------------------------------


def tree_age(spark: SparkSession, sf: str) -> DataFrame:
    """Age in years as of 2024 from a planting year."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("jaarVanAanleg")
    )
    return align.tree_features(orders, as_of_year=2024)


def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Integer dates and hour stamps to dates and timestamps and back."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("ymd"),
        (F.col("o_orderkey") % 24).cast("int").alias("hour"),
    )
    stamp = F.concat(F.col("ymd").cast("string"), F.lpad(F.col("hour").cast("string"), 2, "0"))
    parsed = orders.withColumns(
        {
            "day": col.parse_yyyymmdd(F.col("ymd")),
            "hh": F.col("hour").cast("tinyint"),
            "stamp": col.parse_hour_stamp(stamp).cast("timestamp_ntz"),
        }
    )
    return parsed.select(
        "o_orderkey",
        "ymd",
        "day",
        "hh",
        "stamp",
        F.minute("stamp").alias("minute"),
        col.format_hour_stamp(F.col("stamp")).alias("stamp_text"),
        F.date_format("day", "yyyy-MM-dd").alias("day_text"),
    )


def named_and_listed(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of listed nations whose segment is not the blank placeholder."""
    customers = table(spark, sf, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", " ")
        .when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))
        .alias("segment"),
    )
    listed = customers.where(F.col("c_nationkey").isin([1, 4, 9, 16, 23]))
    return listed.where(F.col("segment") != " ")


def project_and_rename(spark: SparkSession, sf: str) -> DataFrame:
    """Select, drop, replace, select-except and hyphenated names."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_type")
    replaced = parts.drop("p_brand").withColumn("p_name", col.hyphenate(F.col("p_name")))
    kept = col.select_except(replaced, {"p_size"})
    return kept.withColumn(
        col.feature_name("is", "p_type", "NOT SMALL"), (F.col("p_type") != "SMALL").cast("int")
    )


def select_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Wind and temperature of two of three stations."""
    stations = inputs.weather(spark, sf).withColumn("STN", (F.col("HH") % 3 * 20 + 240).cast("int"))
    return col.select_variables(stations, "WIND:T:WEER", stations=[240, 260])


def preview_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The first five hours of the weather."""
    wind = inputs.weather(spark, sf).select("YYYYMMDD", "HH", *WIND)
    return quality.preview(wind, 5, ["YYYYMMDD", "HH"])


def rows_per_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per group, all groups in one pass."""
    return quality.group_sizes(table(spark, sf, "customer"), "c_mktsegment")


def left_join_renamed_key(spark: SparkSession, sf: str) -> DataFrame:
    """Left join on differently named keys; not every key finds a partner."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    # Keys moved by half the customers: the upper half finds orders of others or none.
    shift = table(spark, sf, "customer").agg(F.floor(F.max("c_custkey") / 2).alias("shift"))
    shipped = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("customer"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .join(F.broadcast(shift))
        .select((F.col("customer") + F.col("shift")).alias("customer"), "n_orders")
    )
    return align.left_join_renamed(customers, shipped, "c_custkey", "customer")


def union_all(spark: SparkSession, sf: str) -> DataFrame:
    """Concatenation of tables with one schema."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    return grid.concat_rows(orders, customers)


def sort_descending(spark: SparkSession, sf: str) -> DataFrame:
    """Weather newest first, with its rank in that order left to the reader."""
    wind = inputs.weather(spark, sf).select("YYYYMMDD", "HH", *WIND)
    return wind.orderBy(F.desc("YYYYMMDD"), F.desc("HH"))


def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 dearest orders, ties by key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return quality.top_n(orders, "o_totalprice", 20, ["o_orderkey"])


def conditions(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct wind conditions."""
    return grid.distinct_conditions(inputs.weather(spark, sf))


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """0/1 columns per service area and damage type."""
    incidents = inputs.incidents(spark, sf).select("Incident_ID", "Service_Area", "Damage_Type")
    values = {
        "Service_Area": [f"SA {k}" for k in range(6)],
        "Damage_Type": ["Building", "Road sign", "Tree", None],
    }
    return col.one_hot(incidents, values)


def drop_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per damage type and area without null groups, then nulls filled."""
    return profile_counts.count_per_category(
        inputs.incidents(spark, sf), "Service_Area", "Damage_Type", "n"
    )


# -- geometry and spatial joins ------------------------------------------------


def spatial_join(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in rectangles; a point on a shared border lies in both."""
    points = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"),
        F.round(F.col("l_discount") * 100).alias("y"),
    )
    return spatial.points_in_areas(inputs.areas(spark, sf), points, ["code", "name"])


def spatial_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in multipolygons with holes, counted per zone."""
    zones = geo.with_edges(inputs.zones(spark, sf))
    hits = spatial.points_in_areas(zones, inputs.zone_points(spark, sf), ["zone", "nation"])
    return hits.groupBy("zone", "nation").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sum("l_linenumber").alias("sum_line"),
        F.sum(F.col("y").cast("bigint")).alias("sum_y"),
    )


def spatial_polygons_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The same without broadcasting the zones: the cell join with crowded cells split."""
    zones = geo.with_edges(inputs.zones(spark, sf))
    hits = spatial.points_in_areas(
        zones, inputs.zone_points(spark, sf), ["zone", "nation"], max_bytes=0
    )
    return hits.groupBy("zone", "nation").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sum("l_linenumber").alias("sum_line"),
        F.sum(F.col("y").cast("bigint")).alias("sum_y"),
    )


def spatial_mixed_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per area where the nations lie among squares a hundredth of their size.

    Line items at one location are counted before the join, which then meets each location once.
    """
    squares = inputs.small_squares(spark, sf)
    areas = inputs.areas(spark, sf).select("code", "edges").unionByName(squares)
    points = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("x"), F.round(F.col("l_discount") * 100).alias("y"), "l_linenumber"
    )
    locations = cut_lineage(
        points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("line"))
    )
    joined = spatial.points_in_areas(areas, locations, ["code"])
    return joined.groupBy("code").agg(
        F.sum("n").alias("n_points"), F.sum("line").cast("bigint").alias("sum_line")
    )


def nearest_incident(spark: SparkSession, sf: str) -> DataFrame:
    """For every other event its nearest error event, with the distance."""
    points = inputs.scattered(spark, sf)
    left = points.where("event_type <> 'error'").select("event_id", "x", "y")
    right = points.where("event_type = 'error'").select(
        F.col("event_id").alias("Incident_ID"), "x", "y"
    )
    return nearest.nearest_join(left, right, exclusive=True).select(
        "event_id", "Incident_ID", "Distance"
    )


def nearest_wkt(spark: SparkSession, sf: str) -> DataFrame:
    """The same from tables with WKT points: every event to its nearest others."""
    points = cut_lineage(
        inputs.scattered(spark, sf).select(
            "event_id", "user_id", geo.point_wkt(F.col("x") / 8, F.col("y") / 8).alias("geometry")
        )
    )
    return nearest.nearest_features(points, points.withColumnRenamed("event_id", "other_id"))


def nearest_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest lattice points with ties and equal locations; equal points are ignored."""
    lines = table(spark, sf, "lineitem")
    left = lines.select(
        F.col("l_quantity").alias("x"), F.round(F.col("l_discount") * 100).alias("y")
    ).distinct()
    right = (
        table(spark, sf, "events")
        .groupBy((F.col("user_id") % 50).cast("double").alias("x"), (F.col("user_id") % 11).cast("double").alias("y"))
        .agg(F.min("event_id").alias("Incident_ID"), F.count(F.lit(1)).alias("n"))
    )
    return nearest.nearest_join(left, right, exclusive=True)


def wkt_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Points to WKT and back."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        geo.point_wkt(F.col("l_extendedprice") / 1000, -F.col("l_tax")).alias("geometry"),
    )
    return geo.with_points(lines)


def reproject(spark: SparkSession, sf: str) -> DataFrame:
    """Points of the national grid to longitude and latitude."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * 0.5 + 120000.0).alias("rd_x"),
        (F.col("l_quantity") * 400.0 + 470000.0).alias("rd_y"),
    )
    lon, lat = geo.rd_to_wgs84(F.col("rd_x"), F.col("rd_y"))
    return lines.select(
        "l_orderkey", "l_linenumber", "rd_x", "rd_y",
        F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"),
    )


def reproject_datum(spark: SparkSession, sf: str) -> DataFrame:
    """The same points by the datum transformation."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * 0.5 + 120000.0).alias("rd_x"),
        (F.col("l_quantity") * 400.0 + 470000.0).alias("rd_y"),
    )
    at = datum.rd_to_wgs84(F.col("rd_x"), F.col("rd_y"))
    moved = lines.withColumn("at", at)
    return moved.select(
        "l_orderkey", "l_linenumber", F.round(F.col("at")[0], 9).alias("lon"), F.round(F.col("at")[1], 9).alias("lat")
    )


# -- area profiles, grid, labels, training rows --------------------------------


def _profile(spark: SparkSession, sf: str, key: str = "name") -> DataFrame:
    return profile_counts.area_profile(
        inputs.areas(spark, sf), inputs.trees(spark, sf), key, TREE_CATEGORIES
    )


def area_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Trees per area name, in total and per category value."""
    return _profile(spark, sf)


def area_profile_by_code(spark: SparkSession, sf: str) -> DataFrame:
    """The same per area code, with the category values looked up."""
    return profile_counts.area_profile(
        inputs.areas(spark, sf), inputs.trees(spark, sf), "code", list(TREE_CATEGORIES)
    )


def pivot_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Totals with pivots left-joined one by one, missing counts 0."""
    trees = inputs.trees(spark, sf).select("o_orderpriority", "id", "p_type", "l_returnflag")
    base = profile_counts.count_per_key(trees, "o_orderpriority")
    pivots = []
    for category in ("p_type", "l_returnflag"):
        long = profile_counts.count_per_category(trees, "o_orderpriority", category, "n")
        pivots.append(
            profile_counts.pivot_counts(long, "o_orderpriority", category, "n", TREE_CATEGORIES[category])
        )
    return profile_counts.join_pivots(base, pivots, "o_orderpriority")


def condition_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Areas x distinct wind conditions with the tree profile of the area name."""
    return grid.condition_grid(
        inputs.areas(spark, sf), inputs.weather(spark, sf), _profile(spark, sf), "code", "name"
    )


def label_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The grid with incident counts per damage type."""
    return grid.label_grid(condition_grid(spark, sf), label_counts(spark, sf))


def located_label_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The grid with the counts of the incidents inside each area; no incident counts 0."""
    areas = inputs.areas(spark, sf).withColumn("area", F.col("code"))
    profile = _profile(spark, sf, "code").withColumnRenamed("code", "area")
    full = grid.condition_grid(areas, inputs.weather(spark, sf), profile, "code", "area")
    return grid.label_grid(
        full.drop("area"), located_label_counts(spark, sf), by=["code"], zero_label=align.NO_INCIDENT
    )


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return grid.labelled_set(
        inputs.areas(spark, sf),
        inputs.weather(spark, sf),
        _profile(spark, sf),
        label_counts(spark, sf),
        "code",
        "name",
    )


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled grid expanded to one row per incident, plus one per empty condition."""
    return grid.training_set(
        inputs.areas(spark, sf),
        inputs.weather(spark, sf),
        _profile(spark, sf),
        label_counts(spark, sf),
        "code",
        "name",
        drop=["code"],
    )


def training_rows_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows out of the labelled grid."""
    return grid.training_rows(_labelled(spark, sf), drop=["code"])


def training_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as two parts: repeated positive counts, then zero counts once."""
    counts = label_counts(spark, sf)
    repeated = grid.repeat_rows(counts, "Total_Incidents")
    zeros = counts.where("Total_Incidents = 0").drop("Total_Incidents")
    return grid.concat_rows(repeated, zeros)


# -- profiling and models ------------------------------------------------------


def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Shape, nulls, and count, mean, std, min, quartiles, max of the line items."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    )
    return quality.profile(lines).withColumn("value", F.round("value", 4))


def date_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """First and last date of the weather."""
    return quality.coverage(inputs.weather(spark, sf), "YYYYMMDD")


def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Nulls per column of the aligned table."""
    return quality.null_counts(_aligned(spark, sf).select(*_ALIGNED))


def error_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """MSE, RMSE and MAE of a linear guess of the price."""
    scored = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("actual"), (F.col("l_quantity") * 1.0).alias("guess")
    )
    metrics = model.error_metrics(scored, F.col("actual"), F.col("guess"))
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their repeatable train or test mark."""
    return model.hash_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


def _model_table(spark: SparkSession, sf: str) -> DataFrame:
    incidents = align.incident_features(inputs.incidents(spark, sf))
    weather = inputs.weather(spark, sf).na.fill(0, ["FX"])
    counted = align.hourly_counts(weather, incidents, inputs.WEATHER_MEASURES)
    values = {
        "Service_Area": [f"SA {k}" for k in range(6)],
        "Damage_Type": ["Building", "Road sign", "Tree"],
    }
    return col.one_hot(counted.drop("YYYYMMDD", "HH"), values)


def count_model(spark: SparkSession, sf: str) -> DataFrame:
    """Poisson count regression: test errors and the 20 strongest features."""
    return _model_report(model.fit_count_model(_model_table(spark, sf)))


def boosted_model(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees on the same table."""
    return _model_report(model.fit_count_model(_model_table(spark, sf), kind="boosted"))


#: Small trees, as the SQL twin repeats every round.
SMALL_TREES = {"rounds": 3, "max_depth": 2, "max_bins": 16}
INDICATORS = {"Service_Area": [f"SA {k}" for k in range(6)], "Damage_Type": ["Building", "Road sign", "Tree"]}
HOURLY_KEYS = ["YYYYMMDD", "HH", "Service_Area", "Damage_Type"]


def _small_trees(spark: SparkSession, sf: str) -> model.CountModel:
    """Boosted trees on the hourly counts: 22 measures, some of them null, and the indicators."""
    incidents = align.incident_features(inputs.incidents(spark, sf))
    counted = align.hourly_counts(inputs.weather(spark, sf), incidents, inputs.WEATHER_MEASURES)
    named = counted.select("*", *[F.col(c).alias(f"{c}_name") for c in INDICATORS])
    ready = col.one_hot(named, INDICATORS)
    features = [*inputs.WEATHER_MEASURES, *[f"{c}_{v}" for c, vs in INDICATORS.items() for v in vs]]
    keys = ["YYYYMMDD", "HH", *[f"{c}_name" for c in INDICATORS]]
    return model.fit_count_model(ready, kind="trees", split_by=keys, features=features, exact=True, **SMALL_TREES)


def poisson_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees with the Poisson objective: the expected counts of the test rows."""
    predicted = _small_trees(spark, sf).predictions
    return predicted.select(
        "YYYYMMDD", "HH", *[F.col(f"{c}_name").alias(c) for c in INDICATORS], "Incident_Count",
        F.round("prediction", 6).alias("prediction"),
    )


def model_importances(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 features of those trees whose splits gain most on average."""
    ranked = _small_trees(spark, sf).importances
    return ranked.select("Feature", F.round("Importance", 9).alias("Importance"))


def poisson_trees_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The test errors of those trees."""
    errors = _small_trees(spark, sf).metrics
    return errors.select(*[F.round(c, 6).alias(c) for c in errors.columns])


def exact_split(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their train or test mark, exactly a fifth of them test."""
    return ranks.exact_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


def _area_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents per date, hour and service area, and a 0/1 column for each area."""
    incidents = align.incident_features(inputs.incidents(spark, sf))
    by = ["Incident_Date", "IncStrt_Hour", "Service_Area"]
    counted = incidents.groupBy(*by).agg(F.count("Incident_ID").alias("Incident_Count"))
    areas = {"Service_Area": [f"SA {k}" for k in range(6)]}
    return col.one_hot(counted.withColumn("area", F.col("Service_Area")), areas)


def saturated_model(spark: SparkSession, sf: str) -> DataFrame:
    """A Poisson model with one indicator for each area, whose fit is the mean of the area.

    Predictions for the test rows, without regularisation.
    """
    counted = _area_counts(spark, sf)
    fitted = model.fit_count_model(
        counted,
        split_by=["Incident_Date", "IncStrt_Hour", "area"],
        features=[c for c in counted.columns if c.startswith("Service_Area_")],
        regParam=0.0, fitIntercept=False, maxIter=100, tol=1e-12,
    )
    return fitted.predictions.select(
        "Incident_Date", "IncStrt_Hour", "area", "Incident_Count", F.round("prediction", 5).alias("prediction")
    )


def saturated_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The errors of those predictions."""
    scored = saturated_model(spark, sf)
    errors = model.error_metrics(scored, F.col("Incident_Count"), F.col("prediction"))
    return errors.select(*[F.round(c, 4).alias(c) for c in errors.columns])


def area_profile_long(spark: SparkSession, sf: str) -> DataFrame:
    """Trees per area name in the long form: a row for each value of each category column."""
    joined = spatial.points_in_areas(inputs.areas(spark, sf), inputs.trees(spark, sf), ["name"])
    return profile_counts.long_counts(joined, "name", list(TREE_CATEGORIES))


def _model_report(fitted: model.CountModel) -> DataFrame:
    errors = fitted.metrics.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("name"), F.col(c).alias("value"))
                    for c in fitted.metrics.columns
                ]
            )
        ).alias("p")
    ).select("p.*")
    ranked = fitted.importances.select(
        F.lit("importance").alias("kind"), F.col("Feature").alias("name"), F.col("Importance").alias("value")
    )
    return errors.unionByName(ranked)


# -- fetch plans ---------------------------------------------------------------


def fetch_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The order span of every customer cut into windows of 180 days."""
    spans = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    )
    return fetch.fetch_windows(spans, days=180)


def page_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of four orders per customer, in chunks of three pages."""
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return fetch.page_plan(totals, F.ceil(F.col("n") / 4), chunk=3)


def missing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of ten orders that failed or hold no order at all."""
    orders = table(spark, sf, "orders").select(
        (F.floor(F.col("o_orderkey") / 10) + 1).cast("int").alias("page"), "o_totalprice"
    )
    totals = orders.agg(F.max("page").alias("last"))
    landed = orders.groupBy("page").agg(F.max("o_totalprice").alias("top")).select(
        "page", F.when(F.col("top") < 490000, "FeatureCollection").otherwise("Error").alias("type")
    )
    return fetch.missing_pages(fetch.page_plan(totals, F.col("last")).drop("last"), landed)
