"""Alignment, labels, profiles, grids and training rows on hand-made tables."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from galegrid.functions import geometry as geo
from galegrid.operators import align, grid, profile_counts

DAY = dt.date(2024, 1, 1)
WEATHER = [
    # date, HH, DD, FH, FF, FX
    (DAY, 1, 10, 5, 3, 7),
    (DAY, 5, 10, 5, 3, 7),
    (DAY, 6, 20, 5, 3, None),
    (DAY, 24, 30, 1, 1, 1),
]
INCIDENTS = [
    (1, dt.datetime(2024, 1, 1, 0, 30), None),
    (2, dt.datetime(2024, 1, 1, 5, 10), "Tree"),
    (3, dt.datetime(2024, 1, 1, 5, 50), "Tree"),
    (4, dt.datetime(2024, 1, 1, 5, 55), None),
    (5, dt.datetime(2024, 1, 1, 23, 59), "Roof top"),
    (6, dt.datetime(2024, 1, 1, 6, 0), "Tree"),
    (7, dt.datetime(2024, 2, 1, 6, 0), "Tree"),
]


@pytest.fixture(scope="module")
def weather(spark):
    return spark.createDataFrame(
        WEATHER, "YYYYMMDD date, HH int, DD int, FH int, FF int, FX int"
    ).withColumn("HH", F.col("HH").cast("tinyint"))


@pytest.fixture(scope="module")
def incidents(spark):
    raw = spark.createDataFrame(
        INCIDENTS, "Incident_ID int, Incident_Starttime timestamp_ntz, Damage_Type string"
    )
    return align.incident_features(raw.withColumn("Incident_Date", F.to_date("Incident_Starttime")))


def test_incident_features(incidents):
    assert incidents.columns == [
        "Incident_ID", "Incident_Date", "IncStrt_Hour", "Damage_Type", "Incident_Starttime",
    ]
    assert rows(incidents, "IncStrt_Hour") == [(0,), (23,), (5,), (5,), (5,), (6,), (6,)]


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_plain_alignment_joins_the_hour_number(weather, incidents, max_bytes):
    joined = align.align_hourly(weather, incidents, max_bytes=max_bytes)
    assert joined.columns == [*weather.columns, "Incident_ID", "Damage_Type", "Incident_Starttime"]
    assert rows(joined, "HH", "Incident_ID") == [(1, None), (24, None), (5, 2), (5, 3), (5, 4), (6, 6)]


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_alignment_in_universal_time(weather, incidents, max_bytes):
    utc = align.align_hourly(weather, incidents, zone="UTC", max_bytes=max_bytes)
    assert rows(utc, "HH", "Incident_ID") == [(1, 1), (24, 5), (5, None), (6, 2), (6, 3), (6, 4)]
    local = align.align_hourly(weather, incidents, zone="Europe/Amsterdam", max_bytes=max_bytes)
    assert rows(local, "HH", "Incident_ID") == [(1, None), (24, None), (5, 2), (5, 3), (5, 4), (6, 6)]


def test_clashing_columns_get_a_suffix(weather, incidents):
    joined = align.align_hourly(weather, incidents.withColumn("fx", F.lit(0)))
    assert "fx_right" in joined.columns


EXPECTED_LABELS = [
    (10, 5, 3, 7, "No-Incident", 0),  # hour 1 without incidents
    (10, 5, 3, 7, "No-Incident", 1),  # a real incident without a type keeps its count
    (10, 5, 3, 7, "Tree", 2),
    (20, 5, 3, None, "Tree", 1),
    (30, 1, 1, 1, "No-Incident", 0),
]


def test_label_counts_both_ways(weather, incidents):
    # Hour 1 and the untyped incident of hour 5 fall into one null group.
    merged = [e for e in EXPECTED_LABELS if e != (10, 5, 3, 7, "No-Incident", 0)]
    by_rows = align.label_counts(align.align_hourly(weather, incidents))
    direct = align.label_counts_direct(weather, incidents)
    assert rows(by_rows) == rows(direct)
    assert sorted(map(str, rows(by_rows))) == sorted(map(str, merged))


def test_null_ids_are_not_counted(weather, incidents):
    some = incidents.withColumn("Incident_ID", F.when(F.col("Incident_ID") != 2, F.col("Incident_ID")))
    by_rows = align.label_counts(align.align_hourly(weather, some))
    assert rows(by_rows) == rows(align.label_counts_direct(weather, some))


def test_direct_counts_join_no_incident_rows(weather, incidents):
    """Incidents are aggregated below the join."""
    text = plan(align.label_counts_direct(weather, incidents))
    join_depth = next(i for i, line in enumerate(text.splitlines()) if "Join" in line)
    assert any("HashAggregate" in line for line in text.splitlines()[join_depth:])


AREAS = [
    ("A1", "left", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"),
    ("B1", "right", "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))"),
    ("C1", "left", "POLYGON ((-4 -4, -2 -4, -2 -2, -4 -4))"),
    ("D1", "empty", "POLYGON ((50 50, 51 50, 51 51, 50 50))"),
]
TREES = [
    (1, 1.0, 1.0, "ash", "6 m"),
    (2, 4.0, 2.0, "oak", "9 m"),
    (3, 4.0, 4.0, "ash", None),
    (None, 5.0, 1.0, "oak", "9 m"),
    (5, -2.5, -3.0, None, "6 m"),
    (6, 99.0, 99.0, "elm", "6 m"),
]


@pytest.fixture(scope="module")
def areas(spark):
    return geo.with_edges(spark.createDataFrame(AREAS, ["code", "name", "geometry"]))


@pytest.fixture(scope="module")
def trees(spark):
    return spark.createDataFrame(TREES, "id int, x double, y double, kind string, height string")


def test_profile_by_name_merges_equal_names(areas, trees):
    wide = profile_counts.area_profile(areas, trees, "name", ["kind", "height"])
    assert wide.columns == [
        "name", "Trees_Totaal", "Trees_kind_ash", "Trees_kind_oak", "Trees_height_6-m", "Trees_height_9-m",
    ]
    assert rows(wide) == [("left", 4, 2, 1, 2, 1), ("right", 2, 1, 2, 0, 2)]


def test_profile_by_code_and_given_values(areas, trees):
    values = {"kind": ["ash", "elm"], "height": ["6 m"]}
    wide = profile_counts.area_profile(areas, trees, "code", values)
    assert rows(wide) == [("A1", 3, 2, 0, 1), ("B1", 2, 1, 0, 0), ("C1", 1, 0, 0, 1)]


def test_colliding_value_names_raise(areas, trees):
    twins = trees.withColumn("kind", F.when(F.col("id") == 1, "a b").otherwise("a-b"))
    with pytest.raises(ValueError):
        profile_counts.area_profile(areas, twins, "name", ["kind"])


def test_wide_counts_equal_the_pivot_chain(spark, trees):
    keyed = trees.withColumn("name", F.when(F.col("x") > 3, F.lit("far")).when(F.col("x") > 0, F.lit("near")))
    values = {"kind": ["ash", "elm", "oak"], "height": ["6 m", "9 m"]}
    base = profile_counts.count_per_key(keyed, "name")
    pivots = []
    for category, options in values.items():
        long = profile_counts.count_per_category(keyed, "name", category, "n")
        pivots.append(profile_counts.pivot_counts(long, "name", category, "n", options))
    chain = profile_counts.join_pivots(base, pivots, "name")
    one_pass = profile_counts.wide_counts(keyed, "name", values)
    assert chain.columns == one_pass.columns
    assert rows(chain) == rows(one_pass)
    assert (None, 1, 0, 0, 0, 0, 0) in rows(one_pass)  # a null name matches no pivot


@pytest.fixture(scope="module")
def profile(areas, trees):
    return profile_counts.area_profile(areas, trees, "name", {"kind": ["ash"]})


def test_condition_grid(areas, weather, profile):
    full = grid.condition_grid(areas, weather, profile, "code", "name")
    assert full.columns == ["code", "name", "DD", "FH", "FF", "FX", "Trees_Totaal", "Trees_kind_ash"]
    assert full.count() == 3 * 3  # the area without trees vanishes
    assert "NestedLoop" not in plan(full) and "Cartesian" not in plan(full)


@pytest.mark.parametrize("most", [1, 10**6])
def test_condition_grid_beyond_the_broadcast_bound(monkeypatch, areas, weather, profile, most):
    """Hot names are counted in the narrow factors: the grid itself is built once."""
    plans, hot = [], grid.hot_keys

    def looked_up(df, keys, **options):
        plans.append(plan(df))
        return hot(df, keys, most, **options)

    monkeypatch.setattr(grid, "hot_keys", looked_up)
    full = grid.condition_grid(areas, weather, profile, "code", "name", max_bytes=0)
    assert rows(full) == rows(grid.condition_grid(areas, weather, profile, "code", "name"))
    assert len(plans) == 1 and "_many" not in plans[0] and "FX" not in plans[0]


@pytest.mark.parametrize("rows_per_block", [1, 2, 2000])
def test_all_combinations(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(grid, "ROWS_PER_BLOCK", rows_per_block)
    few = spark.range(5).select(F.col("id").alias("a"), F.lit(None).cast("string").alias("n"))
    many = spark.range(23).withColumnRenamed("id", "b")
    assert rows(grid.all_combinations(few, many)) == rows(few.crossJoin(many))


def test_labelled_set_equals_the_stepwise_order(areas, weather, incidents, profile):
    counts = align.label_counts_direct(weather, incidents)
    slow = grid.label_grid(grid.condition_grid(areas, weather, profile, "code", "name"), counts)
    fast = grid.labelled_set(areas, weather, profile, counts, "code", "name")
    assert fast.columns == slow.columns
    assert rows(fast) == rows(slow)
    # Null conditions find no counts.
    assert {r.Total_Incidents for r in fast.where("FX is null").collect()} == {None}


def test_training_rows_counts(spark):
    df = spark.createDataFrame(
        [("a", None), ("b", 0), ("c", 1), ("d", 3)], "k string, Total_Incidents bigint"
    ).withColumn("code", F.lit(1))
    out = grid.training_rows(df, drop=["code"])
    assert rows(out) == [("b",), ("c",), ("d",), ("d",), ("d",)]
    assert rows(grid.repeat_rows(df, "Total_Incidents"), "k") == [("c",), ("d",), ("d",), ("d",)]


def test_one_huge_count_is_split_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(grid, "CHUNK", 10)
    df = spark.createDataFrame([("a", 0), ("b", 20), ("c", 1003)], "k string, Total_Incidents bigint")
    out = grid.training_rows(df)
    assert rows(out.groupBy("k").count()) == [("a", 1), ("b", 20), ("c", 1003)]
    placed = out.where("k = 'c'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert placed > 1


def test_training_row_total(areas, weather, incidents, profile):
    counts = align.label_counts_direct(weather, incidents)
    labelled = grid.labelled_set(areas, weather, profile, counts, "code", "name")
    expected = labelled.where("Total_Incidents is not null").agg(
        F.sum(F.greatest("Total_Incidents", F.lit(1)))
    ).first()[0]
    assert grid.training_rows(labelled).count() == expected


def test_concat_rows_wants_one_schema(spark):
    a = spark.range(2).withColumn("k", F.lit("x"))
    assert grid.concat_rows(a, a.select("k", "id")).count() == 4
    with pytest.raises(ValueError):
        grid.concat_rows(a, a.withColumn("id", F.col("id").cast("int")))


def test_left_join_renamed(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, area string")
    right = spark.createDataFrame([("a", 5), ("b", 6)], "zone string, id int")
    out = align.left_join_renamed(left, right, "area", "zone")
    assert out.columns == ["id", "area", "id_right"]
    assert rows(out) == [(1, "a", 5), (2, None, None)]


def test_long_counts_have_no_limit(spark):
    points = spark.range(30_000).select(
        (F.col("id") % 3).alias("area"), F.concat(F.lit("v"), F.col("id") % 12_000).alias("kind"), F.lit("x").alias("same"), "id"
    )
    long = profile_counts.long_counts(points, "area", ["kind", "same"])
    assert long.where("column = 'kind'").count() == 12_000
    assert {r.n_rows for r in long.where("column is null or column = 'same'").collect()} == {10_000}
