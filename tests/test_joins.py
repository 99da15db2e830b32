"""Skew-safe joins, the spatial join and the nearest join against brute force."""

from __future__ import annotations

import math
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from galegrid.functions import geometry as geo
from galegrid.operators import nearest, skew, spatial

AREAS = [
    ("hole", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"),
    ("next", "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))"),
    ("parts", "MULTIPOLYGON (((-9 -9, -5 -9, -5 -5, -9 -9)), ((5 5, 9 5, 7 9, 5 5)))"),
    ("huge", "POLYGON ((-1000 -1000, 1000 -1000, 900 1000, -1000 1000, -1000 -1000))"),
    ("tiny", "POLYGON ((0.1 0.1, 0.2 0.1, 0.2 0.2, 0.1 0.1))"),
    ("none", "POLYGON EMPTY"),
]


@pytest.fixture(scope="module")
def areas(spark):
    return geo.with_edges(spark.createDataFrame(AREAS, ["area", "geometry"]))


@pytest.fixture(scope="module")
def points(spark):
    pick = random.Random(7)
    spots = [(a / 2, b / 2) for a in range(-22, 22) for b in range(-22, 22)]
    spots += [(pick.uniform(-1100, 1100), pick.uniform(-1100, 1100)) for _ in range(300)]
    # A third of all points in one place, on the corner two areas share.
    spots += [(4.0, 4.0)] * 1100 + [(0.15, 0.12), (None, 1.0), (float("nan"), 1.0)]
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "id int, x double, y double")


@pytest.mark.parametrize(
    "size, max_bytes, many",
    [(s, b, spatial.MANY_EDGES) for s in (None, 0.3, 50.0) for b in (skew.BROADCAST_BYTES, 0)] + [(None, 0, 0), (0.3, skew.BROADCAST_BYTES, 0)],
)
def test_points_in_areas(monkeypatch, areas, points, size, max_bytes, many):
    """Also with every area rasterised by its edges."""
    monkeypatch.setattr(spatial, "MANY_EDGES", many)
    usable = points.where("x is not null and not isnan(x)")
    brute = areas.crossJoin(usable).where(geo.covers("edges", "x", "y"))
    got = spatial.points_in_areas(areas, points, ["area"], cell_size=size, max_bytes=max_bytes)
    assert rows(got, "area", "id") == rows(brute, "area", "id")


def test_edges_of_any_direction(areas, points):
    turned = areas.withColumn(
        "edges",
        F.expr("transform(edges, e -> struct(e.x2 AS x1, e.y2 AS y1, e.x1 AS x2, e.y1 AS y2))"),
    )
    got = spatial.points_in_areas(turned, points, ["area"])
    assert rows(got, "area", "id") == rows(spatial.points_in_areas(areas, points, ["area"]), "area", "id")


def test_points_in_areas_names_and_empty_sides(spark, areas, points):
    renamed = points.withColumn("area", F.lit("p"))
    got = spatial.points_in_areas(areas, renamed, ["area"])
    assert got.columns == ["area_left", "id", "x", "y", "area_right"]
    assert spatial.points_in_areas(areas.limit(0), points, ["area"]).count() == 0
    assert spatial.points_in_areas(areas, points.limit(0), ["area"]).count() == 0


def test_spatial_plan_has_no_nested_loop(areas, points):
    for max_bytes in (skew.BROADCAST_BYTES, 0):
        text = plan(spatial.points_in_areas(areas, points, ["area"], max_bytes=max_bytes))
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_cells_beyond_the_bound_are_not_broadcast(monkeypatch, areas, points):
    """Not even where their files are small; points within the bound are, and meet the same areas."""
    brute = rows(spatial.points_in_areas(areas, points, ["area"]), "area", "id")
    shuffled = spatial.points_in_areas(areas, points, ["area"], max_bytes=1)
    assert "SortMergeJoin" in plan(shuffled) and "BroadcastHashJoin" not in plan(shuffled)
    assert rows(shuffled, "area", "id") == brute
    monkeypatch.setattr(spatial, "fits", lambda df, max_bytes: "_whole" not in df.columns)
    swapped = spatial.points_in_areas(areas, points, ["area"])
    assert "BuildRight" in plan(swapped) and "SortMergeJoin" not in plan(swapped)
    assert rows(swapped, "area", "id") == brute


def test_a_side_measured_too_large_is_not_broadcast(spark):
    """The planner takes the size of files, and equal rows take next to none."""
    big = spark.range(1000).withColumn("id", F.col("id") % 10)
    small = spark.range(10)
    assert "BroadcastHashJoin" not in plan(skew.checked_join(big, small, ["id"], ["id"], max_bytes=64))
    assert "BroadcastHashJoin" in plan(skew.checked_join(big, small, ["id"], ["id"]))


@pytest.mark.parametrize("rows_per_task", [100, 10**6])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, how, rows_per_task):
    key = F.when(F.col("id") % 3 == 1, 7).when(F.col("id") % 3 == 2, F.col("id") % 50)
    big = spark.range(3000).select(key.alias("k"), F.col("id").alias("v"))
    small = spark.range(60).select((F.col("id") % 55).alias("k"), F.col("id").alias("w"))
    got = skew.salted_join(big, small, ["k"], ["v"], how, rows_per_task)
    assert rows(got) == rows(big.join(small, "k", how))


@pytest.mark.parametrize("rows_per_task", [100, 10**6])
def test_salted_outer_join(spark, rows_per_task):
    key = F.when(F.col("id") % 3 == 1, 7).when(F.col("id") % 3 == 2, F.col("id") % 50)
    facts = spark.range(3000).select(key.alias("k"), F.col("id").alias("v"))
    kept = spark.range(70).select(F.when(F.col("id") % 9 != 0, F.col("id")).alias("k"), F.col("id").alias("q"))
    got = skew.salted_outer_join(kept, facts, ["k"], ["v"], rows_per_task)
    assert rows(got, "k", "q", "v") == rows(kept.join(facts, "k", "left"), "k", "q", "v")


def test_hot_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"))
    assert rows(skew.hot_keys(df, ["k"], 100)) == [(1, 4)]
    assert skew.hot_keys(df, ["k"], 400) is None


def test_every_key_beyond_the_limit_is_split(spark, monkeypatch):
    """However many keys qualify: the list is shuffled when it does not fit a broadcast."""
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("k"), F.col("id").alias("v"))
    hot = skew.hot_keys(df, ["k"], 2)
    assert hot.count() == 20_000 and hot.agg(F.max("_salts")).first()[0] == 2
    other = spark.range(0, 20_000, 7).select(F.col("id").alias("k"))
    monkeypatch.setattr(skew, "fits", lambda *_: False)
    got = skew.join_with_hot_keys(df, other, ["k"], ["v"], hot)
    assert got.count() == df.join(other, "k").count() == got.distinct().count()


def test_fits(spark):
    assert skew.fits(spark.range(10))
    assert not skew.fits(spark.range(1000), 1000)
    assert not skew.fits(spark.range(10), 0)


def brute_nearest(left, right, exclusive):
    found = []
    for i, x, y in left:
        options = [
            ((x - u) * (x - u) + (y - v) * (y - v), j)
            for j, u, v in right
            if not (exclusive and (x, y) == (u, v))
        ]
        if options:
            best = min(options)[0]
            found += [(i, j) for d, j in options if d == best]
    return sorted(found)


@pytest.fixture(params=[32, 2])
def leaf_rows(request, monkeypatch):
    """Small leaves make small tables split over many levels."""
    monkeypatch.setattr(nearest, "LEAF_ROWS", request.param)


def check_nearest(spark, left, right, exclusive):
    a = spark.createDataFrame(left, "i int, x double, y double")
    b = spark.createDataFrame(right, "j int, x double, y double")
    got = nearest.nearest_join(a, b, exclusive=exclusive)
    assert got.columns == ["i", "x", "y", "j", "Distance"]
    assert sorted((r.i, r.j) for r in got.collect()) == brute_nearest(left, right, exclusive)


@pytest.mark.parametrize("exclusive", [False, True])
def test_nearest_lattice_ties_and_crowds(spark, leaf_rows, exclusive):
    pick = random.Random(3)
    left = [(i, float(pick.randrange(12)), float(pick.randrange(12))) for i in range(150)]
    left += [(1000 + i, 3.0, 3.0) for i in range(80)] + [(2000, 1e6, -1e6)]
    right = [(i, float(pick.randrange(12)), float(pick.randrange(12))) for i in range(60)]
    right += [(1000 + i, 3.0, 3.0) for i in range(30)]
    check_nearest(spark, left, right, exclusive)


def test_nearest_dense_cluster_and_outliers(spark, leaf_rows):
    """A third of the points within a millionth of the extent, the rest far away."""
    pick = random.Random(5)
    left = [(i, pick.uniform(0, 1e-3), pick.uniform(0, 1e-3)) for i in range(120)]
    left += [(500 + i, pick.uniform(-1e3, 1e3), pick.uniform(-1e3, 1e3)) for i in range(200)]
    right = [(i, pick.uniform(0, 1e-3), pick.uniform(0, 1e-3)) for i in range(120)]
    right += [(500 + i, pick.uniform(-1e3, 1e3), pick.uniform(-1e3, 1e3)) for i in range(60)]
    check_nearest(spark, left, right, exclusive=True)


def test_nearest_with_a_stray_coordinate(spark, leaf_rows):
    """One point a trillion units away leaves all others in one cell of the first levels."""
    pick = random.Random(6)
    left = [(i, pick.uniform(0, 1), pick.uniform(0, 1)) for i in range(90)] + [(900, 1e12, 1.0)]
    right = [(i, pick.uniform(0, 1), pick.uniform(0, 1)) for i in range(70)]
    check_nearest(spark, left, right, exclusive=True)


def test_nearest_with_a_right_point_all_share(spark, leaf_rows, monkeypatch):
    """One far right point serves most left points; its leaf is split over tasks."""
    monkeypatch.setattr(nearest, "ROWS_PER_TASK", 20)
    pick = random.Random(9)
    left = [(i, pick.uniform(0, 10), pick.uniform(0, 10)) for i in range(200)]
    right = [(1, 500.0, 5.0)] + [(10 + i, 900.0 + i, pick.uniform(0, 10)) for i in range(60)]
    check_nearest(spark, left, right, exclusive=True)


def test_nearest_single_right_point(spark, leaf_rows):
    left = [(1, 0.0, 0.0), (2, 5.0, 5.0)]
    check_nearest(spark, left, [(9, 5.0, 5.0)], exclusive=False)
    check_nearest(spark, left, [(9, 5.0, 5.0)], exclusive=True)


@pytest.mark.parametrize("exclusive", [False, True])
def test_leaves_meet_as_lists(spark, exclusive):
    """Ties inside a leaf are all kept, though what is dealt anew is one row for each leaf."""
    left = spark.createDataFrame([(0.0, 0.0), (9.0, 9.0)], "x double, y double")
    right = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0), (2.0, 0.0), (-2.0, 0.0), (9.0, 8.0)], "x double, y double")
    found = nearest.nearest_locations(left, right, exclusive)
    assert "collect_list" in plan(found)
    ties = [(0.0, 2.0), (2.0, 0.0), (-2.0, 0.0)] if exclusive else [(0.0, 0.0)]
    want = {(0.0, 0.0, *t, 4.0 if exclusive else 0.0) for t in ties} | {(9.0, 9.0, 9.0, 8.0, 1.0)}
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_nearest_empty_and_null_sides(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], "i int, x double, y double")
    b = spark.createDataFrame([(9, 1.0, 0.0), (8, 0.0, float("nan"))], "j int, x double, y double")
    assert rows(nearest.nearest_join(a, b), "i", "j", "Distance") == [(1, 9, 1.0)]
    assert nearest.nearest_join(a, b.limit(0)).count() == 0
    assert nearest.nearest_join(a.limit(0), b).count() == 0


def test_nearest_renames_clashing_columns(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0)], "id int, x double, y double")
    assert nearest.nearest_join(a, a).columns == ["id_left", "x", "y", "id_right", "Distance"]


def test_small_areas_get_small_cells(spark):
    """Points meet few cells however much the sizes of the areas differ."""
    def square(code, x, y, side):
        corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
        return code, "POLYGON ((" + ", ".join(f"{a!r} {b!r}" for a, b in corners) + "))"

    big = [square(i, (i % 32) * 32.0, (i // 32) * 32.0, 32.0) for i in range(1001)]
    tiny = [square(5000 + i, (i % 40) * 0.75 + 0.0625, (i // 40) * 0.75 + 0.0625, 0.25) for i in range(1000)]
    areas = geo.with_edges(spark.createDataFrame(big + tiny, "code long, geometry string"))
    points = spark.range(20_000).select(
        ((F.col("id") % 160) * 0.1875).alias("x"), (F.floor(F.col("id") / 160) * 0.1875).alias("y"), "id"
    )
    framed = spatial.framed_areas(areas, ["code"])
    grid = spatial.measure_grid(framed)
    assert min(grid.levels) < 0
    cells = spatial.area_cells(framed, ["code"], grid)
    candidates = spatial.point_cells(points, grid).join(cells, spatial.CELL_KEYS).count()
    hits = spatial.points_in_areas(areas, points, ["code"])
    shuffled = spatial.points_in_areas(areas, points, ["code"], max_bytes=0)
    assert hits.count() == shuffled.count() >= 20_000 and candidates <= 3 * hits.count()


def _nearest_by_hand(left, right):
    found = []
    for k, x, y in left:
        d2 = [((x - a) * (x - a) + (y - b) * (y - b), r) for r, a, b in right]
        found += [(k, r, d**0.5) for d, r in d2 if d == min(d2)[0]]
    return sorted(found)


@pytest.mark.parametrize("shape", ["stray", "diagonal", "one column", "two crowds"])
def test_nearest_over_counted_cells(spark, monkeypatch, shape):
    """Cells follow the rows: a stray coordinate, one column or two far crowds cost no more levels."""
    monkeypatch.setattr(nearest, "LEAF_ROWS", 4)
    levels = []
    cells = nearest._cells
    monkeypatch.setattr(nearest, "_cells", lambda *a: levels.append(a[1]) or cells(*a))
    spots = spark.range(300).select("id", (F.col("id") * 7919 % 1000 / 7).alias("x"), (F.col("id") * 104729 % 1000 / 3).alias("y"))
    x, y = {
        "stray": (F.when(F.col("id") == 7, 9.96921e36).otherwise(F.col("x")), F.col("y")),
        "diagonal": (F.col("x"), F.col("x") + F.col("y") / 1e6),
        "one column": (F.lit(5.0), F.col("y")),
        "two crowds": (F.col("x") / 1e9 + F.when(F.col("id") % 2 == 0, 1e12).otherwise(0), F.col("y") / 1e9),
    }[shape]
    spots = spots.select("id", x.alias("x"), y.alias("y")).cache()
    left, right = spots.where("id % 3 = 0"), spots.where("id % 3 <> 0").withColumnRenamed("id", "rid")
    found = nearest.nearest_join(left, right).select("id", "rid", "Distance")
    assert rows(found) == rows(spark.createDataFrame(
        _nearest_by_hand([tuple(r) for r in left.collect()], [tuple(r) for r in right.collect()]), "id bigint, rid bigint, Distance double"
    ))
    assert max(levels) <= 10  # 300 positions take nine bits


def test_cells_by_edge_carry_their_own_edges(spark, monkeypatch):
    """An outline of many vertices: dealt over tasks, a cell holds its share, points as before."""
    n = 6000
    star = [(100 + r * math.cos(a), 50 + r * math.sin(a)) for k in range(n) for a, r in [(2 * math.pi * k / n, 40 + 9 * math.sin(37 * 2 * math.pi * k / n))]]
    stairs = [(float(k // 2 + k % 2), float(k // 2)) for k in range(n)] + [(0.0, float(n // 2 - 1))]
    shapes = [("star", star), ("stairs", stairs)]
    text = [(name, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*ring, ring[0]]) + "))") for name, ring in shapes]
    areas = geo.with_edges(spark.createDataFrame(text, "code string, geometry string")).repartition(2).cache()
    spots = [(x, y) for x, y in [*star[::17], *stairs[::23], (2.5, 2.0), (2.0, 2.5), (100.0, 50.0)]]
    pick = random.Random(3)
    spots += [(pick.uniform(40, 160), pick.uniform(0, 100)) for _ in range(300)] + [(float(pick.randrange(3000)), float(pick.randrange(3000))) for _ in range(300)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "id int, x double, y double")
    found = rows(spatial.points_in_areas(areas, points, ["code"]), "code", "id")
    framed = spatial.framed_areas(areas, ["code"])
    cells = spatial.area_cells(framed, ["code"], spatial.measure_grid(framed))
    assert cells.agg(F.max(F.size("_more"))).first()[0] < n / 20
    monkeypatch.setattr(spatial, "MANY_EDGES", 10**9)
    assert found == rows(spatial.points_in_areas(areas, points, ["code"]), "code", "id")
    assert found == rows(areas.crossJoin(points).where(geo.covers("edges", "x", "y")), "code", "id")
