from __future__ import annotations

import math
import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galegrid.functions import datum
from galegrid.functions import geometry as geo

VALUES = [0.0, -0.0, 4.9, 52.37, -0.1, 0.5, 1 - 2**-53, 123456.789, 1e-9, -1e-5, 0.00390625, 2.0**-17, 7.0]


def test_point_wkt_has_the_exact_digits(spark):
    df = spark.createDataFrame([(v, -v) for v in VALUES], "x double, y double")
    for row in df.select("x", "y", geo.point_wkt(F.col("x"), F.col("y")).alias("w")).collect():
        x, y = (abs(float(t)) for t in re.findall(r"[\d.]+", row.w))
        assert abs(x - abs(row.x)) <= 1e-16 and abs(y - abs(row.y)) <= 1e-16
        if abs(row.x) != 2.0**-17:  # an exact tie of the last digit may round either way
            assert row.w == "POINT (%.16f %.16f)" % (row.x, row.y)


def test_point_parsing(spark):
    texts = ["POINT (4.5 -52)", "point(1 2)", "POINT EMPTY", None, " POINT Z ( 1e3 \t -2   7 )", "LINESTRING (1 2, 3 4)"]
    df = geo.with_points(spark.createDataFrame([(t,) for t in texts], "geometry string"))
    assert [(r.x, r.y) for r in df.collect()] == [
        (4.5, -52.0), (1.0, 2.0), (None, None), (None, None), (1000.0, -2.0), (None, None)
    ]
    with pytest.raises(ValueError):
        geo.with_points(spark.range(1))


def test_polygon_edges_and_bounds(spark):
    df = spark.createDataFrame(
        [("MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1)), ((9 9, 10 9, 9 11, 9 9)))",), ("POLYGON EMPTY",)],
        ["geometry"],
    ).transform(geo.with_edges)
    full, empty = df.select("edges", geo.bounds(F.col("edges")).alias("b")).collect()
    assert len(full.edges) == 9 and tuple(full.b) == (0.0, 0.0, 10.0, 11.0)
    assert empty.edges == [] and empty.b is None


def test_known_grid_points(spark):
    # Given to a tolerance of 1e-6 degrees.
    known = {(155000.0, 463000.0): (5.38720621, 52.1551744), (120700.723, 487525.501): (4.88352559, 52.37453253)}
    df = spark.createDataFrame(list(known), "x double, y double")
    lon, lat = geo.rd_to_wgs84(F.col("x"), F.col("y"))
    for row in df.select("x", "y", lon.alias("lon"), lat.alias("lat")).collect():
        assert (row.lon, row.lat) == pytest.approx(known[(row.x, row.y)], abs=1e-6)


def test_reprojected_text_keeps_its_rings(spark):
    texts = [
        "POLYGON ((155000 463000, 155100 463000, 155000 463100, 155000 463000), (155010 463010, 155020 463010, 155010 463020, 155010 463010))",
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((155000 463000, 155100 463000, 155000 463100, 155000 463000), (155010 463010, 155020 463010, 155010 463020, 155010 463010)))",
        "POINT (155000 463000)",
        "POLYGON EMPTY",
    ]
    df = spark.createDataFrame([(t,) for t in texts], ["g"])
    moved = [r[0] for r in df.select(geo.reproject_wkt(F.col("g"))).collect()]
    for before, after in zip(texts, moved):
        assert re.sub(r"[-\d.]+", "n", before) == re.sub(r"[-\d.]+", "n", after)
    assert moved[1].count("5.3872062100000004 52.1551743999999999") == 2


def test_geojson_text(spark):
    shapes = [
        ("Point", "[4.5, 52]"),
        ("Polygon", "[[[0,0],[1,0],[1,1],[0,0]]]"),
        ("MultiPolygon", "[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]"),
        ("Unknown", "[]"),
    ]
    df = spark.createDataFrame(shapes, ["t", "c"])
    plain = [r[0] for r in df.select(geo.geojson_wkt(F.col("t"), F.col("c"))).collect()]
    assert plain[0] == "POINT (4.5000000000000000 52.0000000000000000)"
    assert re.sub(r"\.0+\b", "", plain[2]) == (
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"
    )
    assert plain[3] is None
    swapped = df.select(geo.geojson_wkt(F.col("t"), F.col("c"), swap_axes=True)).first()[0]
    assert swapped == "POINT (52.0000000000000000 4.5000000000000000)"


def exact_inside(ring_list, x, y):
    """Even-odd rule with fractions, border included."""
    x, y, odd = Fraction(x), Fraction(y), False
    for ring in ring_list:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (y2 > y1) == (side > 0):
                odd = not odd
    return odd


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-6, 6), st.integers(-6, 6)), min_size=3, max_size=9))
def test_covers_random_rings(spark, corners):
    ring = [*corners, corners[0]]
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in ring) + "))"
    grid = [(a / 2, b / 2) for a in range(-14, 15) for b in range(-14, 15)]
    df = spark.createDataFrame(grid, "x double, y double").withColumn("geometry", F.lit(text))
    got = geo.with_edges(df).select(geo.covers("edges", "x", "y")).collect()
    assert [r[0] for r in got] == [exact_inside([ring], x, y) for x, y in grid]


#: Official points: longitude, latitude, x, y.
POINTS = [
    (4.824761912, 53.160753042, 117380.12, 575040.34),
    (6.776726674, 53.419482050, 247380.56, 604580.78),
    (5.387203657, 52.155172897, 155000.0, 463000.0),
    (3.397588595, 51.368607152, 16460.91, 377380.23),
    (5.773795548, 50.792584916, 182260.45, 311480.67),
    (4.072887101, 51.947393898, 64640.89, 440700.01),
]


def test_datum_transformation_on_official_points(spark):
    """Within the two decimetres that only the correction grid takes away; the polynomial is close to it."""
    df = spark.createDataFrame(POINTS, "lon double, lat double, x double, y double")
    exact, quick = datum.rd_to_wgs84(F.col("x"), F.col("y")), geo.rd_to_wgs84(F.col("x"), F.col("y"))
    for r in df.select("lon", "lat", exact.alias("e"), F.array(*quick).alias("q")).collect():
        for found, most in ((r.e, 0.2), (r.q, 0.6)):
            north = (found[1] - r.lat) * 111_200
            east = (found[0] - r.lon) * 111_200 * math.cos(math.radians(r.lat))
            assert math.hypot(north, east) < most, (r, north, east)


def test_datum_transformation_of_shapes_and_nulls(spark):
    df = spark.createDataFrame([("POINT (155000 463000)", None), ("POLYGON ((0 300000, 1 300000, 1 300001, 0 300000))", 1.0), (None, 2.0)], "t string, x double")
    moved = geo.reproject_wkt(F.col("t"), lambda v: datum.rd_to_wgs84(v[0], v[1]))
    found = df.select(moved.alias("m"), datum.rd_to_wgs84(F.col("x"), F.lit(463000)).alias("p")).collect()
    assert found[0].m.startswith("POINT (5.38720") and found[0].p is None
    assert found[1].m.startswith("POLYGON ((3.1") and found[2].m is None and len(found[2].p) == 2
