"""Geometry as ordinary columns: WKT and GeoJSON text, edge lists, planar predicates.

A polygon is the list of all its ring edges, holes and parts included, so one even-odd
rule covers polygons with holes and multipolygons. Everything is a Column expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import require_columns

RING_TYPE = "array<array<double>>"
RINGS_TYPE = f"array<{RING_TYPE}>"
PARTS_TYPE = f"array<{RINGS_TYPE}>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


# -- text to coordinates -------------------------------------------------------


def point_x(wkt: Column) -> Column:
    """x of a `POINT (x y)` text; null for an empty point or another shape."""
    return F.get(_point_numbers(wkt), 0).cast("double")


def point_y(wkt: Column) -> Column:
    """y of a `POINT (x y)` text; null for an empty point or another shape."""
    return F.get(_point_numbers(wkt), 1).cast("double")


def _point_numbers(wkt: Column) -> Column:
    """The numbers of a point as texts; plain string functions, as points are many."""
    body = F.substring_index(F.substring_index(wkt, "(", -1), ")", 1)
    words = F.array_remove(F.split(F.translate(body, "\t\n", "  "), " "), "")
    return F.when(wkt.rlike(r"^\s*(?i:POINT)[^(]*\("), words)


def wkt_rings(wkt: Column) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON text as arrays of [x, y]."""
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(
        texts,
        lambda ring: F.transform(
            F.split(F.trim(ring), r"\s*,\s*"),
            lambda vertex: F.transform(
                F.slice(F.split(vertex, r"\s+"), 1, 2), lambda number: number.cast("double")
            ),
        ),
    )


def rings_to_edges(rings: Column) -> Column:
    """Consecutive vertices of every ring as edges, the lower (then left) end first.

    The order makes a border two areas share the same edge in both, so a point close to it
    is judged alike on both sides.
    """

    def edge(a: Column, b: Column) -> Column:
        turned = (a[1] > b[1]) | ((a[1] == b[1]) & (a[0] > b[0]))
        return F.struct(
            F.when(turned, b[0]).otherwise(a[0]).alias("x1"),
            F.when(turned, b[1]).otherwise(a[1]).alias("y1"),
            F.when(turned, a[0]).otherwise(b[0]).alias("x2"),
            F.when(turned, a[1]).otherwise(b[1]).alias("y2"),
        )

    def ring_edges(ring: Column) -> Column:
        count = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.zip_with(F.slice(ring, F.lit(1), count), F.slice(ring, F.lit(2), count), edge)

    return F.flatten(F.transform(rings, ring_edges))


def wkt_edges(wkt: Column) -> Column:
    """Edge list of a POLYGON or MULTIPOLYGON text."""
    return rings_to_edges(wkt_rings(wkt))


def with_points(
    df: DataFrame, geometry: str = "geometry", x: str = "x", y: str = "y"
) -> DataFrame:
    """Decode a WKT point column into `x`, `y`; an error when the column is missing."""
    require_columns(df, geometry)
    return df.withColumns({x: point_x(F.col(geometry)), y: point_y(F.col(geometry))})


def with_edges(df: DataFrame, geometry: str = "geometry", edges: str = "edges") -> DataFrame:
    """Decode a WKT polygon column into an edge list; an error when the column is missing."""
    require_columns(df, geometry)
    return df.withColumn(edges, wkt_edges(F.col(geometry)))


# -- coordinates to text -------------------------------------------------------


def _whole_number(value: int, kind: str) -> Column:
    return F.lit(str(value)).cast(kind)


def fixed16(value: Column) -> Column:
    """A double with 16 decimals, digit for digit its binary value rounded.

    Java's formatter pads the shortest decimal form with zeros instead. The fraction times a
    power of two is an exact integer, so decimal arithmetic gives the true digits; small
    values take a higher power, which leaves an error far below the last digit.
    """
    size = F.abs(value)
    whole = F.floor(size)
    small = size < 2.0**-8
    scale = F.when(small, _whole_number(2**68, "decimal(22,0)")).otherwise(
        _whole_number(2**60, "decimal(22,0)")
    )
    fraction = F.when(small, size * F.lit(2.0**68)).otherwise((size - whole) * F.lit(2.0**60))
    scaled = fraction.cast("bigint").cast("decimal(19,0)") * _whole_number(10**16, "decimal(17,0)")
    half = F.when(small, _whole_number(2**67, "decimal(21,0)")).otherwise(
        _whole_number(2**59, "decimal(21,0)")
    )
    digits = F.call_function("div", scaled + half, scale)
    carry = digits >= F.lit(10**16)
    return F.concat(
        F.when(value.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit("")),
        (whole + carry.cast("bigint")).cast("string"),
        F.lit("."),
        F.lpad(F.when(carry, F.lit(0)).otherwise(digits).cast("string"), 16, "0"),
    )


def point_wkt(x: Column, y: Column) -> Column:
    """`POINT (x y)` with 16 decimals."""
    return F.concat(F.lit("POINT ("), fixed16(x), F.lit(" "), fixed16(y), F.lit(")"))


def _ring_text(ring: Column) -> Column:
    vertices = F.transform(ring, lambda v: F.concat(fixed16(v[0]), F.lit(" "), fixed16(v[1])))
    return F.concat(F.lit("("), F.array_join(vertices, ", "), F.lit(")"))


def _part_text(rings: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(rings, _ring_text), ", "), F.lit(")"))


def polygon_wkt(rings: Column) -> Column:
    """`POLYGON (...)` from an array of rings."""
    return F.concat(F.lit("POLYGON "), _part_text(rings))


def multipolygon_wkt(parts: Column) -> Column:
    """`MULTIPOLYGON (...)` from an array of ring arrays."""
    return F.concat(
        F.lit("MULTIPOLYGON ("), F.array_join(F.transform(parts, _part_text), ", "), F.lit(")")
    )


def _geojson_rings(coordinates: Column, kind: Column, swap_axes: bool) -> tuple[Column, Column]:
    """Rings of a Polygon and ring arrays of a MultiPolygon, vertices as [x, y]."""
    i, j = (1, 0) if swap_axes else (0, 1)

    def rings(value: Column) -> Column:
        return F.transform(value, lambda ring: F.transform(ring, lambda v: F.array(v[i], v[j])))

    polygon = F.when(kind == "Polygon", rings(F.from_json(coordinates, RINGS_TYPE)))
    parts = F.when(
        kind == "MultiPolygon", F.transform(F.from_json(coordinates, PARTS_TYPE), rings)
    )
    return polygon, parts


def geojson_point(kind: Column, coordinates: Column, swap_axes: bool = False) -> tuple[Column, Column]:
    """x and y of a GeoJSON point given its type and its coordinates as JSON text.

    `swap_axes` reads latitude, longitude order.
    """
    point = F.when(kind == "Point", F.from_json(coordinates, "array<double>"))
    x, y = F.get(point, 0), F.get(point, 1)
    return (y, x) if swap_axes else (x, y)


def geojson_edges(kind: Column, coordinates: Column, swap_axes: bool = False) -> Column:
    """Edge list of a GeoJSON polygon or multipolygon."""
    polygon, parts = _geojson_rings(coordinates, kind, swap_axes)
    return rings_to_edges(F.coalesce(polygon, F.flatten(parts)))


def geojson_wkt(kind: Column, coordinates: Column, swap_axes: bool = False) -> Column:
    """WKT of a GeoJSON point, polygon or multipolygon."""
    x, y = geojson_point(kind, coordinates, swap_axes)
    polygon, parts = _geojson_rings(coordinates, kind, swap_axes)
    return (
        F.when(kind == "Point", point_wkt(x, y))
        .when(kind == "Polygon", polygon_wkt(polygon))
        .when(kind == "MultiPolygon", multipolygon_wkt(parts))
    )


# -- measures and predicates ---------------------------------------------------


def bounds(edges: Column) -> Column:
    """Bounding box struct of an edge list; null for an empty list."""
    return F.when(
        F.size(edges) > 0,
        F.struct(
            F.array_min(F.transform(edges, lambda e: F.least(e["x1"], e["x2"]))).alias("xmin"),
            F.array_min(F.transform(edges, lambda e: F.least(e["y1"], e["y2"]))).alias("ymin"),
            F.array_max(F.transform(edges, lambda e: F.greatest(e["x1"], e["x2"]))).alias("xmax"),
            F.array_max(F.transform(edges, lambda e: F.greatest(e["y1"], e["y2"]))).alias("ymax"),
        ),
    )


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return dx * dx + dy * dy


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance in the unit of the coordinates."""
    return F.sqrt(squared_distance(x1, y1, x2, y2))


# What one edge adds to the sum of a point: CROSSED when a ray from the point to the right
# crosses the edge, ON_BORDER when the point lies on it. Odd sums and sums from ON_BORDER on
# mean inside or on the border.
CROSSED, ON_BORDER = 1, 1 << 20


def edge_code_sql(x: str, y: str, x1: str, y1: str, x2: str, y2: str, left: str, right: str) -> str:
    """SQL of what an edge adds to the sum of a point; `left`, `right` bound the edge.

    The first end is the lower one. Only the sign of a cross product counts, so a horizontal
    edge needs no division. An edge of NaN values adds nothing.
    """
    side = f"(({x2} - {x1}) * ({y} - {y1}) - ({x} - {x1}) * ({y2} - {y1}))"
    return (
        f"(CASE WHEN {y} < {y1} OR {y} > {y2} THEN 0 "
        f"WHEN {side} > 0 THEN IF({y} < {y2}, {CROSSED}, 0) "
        f"WHEN {side} = 0 AND {x} >= {left} AND {x} <= {right} THEN {ON_BORDER} ELSE 0 END)"
    )


def covers(edges: str, x: str, y: str) -> Column:
    """True when the point lies inside the polygon or on its border (even-odd rule).

    Takes SQL expressions; one pass over an edge list as `wkt_edges` makes it.
    """
    code = edge_code_sql(
        x, y, "e.x1", "e.y1", "e.x2", "e.y2", "least(e.x1, e.x2)", "greatest(e.x1, e.x2)"
    )
    return F.expr(
        f"aggregate({edges}, 0, (s, e) -> s + {code}, s -> s >= {ON_BORDER} OR s % 2 = 1)"
    )


# -- reprojection --------------------------------------------------------------

# Published polynomial from the Dutch national grid (EPSG:28992) to
# WGS84 (EPSG:4326), terms (p, q, coefficient) in seconds of arc.
RD_ORIGIN = (155000.0, 463000.0)
RD_ORIGIN_LAT, RD_ORIGIN_LON = 52.15517440, 5.38720621
RD_LAT_TERMS = [
    (0, 1, 3235.65389),
    (2, 0, -32.58297),
    (0, 2, -0.24750),
    (2, 1, -0.84978),
    (0, 3, -0.06550),
    (2, 2, -0.01709),
    (1, 0, -0.00738),
    (4, 0, 0.00530),
    (2, 3, -0.00039),
    (4, 1, 0.00033),
    (1, 1, -0.00012),
]
RD_LON_TERMS = [
    (1, 0, 5260.52916),
    (1, 1, 105.94684),
    (1, 2, 2.45656),
    (3, 0, -0.81885),
    (1, 3, 0.05594),
    (3, 1, -0.05607),
    (0, 1, 0.01199),
    (3, 2, -0.00256),
    (1, 4, 0.00128),
    (0, 2, 0.00022),
    (2, 0, -0.00022),
    (5, 0, 0.00026),
]


def _power_sum(terms: list[tuple[int, int, float]], a: Column, b: Column) -> Column:
    def power(base: Column, n: int) -> Column:
        result = F.lit(1.0)
        for _ in range(n):
            result = result * base
        return result

    total = F.lit(0.0)
    for p, q, coefficient in terms:
        total = total + F.lit(coefficient) * power(a, p) * power(b, q)
    return total


def rd_to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """(longitude, latitude) of a point given in EPSG:28992."""
    a = (x - RD_ORIGIN[0]) * 1e-5
    b = (y - RD_ORIGIN[1]) * 1e-5
    lon = F.lit(RD_ORIGIN_LON) + _power_sum(RD_LON_TERMS, a, b) / 3600.0
    lat = F.lit(RD_ORIGIN_LAT) + _power_sum(RD_LAT_TERMS, a, b) / 3600.0
    return lon, lat


def _move_vertex(vertex: Column) -> Column:
    return F.array(*rd_to_wgs84(vertex[0], vertex[1]))


def reproject_wkt(wkt: Column, move: Callable[[Column], Column] = _move_vertex) -> Column:
    """A POINT, POLYGON or MULTIPOLYGON text moved from EPSG:28992 to EPSG:4326.

    `move` takes a vertex to another, by default with the polynomial.
    """

    def moved(rings: Column) -> Column:
        return F.transform(rings, lambda ring: F.transform(ring, move))

    kind = F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))
    point = let(F.array(point_x(wkt), point_y(wkt)), move)
    # The parts of a multipolygon meet at `)), ((`; a part then reads like one polygon.
    parts = F.transform(
        F.split(wkt, r"\)\s*\)\s*,\s*\(\s*\("),
        lambda part: moved(
            wkt_rings(
                F.concat(F.lit("("), F.regexp_replace(part, r"^\s*[A-Za-z][^(]*\(+|\)+\s*$", ""), F.lit(")"))
            )
        ),
    )
    return (
        F.when(wkt.rlike(r"(?i)EMPTY\s*$"), wkt)
        .when(kind == "POINT", let(point, lambda v: point_wkt(v[0], v[1])))
        .when(kind == "POLYGON", polygon_wkt(moved(wkt_rings(wkt))))
        .when(kind == "MULTIPOLYGON", multipolygon_wkt(parts))
    )
