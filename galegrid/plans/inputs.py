"""Weather, incidents, trees and areas derived from the driver's tables.

Every input exists twice: as a DataFrame and as the SQL text of the same rows (`*_SQL`),
which the SQL twins use as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import with_edges
from ..schemas import WEATHER_MEASURES

# Customers per page where every fourth page is bad.
BAD_PAGE_SIZE = 20

# Measures after the four wind columns: (m * (k + 3)) % (k + 7) for the k-th of them.
_OTHER_MEASURES = WEATHER_MEASURES[4:]
_MEASURE_RULES = {
    "DD": "(m % 8) * 45",
    "FH": "(m % 5) * 10",
    "FF": "(m % 3) * 10",
    "FX": "CASE WHEN m % 11 = 0 THEN NULL ELSE (m % 4) * 10 END",
    **{c: f"(m * {k + 3}) % {k + 7}" for k, c in enumerate(_OTHER_MEASURES)},
}
_DAMAGE_RULE = (
    "CASE user_id % 4 WHEN 1 THEN 'Tree' WHEN 2 THEN 'Building' WHEN 3 THEN 'Road sign' END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- hourly weather ------------------------------------------------------------


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour that has events; hour slots 1..24."""
    hours = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_trunc("hour", F.col("ts")).alias("hr"))
        .agg(F.min("event_id").alias("m"))
    )
    return hours.select(
        F.lit(240).alias("STN"),
        F.to_date("hr").alias("YYYYMMDD"),
        (F.hour("hr") + 1).alias("HH"),
        *[F.expr(rule).cast("int").alias(c) for c, rule in _MEASURE_RULES.items()],
    )


WEATHER_SQL = (
    "SELECT 240 AS STN, CAST(hr AS DATE) AS YYYYMMDD, CAST(hour(hr) + 1 AS INTEGER) AS HH, "
    + ", ".join(f"CAST({rule} AS INTEGER) AS {c}" for c, rule in _MEASURE_RULES.items())
    + " FROM (SELECT date_trunc('hour', ts) AS hr, min(event_id) AS m FROM events GROUP BY 1) h"
)


# -- incidents -----------------------------------------------------------------


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error events."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .select(
            F.col("event_id").alias("Incident_ID"),
            F.col("ts").alias("Incident_Starttime"),
            F.to_date("ts").alias("Incident_Date"),
            F.expr(_DAMAGE_RULE).alias("Damage_Type"),
            F.concat(F.lit("SA "), (F.col("user_id") % 6).cast("string")).alias("Service_Area"),
            (F.col("user_id") % 3).cast("int").alias("Incident_Priority"),
            F.expr("event_id * 7919 % 51").cast("double").alias("x"),
            F.expr("event_id * 104729 % 11").cast("double").alias("y"),
        )
    )


INCIDENTS_SQL = (
    "SELECT event_id AS Incident_ID, ts AS Incident_Starttime, CAST(ts AS DATE) AS Incident_Date, "
    f"{_DAMAGE_RULE} AS Damage_Type, 'SA ' || CAST(user_id % 6 AS VARCHAR) AS Service_Area, "
    "CAST(user_id % 3 AS INTEGER) AS Incident_Priority, "
    "CAST(event_id * 7919 % 51 AS DOUBLE) AS x, CAST(event_id * 104729 % 11 AS DOUBLE) AS y "
    "FROM events WHERE event_type = 'error'"
)


# -- trees ---------------------------------------------------------------------

TREE_CATEGORIES = {
    "p_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
    "l_returnflag": ["A", "N"],
    "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "l_linestatus": ["F", "O"],
}


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as points on a lattice; some ids and some return flags are null."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("id"),
        F.col("l_quantity").alias("x"),
        F.round(F.col("l_discount") * 100).alias("y"),
        "p_type",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("l_returnflag"),
        "o_orderpriority",
        "l_linestatus",
    )


TREES_SQL = (
    "SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS id, l_quantity AS x, "
    "round(l_discount * 100) AS y, p_type, nullif(l_returnflag, 'R') AS l_returnflag, "
    "o_orderpriority, l_linestatus "
    "FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"
)


# -- areas ---------------------------------------------------------------------


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as a 5 x 5 board of rectangles over 0..50 x 0..10 with shared borders.

    Five names are used by two codes each.
    """
    board = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"),
        F.concat(F.lit("N"), (F.col("n_nationkey") % 20).cast("string")).alias("name"),
        ((F.col("n_nationkey") % 5) * 10).alias("x0"),
        (F.floor(F.col("n_nationkey") / 5) * 2).alias("y0"),
    )
    box = F.format_string(
        "POLYGON ((%d %d, %d %d, %d %d, %d %d, %d %d))",
        *[
            F.col(c).cast("bigint") + d
            for corner in ((0, 0), (10, 0), (10, 2), (0, 2), (0, 0))
            for c, d in zip(("x0", "y0"), corner)
        ],
    )
    return with_edges(board.select("code", "name", box.alias("geometry")))


AREAS_SQL = (
    "SELECT n_nationkey AS code, 'N' || CAST(n_nationkey % 20 AS VARCHAR) AS name, "
    "(n_nationkey % 5) * 10 AS x0, (n_nationkey // 5) * 2 AS y0 FROM nation"
)



def small_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tiny square around a lattice point for each supplier."""
    x, y = F.col("s_suppkey") * 7 % 50, F.col("s_suppkey") * 3 % 11
    west, east = (x - 0.0078125), (x + 0.0078125)
    south, north = (y - 0.0078125), (y + 0.0078125)
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    ring = F.concat_ws(", ", *[F.format_string("%.7f %.7f", a, b) for a, b in corners])
    shape = F.concat(F.lit("POLYGON (("), ring, F.lit("))"))
    squares = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1000).cast("bigint").alias("code"), shape.alias("geometry")
    )
    return with_edges(squares).select("code", "edges")


# Where a point p lies in the rectangle of an area a, border included.
IN_AREA_SQL = "p.x BETWEEN a.x0 AND a.x0 + 10 AND p.y BETWEEN a.y0 AND a.y0 + 2"


# -- polygons with holes and parts ---------------------------------------------

# Rings of an area around its centre: x offsets and y of the vertices. A diamond with a
# square hole, and a triangle as a second part.
_PARTS = [
    [
        [(-100, 50), (0, 90), (100, 50), (0, 10), (-100, 50)],
        [(-20, 40), (20, 40), (20, 60), (-20, 60), (-20, 40)],
    ],
    [[(60, 80), (90, 80), (90, 100), (60, 80)]],
]
POLYGON_EDGES = [
    (x1, y1, x2, y2)
    for part in _PARTS
    for ring in part
    for (x1, y1), (x2, y2) in zip(ring, ring[1:])
]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multipolygon per supplier, as WKT; neighbours overlap."""
    vertices = [v for part in _PARTS for ring in part for v in ring]
    pattern = ", ".join(
        "(" + ", ".join("(" + ", ".join(["%d %d"] * len(ring)) + ")" for ring in part) + ")"
        for part in _PARTS
    )
    centre = F.col("s_suppkey") * 150 + 75
    numbers = [n for dx, y in vertices for n in (centre + dx, F.lit(y))]
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("zone"),
        F.col("s_nationkey").alias("nation"),
        F.format_string(f"MULTIPOLYGON ({pattern})", *numbers).alias("geometry"),
    )


def zone_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items along the strip of zones."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("x"),
        (F.col("l_quantity") * 2).alias("y"),
        "l_orderkey",
        "l_linenumber",
    )


# -- scattered points ----------------------------------------------------------


def scattered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as points scattered over a square that does not repeat within a table."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.expr("event_id * 7919 % 100003").cast("double").alias("x"),
        F.expr("event_id * 104729 % 99991").cast("double").alias("y"),
    )


SCATTERED_SQL = (
    "SELECT event_id, event_type, user_id, CAST(event_id * 7919 % 100003 AS DOUBLE) AS x, "
    "CAST(event_id * 104729 % 99991 AS DOUBLE) AS y FROM events"
)
