"""The SQL twin of every registered query that standard SQL can express."""

from __future__ import annotations

import math

from ..functions import datum
from ..functions.geometry import (
    RD_LAT_TERMS,
    RD_LON_TERMS,
    RD_ORIGIN,
    RD_ORIGIN_LAT,
    RD_ORIGIN_LON,
)
from ..functions.columns import feature_name
from ..schemas import WEATHER_MEASURES
from . import trees_sql
from .inputs import (
    AREAS_SQL,
    BAD_PAGE_SIZE,
    IN_AREA_SQL,
    INCIDENTS_SQL,
    POLYGON_EDGES,
    SCATTERED_SQL,
    TREE_CATEGORIES,
    TREES_SQL,
    WEATHER_SQL,
)
from .queries import INDICATORS, SMALL_TREES

#: 60 bits of a hash, as `ranks.draw` takes them.
_DRAW = "('0x' || substr(md5('42|' || {key}), 1, 15))::BIGINT"


def _reproject_datum() -> str:
    """The datum transformation step by step."""
    d, (rx, ry, rz) = datum, datum.ANGLES
    e2 = d.BESSEL[1] * (2 - d.BESSEL[1])
    a, f = d.WGS84
    w2, b = f * (2 - f), a * (1 - f)
    series = " + ".join(f"{factor!r} * sin({2 * k}e0 * c)" for k, factor in enumerate(d.SERIES, 1))
    n = {k: f"({v!r}::DOUBLE)" for k, v in dict(
        near=d.NEAR, far=d.FAR, power=d.POWER, lon=math.radians(d.ORIGIN[1]), centre=d.CENTRE, scaled=2 * d.RADIUS * d.SCALE,
        factor=d.FACTOR, e2=e2, bessel=d.BESSEL[0], grow=d.GROWTH, rx=rx, ry=ry, rz=rz, a=a, b=b, w2=w2,
    ).items()}
    tx, ty, tz = (f"{t!r}::DOUBLE" for t in d.SHIFT)
    return (
        "WITH g AS (SELECT l_orderkey, l_linenumber, l_extendedprice * 0.5e0 + 120000e0 - 155000e0 AS e, "
        "l_quantity * 400e0 + 470000e0 - 463000e0 AS n FROM lineitem), "
        f"i AS (SELECT *, atan(e / ({n['far']} + n)) AS i FROM g), j AS (SELECT *, atan(e / ({n['near']} - n)) - i AS j FROM i), "
        f"s AS (SELECT *, (j + 2 * i) / {n['power']} + {n['lon']} AS lam, sin({n['centre']} + 2 * atan((n - e * tan(j / 2)) / {n['scaled']})) AS s FROM j), "
        f"c AS (SELECT *, 2 * atan(exp(ln((1 + s) / ({n['factor']} * (1 - s))) / (2 * {n['power']}))) - pi() / 2 AS c FROM s), "
        f"p AS (SELECT *, c + {series} AS phi FROM c), v AS (SELECT *, {n['bessel']} / sqrt(1 - {n['e2']} * sin(phi) * sin(phi)) AS v FROM p), "
        f"o AS (SELECT *, v * cos(phi) * cos(lam) AS x, v * cos(phi) * sin(lam) AS y, v * (1 - {n['e2']}) * sin(phi) AS z FROM v), "
        f"m AS (SELECT l_orderkey, l_linenumber, {tx} + {n['grow']} * (x - {n['rz']} * y + {n['ry']} * z) AS x, "
        f"{ty} + {n['grow']} * ({n['rz']} * x + y - {n['rx']} * z) AS y, {tz} + {n['grow']} * (-{n['ry']} * x + {n['rx']} * y + z) AS z FROM o), "
        f"t AS (SELECT *, sqrt(x * x + y * y) AS flat, atan2(z * {n['a']}, sqrt(x * x + y * y) * {n['b']}) AS t FROM m) "
        "SELECT l_orderkey, l_linenumber, round(degrees(atan2(y, x)), 9) AS lon, round(degrees(atan2("
        f"z + {n['w2']} / (1 - {n['w2']}) * {n['b']} * sin(t) * sin(t) * sin(t), flat - {n['w2']} * {n['a']} * cos(t) * cos(t) * cos(t))), 9) AS lat FROM t"
    )


def _small_trees() -> str:
    """The rows of `queries.poisson_trees`, split to the row, and its trees."""
    names = ", ".join(INDICATORS)
    flags = {f"{c}_{v}": f"CAST(coalesce({c} = '{v}', FALSE) AS INTEGER)" for c, vs in INDICATORS.items() for v in vs}
    key = " || '|' || ".join(
        ["strftime(YYYYMMDD, '%Y-%m-%d')", "CAST(HH AS VARCHAR)", *[f"coalesce({c}, '')" for c in INDICATORS]]
    )
    counted = (
        f"counted AS (SELECT YYYYMMDD, HH, {names}, {', '.join(WEATHER_MEASURES)}, count(Incident_ID) AS n_events FROM wi GROUP BY ALL), "
        f"drawn AS (SELECT *, row_number() OVER (ORDER BY {_DRAW.format(key=key)}) AS id, count(*) OVER () AS n_rows FROM counted), "
        f"ready AS MATERIALIZED (SELECT *, id > ceil(n_rows * 0.2) AS is_train, "
        + ", ".join(f'{sql} AS "{name}"' for name, sql in flags.items())
        + " FROM drawn)"
    )
    return f"WITH {W}, {I}, {WI}, {counted}, {trees_sql.trees('ready', [*WEATHER_MEASURES, *flags], **SMALL_TREES)}"


W = f"w AS ({WEATHER_SQL})"
I = f"i AS (SELECT *, CAST(hour(Incident_Starttime) AS INTEGER) AS IncStrt_Hour FROM ({INCIDENTS_SQL}) q)"
T = f"t AS ({TREES_SQL})"
A = f"a AS ({AREAS_SQL})"
_INCIDENT_COLUMNS = "Incident_ID, Damage_Type, Service_Area, Incident_Priority, Incident_Starttime"
WI = (
    f"wi AS (SELECT w.*, {_INCIDENT_COLUMNS} FROM w LEFT JOIN i "
    "ON YYYYMMDD = Incident_Date AND HH = IncStrt_Hour)"
)
LABELS = (
    "labels AS (SELECT DD, FH, FF, FX, coalesce(Damage_Type, 'No-Incident') AS Damage_Type, "
    "count(Incident_ID) AS Total_Incidents FROM wi GROUP BY DD, FH, FF, FX, wi.Damage_Type)"
)
CONDITIONS = "conds AS (SELECT DISTINCT DD, FH, FF, FX FROM w)"


def _counts(categories: dict[str, list[str]]) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {c} = '{v}') AS \"{feature_name('Trees', c, v)}\""
        for c, values in categories.items()
        for v in values
    )


def _profile(key: str) -> str:
    return (
        f"profile AS (SELECT {key}, count(id) AS Trees_Totaal, {_counts(TREE_CATEGORIES)} "
        f"FROM a JOIN t p ON {IN_AREA_SQL} GROUP BY {key})"
    )


_ALIGNED = "YYYYMMDD, HH, DD, FH, FF, FX, Incident_ID, Damage_Type, Incident_Starttime"
_WIDE = ", ".join(
    ["Trees_Totaal"]
    + [f"\"{feature_name('Trees', c, v)}\"" for c, values in TREE_CATEGORIES.items() for v in values]
)
GRID = (
    f"grid AS (SELECT code, a.name, DD, FH, FF, FX, {_WIDE} "
    "FROM a CROSS JOIN conds JOIN profile ON a.name = profile.name)"
)
LABELLED = (
    "labelled AS (SELECT grid.*, Damage_Type, Total_Incidents FROM grid LEFT JOIN labels ON "
    "grid.DD = labels.DD AND grid.FH = labels.FH AND grid.FF = labels.FF AND grid.FX = labels.FX)"
)


def _polynomial(terms: list[tuple[int, int, float]]) -> str:
    def power(name: str, n: int) -> str:
        return "(1e0" + f" * {name}" * n + ")"

    total = "0e0"
    for p, q, coefficient in terms:
        total = f"({total} + {coefficient!r}e0 * {power('a', p)} * {power('b', q)})"
    return total


def _wgs84(source: str, keys: str) -> str:
    """lon, lat of `rd_x`, `rd_y`, in the same order of operations as the columns."""
    return (
        f"SELECT {keys}, round({RD_ORIGIN_LON!r}e0 + {_polynomial(RD_LON_TERMS)} / 3600e0, 7) AS lon, "
        f"round({RD_ORIGIN_LAT!r}e0 + {_polynomial(RD_LAT_TERMS)} / 3600e0, 7) AS lat "
        f"FROM (SELECT *, (rd_x - {RD_ORIGIN[0]!r}e0) * 1e-5 AS a, "
        f"(rd_y - {RD_ORIGIN[1]!r}e0) * 1e-5 AS b FROM ({source}) s) r"
    )


_EDGE_ROWS = ", ".join(f"({x1}, {y1}, {x2}, {y2})" for x1, y1, x2, y2 in POLYGON_EDGES)
_SIDE = "((e.x2 - e.x1) * (p.y - e.y1) - (p.x - e.x1) * (e.y2 - e.y1))"
_POLYGONS = f"""
WITH shape(dx1, y1, dx2, y2) AS (VALUES {_EDGE_ROWS}),
p AS (SELECT row_number() OVER () AS pid, CAST(l_orderkey AS DOUBLE) AS x, l_quantity * 2 AS y,
             l_linenumber FROM lineitem),
e AS (SELECT s_suppkey AS zone, s_nationkey AS nation, s_suppkey * 150 + 75 AS mid,
             CAST(s_suppkey * 150 + 75 + dx1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
             CAST(s_suppkey * 150 + 75 + dx2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
      FROM supplier CROSS JOIN shape),
z AS (SELECT DISTINCT zone, nation, mid, CAST(floor(mid / 256) AS BIGINT) AS slot FROM e),
near_zone AS (SELECT p.*, zone, nation FROM p
      JOIN (SELECT zone, nation, mid, unnest(generate_series(CAST(floor((mid - 100) / 256) AS BIGINT),
                   CAST(floor((mid + 100) / 256) AS BIGINT))) AS slot FROM z) zz
      ON CAST(floor(p.x / 256) AS BIGINT) = zz.slot AND abs(p.x - zz.mid) <= 100),
hits AS (SELECT p.pid, p.zone, p.nation, any_value(p.l_linenumber) AS l_linenumber, any_value(p.y) AS y,
      count(*) FILTER (WHERE (e.y1 > p.y) <> (e.y2 > p.y) AND (e.y2 > e.y1) = ({_SIDE} > 0)) % 2 = 1
      OR bool_or({_SIDE} = 0 AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                 AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS inside
      FROM near_zone p JOIN e ON p.zone = e.zone GROUP BY p.pid, p.zone, p.nation)
SELECT zone, nation, count(*) AS n_points, CAST(sum(l_linenumber) AS BIGINT) AS sum_line,
       CAST(sum(CAST(y AS BIGINT)) AS BIGINT) AS sum_y
FROM hits WHERE inside GROUP BY zone, nation
"""

_NUMBERS = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"]
_DESCRIBE = {
    "count": "CAST(count({c}) AS DOUBLE)",
    "mean": "avg(CAST({c} AS DOUBLE))",
    "std": "stddev_samp({c})",
    "min": "CAST(min({c}) AS DOUBLE)",
    "25%": "quantile_cont(CAST({c} AS DOUBLE), 0.25)",
    "50%": "quantile_cont(CAST({c} AS DOUBLE), 0.5)",
    "75%": "quantile_cont(CAST({c} AS DOUBLE), 0.75)",
    "max": "CAST(max({c}) AS DOUBLE)",
}


def _profile_rows() -> str:
    rows = [
        "SELECT '*' AS \"column\", 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM lineitem",
        "SELECT '*', 'n_columns', 5e0",
    ]
    for c in [*_NUMBERS, "l_returnflag"]:
        rows.append(f"SELECT '{c}', 'nulls', CAST(count(*) - count({c}) AS DOUBLE) FROM lineitem")
    for c in _NUMBERS:
        for metric, rule in _DESCRIBE.items():
            rows.append(f"SELECT '{c}', '{metric}', {rule.format(c=c)} FROM lineitem")
    return (
        'SELECT "column", metric, round(value, 4) AS value FROM (' + " UNION ALL ".join(rows) + ") r"
    )


def _null_rows(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {source}" for c in columns
    )


_FLAGS = [("Service_Area", f"SA {k}") for k in range(6)] + [
    ("Damage_Type", v) for v in ("Building", "Road sign", "Tree")
]
_SQUARE = [(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)]
_SQUARE_WKT = ", ".join(["%.16f %.16f"] * 5)
_SQUARE_ARGS = ", ".join(
    f"CAST(s_suppkey AS DOUBLE) + {dx}, CAST(s_nationkey AS DOUBLE) + {dy}" for dx, dy in _SQUARE
)
_LOCATED = (
    "located AS (SELECT a.code, i.* FROM a JOIN (SELECT *, IncStrt_Hour AS hh FROM i) p "
    f"ON {IN_AREA_SQL} JOIN i ON i.Incident_ID = p.Incident_ID)"
)


_LOCATED_COUNTS = (
    "SELECT DD, FH, FF, FX, code, coalesce(Damage_Type, 'No-Incident') AS Damage_Type, "
    "count(Incident_ID) AS Total_Incidents FROM w JOIN located "
    "ON YYYYMMDD = Incident_Date AND HH = IncStrt_Hour "
    "GROUP BY DD, FH, FF, FX, code, located.Damage_Type"
)


def oracle_sql() -> dict[str, str]:
    label_counts = f"WITH {W}, {I}, {WI}, {LABELS} SELECT * FROM labels"
    nearest = (
        f"WITH p AS ({SCATTERED_SQL}), "
        "best AS (SELECT l.event_id, min((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) AS d2 "
        "FROM p l JOIN p r ON l.event_type <> 'error' AND r.event_type = 'error' "
        "AND NOT (l.x = r.x AND l.y = r.y) GROUP BY l.event_id) "
        "SELECT l.event_id, r.event_id AS Incident_ID, sqrt(d2) AS Distance FROM best JOIN p l "
        "ON l.event_id = best.event_id JOIN p r ON r.event_type = 'error' "
        "AND NOT (l.x = r.x AND l.y = r.y) "
        "AND (l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y) = d2"
    )
    training_rows = (
        f"WITH {W}, {I}, {WI}, {LABELS}, {A}, {T}, {_profile('name')}, {CONDITIONS}, {GRID}, "
        f"{LABELLED}, copies AS (SELECT *, unnest(generate_series(1, greatest(Total_Incidents, 1))) AS k "
        "FROM labelled WHERE Total_Incidents IS NOT NULL) "
        f"SELECT name, DD, FH, FF, FX, {_WIDE}, Damage_Type FROM copies"
    )
    _saturated = (
        f"WITH {I}, n AS (SELECT Incident_Date, IncStrt_Hour, Service_Area AS area, "
        "count(Incident_ID) AS Incident_Count FROM i GROUP BY 1, 2, 3), "
        "s AS (SELECT *, ('0x' || substr(md5('42|' || strftime(Incident_Date, '%Y-%m-%d') || '|' || "
        "CAST(IncStrt_Hour AS VARCHAR) || '|' || area), 1, 8))::BIGINT % 1000000 < 800000 AS is_train FROM n), "
        "m AS (SELECT area, avg(Incident_Count) AS mean FROM s WHERE is_train GROUP BY 1), "
        "scored AS (SELECT Incident_Date, IncStrt_Hour, area, Incident_Count, "
        "round(coalesce(mean, 1e0), 5) AS prediction FROM s LEFT JOIN m USING (area) WHERE NOT is_train)"
    )
    return {
        "label_counts": label_counts,
        "label_counts_aligned": label_counts,
        "hourly_align": f"WITH {W}, {I}, {WI} SELECT {_ALIGNED} FROM wi",
        "bucketed_align": f"WITH {W}, {I}, {WI} SELECT {_ALIGNED} FROM wi",
        "hourly_align_utc": (
            f"WITH {W}, {I}, u AS (SELECT *, Incident_Starttime - INTERVAL 1 HOUR AS ut FROM i) "
            f"SELECT {_ALIGNED} FROM w LEFT JOIN u "
            "ON YYYYMMDD = CAST(ut AS DATE) AND HH = hour(ut) + 1"
        ),
        "incident_features": (
            f"WITH {I} SELECT Incident_ID, Incident_Date, IncStrt_Hour, Damage_Type, "
            "Incident_Priority, Incident_Starttime, Service_Area, x, y FROM i"
        ),
        "located_label_counts": f"WITH {W}, {I}, {A}, {_LOCATED} {_LOCATED_COUNTS}",
        "located_label_grid": (
            f"WITH {W}, {I}, {A}, {T}, {_LOCATED}, {_profile('code')}, {CONDITIONS}, "
            f"n AS ({_LOCATED_COUNTS}) SELECT profile.code, DD, FH, FF, FX, {_WIDE}, "
            "coalesce(Damage_Type, 'No-Incident') AS Damage_Type, "
            "coalesce(Total_Incidents, 0) AS Total_Incidents FROM (SELECT * FROM profile CROSS JOIN conds) profile "
            "LEFT JOIN n USING (code, DD, FH, FF, FX)"
        ),
        "incidents_by_hour": (
            f"WITH {W}, {I}, {WI} SELECT YYYYMMDD, HH, Service_Area, Damage_Type, "
            f"{', '.join(WEATHER_MEASURES)}, count(Incident_ID) AS Incident_Count FROM wi GROUP BY ALL"
        ),
        "incidents_by_condition": (
            f"WITH {W}, {I}, {WI} SELECT DD, FH, FF, FX, T, WW, R, S, O, Service_Area, Damage_Type, "
            "count(Incident_ID) AS Incident_Counts FROM wi GROUP BY ALL"
        ),
        "incidents_by_area_hour": (
            f"WITH {I}, {A} SELECT code, Incident_Date, IncStrt_Hour, Damage_Type, "
            f"count(Incident_ID) AS Totaal FROM a JOIN i p ON {IN_AREA_SQL} GROUP BY ALL"
        ),
        "incidents_by_type": (
            f"WITH {I} SELECT Damage_Type, count(Incident_ID) AS Total FROM i GROUP BY ALL"
        ),
        "tree_age": (
            "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS jaarVanAanleg, "
            "CAST(2024 - year(o_orderdate) AS INTEGER) AS leeftijdBoom FROM orders"
        ),
        "parse_dates": (
            "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS ymd, "
            "CAST(o_orderdate AS DATE) AS \"day\", CAST(o_orderkey % 24 AS TINYINT) AS hh, "
            "date_trunc('day', o_orderdate) + to_hours(o_orderkey % 24) AS stamp, "
            "CAST(0 AS INTEGER) AS \"minute\", "
            "strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS stamp_text, "
            "strftime(o_orderdate, '%Y-%m-%d') AS day_text FROM orders"
        ),
        "named_and_listed": (
            "SELECT c_custkey, c_nationkey, c_mktsegment AS segment FROM customer "
            "WHERE c_nationkey IN (1, 4, 9, 16, 23) AND c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD')"
        ),
        "project_and_rename": (
            "SELECT p_partkey, replace(p_name, ' ', '-') AS p_name, p_type, "
            "CAST(p_type <> 'SMALL' AS INTEGER) AS \"is_p_type_NOT-SMALL\" FROM part"
        ),
        "select_variables": (
            f"WITH {W} SELECT CAST(HH % 3 * 20 + 240 AS INTEGER) AS STN, YYYYMMDD, HH, DD, FH, FF, FX, "
            "T, M, R, S, O, Y, WW FROM w WHERE HH % 3 IN (0, 1)"
        ),
        "preview_ordered": f"WITH {W} SELECT YYYYMMDD, HH, DD, FH, FF, FX FROM w ORDER BY YYYYMMDD, HH LIMIT 5",
        "rows_per_segment": "SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY 1",
        "left_join_renamed_key": (
            "SELECT c_custkey, c_acctbal, n_orders FROM customer LEFT JOIN "
            "(SELECT o_custkey + (SELECT max(c_custkey) // 2 FROM customer) AS k, count(*) AS n_orders "
            "FROM orders GROUP BY 1) o ON c_custkey = k"
        ),
        "union_all": "SELECT o_orderkey AS key, o_totalprice AS amount FROM orders "
        "UNION ALL SELECT c_custkey, c_acctbal FROM customer",
        "hash_split": (
            "SELECT o_orderkey, ('0x' || substr(md5('42|' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT "
            "% 1000000 < 800000 AS is_train FROM orders"
        ),
        "reproject_datum": _reproject_datum(),
        "exact_split": (
            f"SELECT o_orderkey, row_number() OVER (ORDER BY {_DRAW.format(key='o_orderkey::VARCHAR')}) > ceil(count(*) OVER () * 0.2) AS is_train "
            "FROM orders"
        ),
        "poisson_trees": (
            f"{_small_trees()} SELECT YYYYMMDD, HH, {', '.join(INDICATORS)}, n_events AS Incident_Count, "
            "round(exp(margin), 6) AS prediction FROM ready JOIN predicted USING (id) WHERE NOT is_train"
        ),
        "poisson_trees_errors": (
            f"{_small_trees()} SELECT round(avg(d * d), 6) AS mse, round(sqrt(avg(d * d)), 6) AS rmse, round(avg(abs(d)), 6) AS mae "
            "FROM (SELECT n_events - exp(margin) AS d FROM ready JOIN predicted USING (id) WHERE NOT is_train) e"
        ),
        "model_importances": (
            f"{_small_trees()}, names AS (SELECT unnest({[*WEATHER_MEASURES, *[f'{c}_{v}' for c, vs in INDICATORS.items() for v in vs]]}) AS Feature, "
            f"unnest(range(0, {len(WEATHER_MEASURES) + sum(map(len, INDICATORS.values()))})) AS f), "
            "g AS (SELECT Feature, coalesce(avg(gain), 0) AS gain FROM names LEFT JOIN splits USING (f) GROUP BY 1) "
            "SELECT Feature, round(gain / sum(gain) OVER (), 9) AS Importance FROM g ORDER BY gain DESC, Feature LIMIT 20"
        ),
        "saturated_model": f"{_saturated} SELECT * FROM scored",
        "saturated_errors": (
            f"{_saturated} SELECT round(avg(d * d), 4) AS mse, round(sqrt(avg(d * d)), 4) AS rmse, "
            "round(avg(abs(d)), 4) AS mae FROM (SELECT Incident_Count - prediction AS d FROM scored) e"
        ),
        "area_profile_long": (
            f"WITH {A}, {T}, j AS (SELECT a.name, p.* FROM a JOIN t p ON {IN_AREA_SQL}) "
            "SELECT name, NULL::VARCHAR AS \"column\", NULL::VARCHAR AS \"value\", count(*) AS n_rows, "
            "count(id) AS n_ids FROM j GROUP BY 1"
            + "".join(
                f" UNION ALL SELECT name, '{c}', {c}, count(*), count(id) FROM j WHERE {c} IS NOT NULL GROUP BY 1, 3"
                for c in TREE_CATEGORIES
            )
        ),
        "sort_descending": f"WITH {W} SELECT YYYYMMDD, HH, DD, FH, FF, FX FROM w ORDER BY YYYYMMDD DESC, HH DESC",
        "top_orders": "SELECT o_orderkey, o_totalprice FROM orders "
        "ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
        "conditions": f"WITH {W}, {CONDITIONS} SELECT * FROM conds",
        "one_hot": (
            f"WITH {I} SELECT Incident_ID, "
            + ", ".join(
                f"CAST(coalesce({c} = '{v}', FALSE) AS INTEGER) AS \"{c}_{v}\"" for c, v in _FLAGS
            )
            + ', CAST(Damage_Type IS NULL AS INTEGER) AS "Damage_Type_null" FROM i'
        ),
        "drop_null_rows": (
            f"WITH {I} SELECT Service_Area, Damage_Type, count(*) AS n FROM i "
            "WHERE Damage_Type IS NOT NULL GROUP BY ALL"
        ),
        "spatial_join": (
            f"WITH {A}, p AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, "
            "round(l_discount * 100) AS y FROM lineitem) "
            f"SELECT code, name, l_orderkey, l_linenumber, x, y FROM a JOIN p ON {IN_AREA_SQL}"
        ),
        "spatial_mixed_sizes": (
            f"WITH {A}, p AS (SELECT l_quantity AS x, round(l_discount * 100) AS y, l_linenumber FROM lineitem), "
            f"b AS (SELECT code, l_linenumber FROM a JOIN p ON {IN_AREA_SQL} UNION ALL "
            "SELECT s_suppkey + 1000, l_linenumber FROM supplier JOIN p ON p.x = s_suppkey * 7 % 50 AND p.y = s_suppkey * 3 % 11) "
            "SELECT CAST(code AS BIGINT) AS code, count(*) AS n_points, CAST(sum(l_linenumber) AS BIGINT) AS sum_line "
            "FROM b GROUP BY 1"
        ),
        "spatial_polygons": _POLYGONS,
        "spatial_polygons_shuffled": _POLYGONS,
        "nearest_incident": nearest,
        "nearest_wkt": (
            f"WITH p AS (SELECT event_id, user_id, x / 8e0 AS x, y / 8e0 AS y FROM ({SCATTERED_SQL}) s), "
            "m AS (SELECT l.event_id, min((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) AS d2 "
            "FROM p l JOIN p r ON NOT (l.x = r.x AND l.y = r.y) GROUP BY 1) "
            "SELECT l.event_id, l.user_id AS user_id_left, printf('POINT (%.16f %.16f)', l.x, l.y) AS geometry, "
            "r.event_id AS other_id, r.user_id AS user_id_right, sqrt(d2) AS Distance FROM m JOIN p l "
            "ON l.event_id = m.event_id JOIN p r ON NOT (l.x = r.x AND l.y = r.y) "
            "AND (l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y) = d2"
        ),
        "nearest_ties": (
            "WITH l AS (SELECT DISTINCT l_quantity AS x, round(l_discount * 100) AS y FROM lineitem), "
            "r AS (SELECT CAST(user_id % 50 AS DOUBLE) AS rx, CAST(user_id % 11 AS DOUBLE) AS ry, "
            "min(event_id) AS Incident_ID, count(*) AS n FROM events GROUP BY 1, 2), "
            "d AS (SELECT *, (x - rx) * (x - rx) + (y - ry) * (y - ry) AS d2 FROM l, r "
            "WHERE NOT (x = rx AND y = ry)) "
            "SELECT x, y, Incident_ID, n, sqrt(d2) AS Distance FROM "
            "(SELECT *, rank() OVER (PARTITION BY x, y ORDER BY d2) AS k FROM d) q WHERE k = 1"
        ),
        "wkt_roundtrip": (
            "SELECT l_orderkey, l_linenumber, "
            "printf('POINT (%.16f %.16f)', l_extendedprice / 1000e0, -l_tax) AS geometry, "
            "l_extendedprice / 1000e0 AS x, -l_tax AS y FROM lineitem"
        ),
        "reproject": _wgs84(
            "SELECT l_orderkey, l_linenumber, l_extendedprice * 0.5e0 + 120000e0 AS rd_x, "
            "l_quantity * 400e0 + 470000e0 AS rd_y FROM lineitem",
            "l_orderkey, l_linenumber, rd_x, rd_y",
        ),
        "area_profile": f"WITH {A}, {T}, {_profile('name')} SELECT * FROM profile",
        "area_profile_by_code": f"WITH {A}, {T}, {_profile('code')} SELECT * FROM profile",
        "pivot_chain": (
            f"WITH {T} SELECT o_orderpriority, count(id) AS Trees_Totaal, "
            + _counts({c: TREE_CATEGORIES[c] for c in ("p_type", "l_returnflag")})
            + " FROM t GROUP BY 1"
        ),
        "condition_grid": (
            f"WITH {W}, {A}, {T}, {_profile('name')}, {CONDITIONS}, {GRID} SELECT * FROM grid"
        ),
        "label_grid": (
            f"WITH {W}, {I}, {WI}, {LABELS}, {A}, {T}, {_profile('name')}, {CONDITIONS}, {GRID}, "
            f"{LABELLED} SELECT * FROM labelled"
        ),
        "training_rows": training_rows,
        "training_rows_labelled": training_rows,
        "training_parts": (
            f"WITH {W}, {I}, {WI}, {LABELS}, "
            "copies AS (SELECT *, unnest(generate_series(1, greatest(Total_Incidents, 1))) AS k FROM labels) "
            "SELECT DD, FH, FF, FX, Damage_Type FROM copies"
        ),
        "table_profile": _profile_rows(),
        "date_coverage": (
            f"WITH {W} SELECT min(YYYYMMDD) AS min_value, max(YYYYMMDD) AS max_value FROM w"
        ),
        "null_counts": f"WITH {W}, {I}, {WI} " + _null_rows("wi", _ALIGNED.split(", ")),
        "error_metrics": (
            "SELECT round(avg(d * d), 6) AS mse, round(sqrt(avg(d * d)), 6) AS rmse, "
            "round(avg(abs(d)), 6) AS mae FROM "
            "(SELECT l_extendedprice / 1000e0 - l_quantity AS d FROM lineitem) e"
        ),
        "fetch_windows": (
            'WITH s AS (SELECT o_custkey, min(o_orderdate) AS "start", max(o_orderdate) AS "end" '
            "FROM orders GROUP BY 1), "
            "k AS (SELECT *, unnest(generate_series(\"start\", \"end\", INTERVAL 180 DAY)) AS window_start FROM s), "
            "e AS (SELECT *, least(window_start + INTERVAL 180 DAY, \"end\") AS window_end FROM k "
            "WHERE window_start < \"end\") "
            "SELECT *, strftime(window_start, '%Y%m%d%H') AS start_text, "
            "strftime(window_end, '%Y%m%d%H') AS end_text FROM e"
        ),
        "page_plan": (
            "WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) "
            "SELECT o_custkey, n, page, (page - 2) // 3 AS chunk "
            "FROM (SELECT *, unnest(generate_series(2, CAST(ceil(n / 4) AS BIGINT))) AS page FROM n) p"
        ),
        "missing_pages": (
            "WITH g AS (SELECT CAST(o_orderkey // 10 + 1 AS INTEGER) AS page, max(o_totalprice) AS top "
            "FROM orders GROUP BY 1), "
            "k AS (SELECT unnest(generate_series(2, (SELECT max(page) FROM g))) AS page) "
            "SELECT CAST(page AS BIGINT) AS page, CAST((page - 2) // 20 AS BIGINT) AS chunk FROM k "
            "WHERE page NOT IN (SELECT page FROM g WHERE top < 490000)"
        ),
        "weather_text_scan": f"WITH {W} SELECT * REPLACE (CAST(HH AS TINYINT) AS HH) FROM w",
        "weather_mixed_folder": f"WITH {W} SELECT * REPLACE (CAST(HH AS TINYINT) AS HH) FROM w",
        "weather_mixed_headers": f"WITH {W} SELECT * REPLACE (CAST(HH AS TINYINT) AS HH) FROM w",
        "feature_pages_with_bad_ones": (
            "SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS segment, c_acctbal AS balance, "
            "printf('POINT (%.16f %.16f)', c_acctbal / 100, c_custkey / 8) AS geometry "
            f"FROM customer WHERE (c_custkey // {BAD_PAGE_SIZE} + 1) % 4 <> 3"
        ),
        "weather_json_scan": f"WITH {W} SELECT * REPLACE (CAST(HH AS TINYINT) AS HH) FROM w",
        "incident_csv_scan": (
            f"WITH {I} SELECT Incident_ID, Incident_Starttime, Service_Area, Damage_Type, "
            "printf('POINT (%.16f %.16f)', x / 10, y / 10) AS geometry, Incident_Date FROM i"
        ),
        "plain_csv_scan": "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "service_area_scan": _wgs84(
            "SELECT c_custkey, CAST(c_custkey % 50000 + 100000 AS DOUBLE) AS rd_x, "
            "CAST(c_custkey * 7 % 90000 + 420000 AS DOUBLE) AS rd_y FROM customer",
            "c_custkey",
        ),
        "feature_pages": (
            "SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS segment, c_acctbal AS balance, "
            "printf('POINT (%.16f %.16f)', c_acctbal / 100, c_custkey / 8) AS geometry "
            "FROM customer"
        ),
        "feature_document": (
            "SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS segment, c_acctbal AS balance, "
            "printf('POINT (%.16f %.16f)', c_acctbal / 100, c_custkey / 8) AS geometry "
            "FROM customer"
        ),
        "area_features": (
            "SELECT 'WK' || CAST(s_suppkey AS VARCHAR) AS wijkcode, s_name AS wijknaam, "
            "'M' || CAST(s_nationkey AS VARCHAR) AS gemeentenaam, "
            f"printf('POLYGON (({_SQUARE_WKT}))', {_SQUARE_ARGS}) AS geometry FROM supplier "
            "WHERE s_acctbal >= 1000 AND s_nationkey IN (1, 4, 9, 16, 20, 23)"
        ),
        "written_profile": (
            f"WITH {I}, k AS (SELECT * FROM i WHERE Damage_Type IS NOT NULL OR x > 9), p AS ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", '{m}' AS metric, {sql.format(c=c)}::DOUBLE AS v FROM k"
                for c in ("Incident_ID", "Incident_Priority", "x", "y")
                for m, sql in {"count": "count({c})", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}.items()
            )
            + "".join(
                f" UNION ALL SELECT '{c}', 'nulls', (count(*) - count({c}))::DOUBLE FROM k"
                for c in ("Incident_ID", "Incident_Date", "Damage_Type", "Incident_Priority", "x", "y")
            )
            + "".join(
                f" UNION ALL SELECT 'Incident_Date', '{m}', ({f}(Incident_Date) - DATE '1970-01-01')::DOUBLE FROM k"
                for m, f in (("first_day", "min"), ("last_day", "max"))
            )
            + " UNION ALL SELECT '*', 'n_rows', count(*)::DOUBLE FROM k UNION ALL SELECT '*', 'n_columns', 6e0) "
            "SELECT \"column\", metric, round(v, 6) AS \"value\" FROM p"
        ),
        "catalog_tables": (
            f"WITH {I} SELECT 'incidents' AS table_name, \"column\", \"type\", nulls FROM ("
            + _null_rows("i", ["Incident_ID", "Incident_Date", "Damage_Type"])
            + ") n JOIN (VALUES ('Incident_ID', 'bigint'), ('Incident_Date', 'date'), "
            "('Damage_Type', 'string')) v(\"column\", \"type\") USING (\"column\")"
        ),
    }
