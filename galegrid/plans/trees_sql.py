"""SQL that repeats the boosted trees of `operators.boosting` round by round."""

from __future__ import annotations

from collections.abc import Sequence

STEP, UNIT, LEAST_GAIN = "0.7::DOUBLE", "1048576::DOUBLE", "1e-6::DOUBLE"


def _step(g: str, h: str) -> str:
    return f"greatest(least(-({g}) / (({h}) + 1::DOUBLE), {STEP}), -{STEP})"


def _gain(g: str, h: str) -> str:
    w = _step(g, h)
    return f"-(2::DOUBLE * ({g}) * {w} + (({h}) + 1::DOUBLE) * {w} * {w})"


def trees(rows: str, features: Sequence[str], rounds: int, max_depth: int, max_bins: int, rate: float = 0.3) -> str:
    """CTEs over `rows` (id, is_train, n_events and the features): `predicted` (id, margin) and `splits`.

    `splits` has a row (round, f, gain) for each split that was made. Penalty and least hessian are 1.
    """
    long = ", ".join(f"{{'f': {k}, 'v': \"{c}\"::DOUBLE}}" for k, c in enumerate(features))
    ctes = [
        f"long AS MATERIALIZED (SELECT id, is_train, n_events AS y, unnest([{long}], recursive := true) FROM {rows})",
        "ranked AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS r, count(*) OVER (PARTITION BY f) AS n, "
        "min(v) OVER (PARTITION BY f) AS low, max(v) OVER (PARTITION BY f) AS high FROM long WHERE is_train AND v IS NOT NULL)",
        "edges AS MATERIALIZED (SELECT DISTINCT f, v FROM ranked WHERE v > low AND (v = high OR r IN "
        f"(SELECT ceil(k::DOUBLE / {max_bins} * n)::BIGINT FROM range(1, {max_bins}) q(k))))",
        "cut AS MATERIALIZED (SELECT id, is_train, y, f, CASE WHEN v IS NULL THEN -1 ELSE "
        "(SELECT count(*) FROM edges e WHERE e.f = long.f AND e.v <= long.v) END AS b FROM long)",
        "whole AS MATERIALIZED (SELECT id, any_value(is_train) AS is_train, any_value(y) AS y, list(b ORDER BY f) AS bins FROM cut GROUP BY id)",
        "grouped AS MATERIALIZED (SELECT row_number() OVER () AS gid, bins, count(*) FILTER (is_train) AS w, "
        "coalesce(sum(y) FILTER (is_train), 0)::BIGINT AS y FROM whole GROUP BY bins)",
        "bin AS MATERIALIZED (SELECT gid, w, unnest(range(0, len(bins))) AS f, unnest(bins) AS b FROM grouped)",
        "m0 AS MATERIALIZED (SELECT gid, (SELECT ln(sum(y)::DOUBLE / sum(w)::DOUBLE) FROM grouped) AS m FROM grouped)",
    ]
    made = []
    for r in range(1, rounds + 1):
        ctes.append(
            f"grad{r} AS MATERIALIZED (SELECT gid, floor((w * exp(m) - y) * {UNIT} + 0.5::DOUBLE)::BIGINT AS g, "
            f"floor(w * exp(m + {STEP}) * {UNIT} + 0.5::DOUBLE)::BIGINT AS h, 1 AS node FROM grouped JOIN m{r - 1} USING (gid))"
        )
        ctes.append(f"at{r}_0 AS (SELECT gid, 1 AS node, NULL::DOUBLE AS leaf FROM grouped)")
        for d in range(max_depth):
            sums = ", ".join(
                f"sum({c}) OVER whole AS all_{c}, coalesce(sum({c}) FILTER (b >= 0) OVER upto, 0) AS low_{c}, "
                f"coalesce(sum({c}) FILTER (b < 0) OVER whole, 0) AS null_{c}"
                for c in "gh"
            )
            side = {
                c: (f"all_{c} / {UNIT}", f"low{c} / {UNIT}", f"(all_{c} - low{c}) / {UNIT}") for c in "gh"
            }
            (g, gl, gr), (h, hl, hr) = side["g"], side["h"]
            gain = f"{_gain(gl, hl)} + {_gain(gr, hr)} - {_gain(g, h)}"
            ctes += [
                f"hist{r}_{d} AS MATERIALIZED (SELECT t.node, f, b, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM at{r}_{d} t "
                f"JOIN grad{r} USING (gid) JOIN bin USING (gid) WHERE t.node IS NOT NULL AND w > 0 GROUP BY ALL)",
                f"told{r}_{d} AS (SELECT node, f, b, {sums} FROM hist{r}_{d} WINDOW whole AS (PARTITION BY node, f), "
                "upto AS (PARTITION BY node, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
                f"both{r}_{d} AS (SELECT *, low_g + CASE WHEN null_left THEN null_g ELSE 0 END AS lowg, "
                f"low_h + CASE WHEN null_left THEN null_h ELSE 0 END AS lowh FROM told{r}_{d}, (VALUES (false), (true)) n(null_left))",
                f"gain{r}_{d} AS (SELECT *, {gain} AS gain, {_step(gl, hl)} AS wl, {_step(gr, hr)} AS wr, {_step(g, h)} AS w, "
                f"b > 0 AND {hl} >= 1 AND {hr} >= 1 AS able FROM both{r}_{d})",
                f"best{r}_{d} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node "
                f"ORDER BY (able AND gain > {LEAST_GAIN}) DESC, gain DESC, f, b, null_left) AS k FROM gain{r}_{d}) WHERE k = 1)",
                f"at{r}_{d + 1} AS MATERIALIZED (SELECT t.gid, "
                f"CASE WHEN able AND gain > {LEAST_GAIN} THEN 2 * t.node + CASE WHEN goes_left THEN 0 ELSE 1 END END AS node, "
                f"CASE WHEN t.node IS NULL THEN leaf WHEN able AND gain > {LEAST_GAIN} THEN {rate}::DOUBLE * CASE WHEN goes_left THEN wl ELSE wr END "
                f"ELSE {rate}::DOUBLE * w END AS leaf FROM (SELECT t.*, s.able, s.gain, s.wl, s.wr, s.w, "
                "CASE WHEN x.b < 0 THEN s.null_left ELSE x.b < s.b END AS goes_left "
                f"FROM at{r}_{d} t LEFT JOIN best{r}_{d} s ON s.node = t.node LEFT JOIN bin x ON x.gid = t.gid AND x.f = s.f) t)",
            ]
            made.append(f"SELECT {r} AS round, f, gain FROM best{r}_{d} WHERE able AND gain > {LEAST_GAIN}")
        ctes.append(f"m{r} AS MATERIALIZED (SELECT gid, m + leaf AS m FROM m{r - 1} JOIN at{r}_{max_depth} USING (gid))")
    ctes.append(f"predicted AS (SELECT id, m AS margin FROM whole JOIN grouped USING (bins) JOIN m{rounds} USING (gid))")
    ctes.append("splits AS (" + " UNION ALL ".join(made) + ")")
    return ", ".join(ctes)
