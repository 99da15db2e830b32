"""Nearest join: for every left point its nearest right point(s), all ties kept.

Equal locations are collapsed first, so a crowded location costs one row. Every location gets its
position in the order of x and in that of y, over both sides, and space is halved by counts: a cell
of `bits` bits holds locations of the same 2^-bits part of the rows along either axis. Depth thus
follows the number of rows, whatever the extent: after log2(rows) halvings no two locations share a
cell, and a stray coordinate takes one position like any other.

Both sides are cut into such cells level by level, and pairs of cells are refined together: a pair
is dropped when even its closest points are farther apart than the farthest points of a better
pair. Cells with few locations stop splitting, so the last join pairs small cells only, and dense
regions cost more levels, not more pairs. Boxes hold the true minima and maxima of their points
and floating-point rounding is monotone, so no tie is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions.columns import clashing, quoted
from ..session import cut_lineage
from .skew import ROWS_PER_TASK, checked_join, hot_keys, join_with_hot_keys

LEAF_ROWS = 32
FIRST_BITS = 4
STEP_BITS = 2
#: Bits of a cell's number; more than positions have, so the last level has one location a cell.
MAX_BITS = 52
#: Bits of monotonically_increasing_id that number the rows of a partition.
PLACE_BITS = 33


def _real(x: str, y: str) -> Column:
    """Points with usable coordinates; empty ones take no part, as in any spatial join."""
    usable = F.lit(True)
    for c in (x, y):
        usable = usable & (F.abs(quoted(c).cast("double")) < float("inf"))
    return usable


def _locations(df: DataFrame, x: str, y: str) -> DataFrame:
    return (
        df.where(_real(x, y))
        .select(quoted(x).cast("double").alias("x"), quoted(y).cast("double").alias("y"))
        .distinct()
    )


def _positions(rows: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """`rows` stored with their position, from 0, in the order of the columns `by`.

    Ranges are dealt out, sorted and numbered where they are; the counts of the ranges before, one
    number for each, are added. Rows that are equal in `by` get an order of their own.
    """
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    stored = cut_lineage(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), replacing=rows)
    part, row = F.shiftrightunsigned("_place", PLACE_BITS), F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
    sizes = dict(map(tuple, stored.groupBy(part.cast("int")).count().collect()))
    before, starts = 0, []
    for number in range(max(sizes, default=0) + 1):
        starts.append(before)
        before += sizes.get(number, 0)
    start = F.get(F.array(*[F.lit(n).cast("bigint") for n in starts]), part.cast("int"))
    placed = stored.select(*rows.columns, (start + row).alias(out))
    placed._staged_path = stored._staged_path
    return placed


def _cell(bits: int | Column, rows: int) -> tuple[Column, Column]:
    """Column and row of the cell at `bits` bits per axis; `rows` is the number of positions."""
    drop = F.lit(MAX_BITS) - bits

    def axis(position: str) -> Column:
        number = F.floor(F.col(position) / F.lit(float(rows)) * F.lit(float(1 << MAX_BITS)))
        return F.call_function("shiftright", number, drop)

    return axis("u"), axis("v")


def _cells(locations: DataFrame, bits: int, rows: int) -> DataFrame:
    """Occupied cells of a level with their number of locations and tight boxes."""
    cx, cy = _cell(bits, rows)
    return locations.groupBy("side", cx.alias("cx"), cy.alias("cy")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("xmin"),
        F.max("x").alias("xmax"),
        F.min("y").alias("ymin"),
        F.max("y").alias("ymax"),
    )


_NODE = ["cx", "cy", "n", "xmin", "xmax", "ymin", "ymax"]
_LEFT_CELL = ["l_level", "l_cx", "l_cy"]
_RIGHT_CELL = ["r_level", "r_cx", "r_cy"]


def _side(nodes: DataFrame, side: str, prefix: str | None = None) -> DataFrame:
    named = [F.col(c).alias(f"{prefix or side}_{c}") for c in _NODE]
    return nodes.where(F.col("side") == side).select(*named)


def _near_far() -> tuple[Column, Column]:
    """Squared smallest and largest possible distance of the two boxes of a pair."""

    def axis(c: str) -> tuple[str, str]:
        gap = f"greatest(r_{c}min - l_{c}max, l_{c}min - r_{c}max, 0D)"
        reach = f"greatest(r_{c}max - l_{c}min, l_{c}max - r_{c}min)"
        return f"{gap} * {gap}", f"{reach} * {reach}"

    (gap_x, reach_x), (gap_y, reach_y) = axis("x"), axis("y")
    return F.expr(f"{gap_x} + {gap_y}"), F.expr(f"{reach_x} + {reach_y}")


def _prune(pairs: DataFrame, exclusive: bool, by: Sequence[str] = tuple(_LEFT_CELL)) -> DataFrame:
    """Keep the pairs that can hold a nearest point of some left point of their left box.

    `best` carries the smallest known bound of the left box over from the box it is part of.
    """
    near, far = _near_far()
    if exclusive:
        # A lone right location may be the left point itself: then it bounds nothing.
        far = F.when((F.col("r_n") > 1) | (near > 0), far)
    bound = F.min(F.least(far, F.col("best"))).over(Window.partitionBy(*by))
    in_reach = "best IS NULL OR near <= best"
    candidates = pairs.withColumn("near", near).where(in_reach)
    return candidates.withColumn("best", bound).where(in_reach).drop("near")


def _full(side: str, level: int) -> Column:
    return (F.col(f"{side}_level") == level) & (F.col(f"{side}_n") > LEAF_ROWS)


def _refine(pairs: DataFrame, side: str, nodes: DataFrame, level: int) -> DataFrame:
    """Replace cells that are still too full by their children on `level`; keep the others."""
    is_full = _full(side, level - 1)
    children = _side(nodes, side, "c").withColumns(
        {f"_up_{c}": F.shiftright(f"c_{c}", STEP_BITS) for c in ("cx", "cy")}
    )
    # Kept cells get a negative key of their own: it matches nothing and spreads well.
    alone = -1 - F.pmod(F.xxhash64(*_LEFT_CELL, *_RIGHT_CELL), F.lit(2**62))
    opened = pairs.withColumns(
        {f"_up_{c}": F.when(is_full, F.col(f"{side}_{c}")).otherwise(alone) for c in ("cx", "cy")}
    ).join(children, ["_up_cx", "_up_cy"], "left")
    replaced = {f"{side}_{c}": F.coalesce(f"c_{c}", f"{side}_{c}") for c in _NODE}
    replaced[f"{side}_level"] = F.when(F.col("c_n").isNotNull(), level).otherwise(
        F.col(f"{side}_level")
    )
    kept = [c for c in pairs.columns if c not in replaced]
    return opened.select(*kept, *[v.alias(k) for k, v in replaced.items()])


def _in_leaves(
    locations: DataFrame, nodes: list[DataFrame], rows: int, side: str
) -> DataFrame:
    """Locations with the cell where splitting stopped.

    The stop level is handed down from level to level over the cell tables; the locations
    themselves join once, on the finest cell, which holds few of them.
    """
    mine = F.col("side") == side
    stops = nodes[0].where(mine).select("cx", "cy", "n", F.lit(0).alias("stop"))
    for finer in nodes[1:]:
        above = stops.select(
            F.col("cx").alias("_ux"),
            F.col("cy").alias("_uy"),
            (F.col("stop") + (F.col("n") > LEAF_ROWS).cast("int")).alias("stop"),
        )
        below = finer.where(mine).select(
            "cx", "cy", "n",
            F.shiftright("cx", STEP_BITS).alias("_ux"), F.shiftright("cy", STEP_BITS).alias("_uy"),
        )
        stops = below.join(above, ["_ux", "_uy"]).select("cx", "cy", "n", "stop")
    finest = FIRST_BITS + STEP_BITS * (len(nodes) - 1)
    cx, cy = _cell(finest, rows)
    stop_cx, stop_cy = _cell(F.lit(FIRST_BITS) + F.lit(STEP_BITS) * F.col("stop"), rows)
    return (
        locations.where(mine)
        .withColumns({"cx": cx, "cy": cy})
        .join(stops.select("cx", "cy", "stop"), ["cx", "cy"])
        .select(
            F.col("x").alias(f"{side}x"),
            F.col("y").alias(f"{side}y"),
            F.col("stop").alias(f"{side}_level"),
            stop_cx.alias(f"{side}_cx"),
            stop_cy.alias(f"{side}_cy"),
        )
    )


def nearest_locations(left: DataFrame, right: DataFrame, exclusive: bool = False) -> DataFrame:
    """Nearest right location(s) `rx, ry` of every left location `x, y`, with squared distance.

    Both inputs hold distinct `x, y` doubles.
    """
    spark = left.sparkSession
    out = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y", "rx", "ry", "d2")])
    both = cut_lineage(
        left.withColumn("side", F.lit("l")).unionByName(right.withColumn("side", F.lit("r")))
    )
    n = both.agg(F.count_if(F.col("side") == "l").alias("l"), F.count_if(F.col("side") == "r").alias("r")).first()
    if not n["l"] or not n["r"]:
        return spark.createDataFrame([], out)
    rows = n["l"] + n["r"]
    both = _positions(_positions(both, ["x", "y"], "u"), ["y", "x"], "v")

    levels: list[DataFrame] = []
    for bits in range(FIRST_BITS, MAX_BITS + 1, STEP_BITS):
        levels.append(cut_lineage(_cells(both, bits, rows)))
        # With more locations than all cells could hold, some cell is too full: look no further.
        surely_full = max(n["l"], n["r"]) > LEAF_ROWS * 4**bits
        if not surely_full and levels[-1].agg(F.max("n")).first()[0] <= LEAF_ROWS:
            break

    # At most 256 x 256 first cells, paired through one common key.
    pairs = _side(levels[0], "l").withColumn("_root", F.lit(0)).join(
        _side(levels[0], "r").withColumn("_root", F.lit(0)), "_root"
    )
    start = {"l_level": F.lit(0), "r_level": F.lit(0), "best": F.lit(None).cast("double")}
    pairs = _prune(pairs.drop("_root").withColumns(start), exclusive)
    # Pairs of two leaves are set aside, so a round works on the crowded regions only.
    settled: list[DataFrame] = []
    for level in range(1, len(levels)):
        pairs = cut_lineage(pairs)
        open_pair = _full("l", level - 1) | _full("r", level - 1)
        settled.append(pairs.where(~open_pair))
        pairs = _refine(pairs.where(open_pair), "l", levels[level], level)
        pairs = _prune(_refine(pairs, "r", levels[level], level), exclusive)
    for done in settled:
        pairs = pairs.unionByName(done)
    pairs = cut_lineage(pairs)

    lefts, rights = (_in_leaves(both, levels, rows, s) for s in ("l", "r"))
    right_box = [f"r_{c}" for c in ("level", *_NODE)]
    # Every left location against the boxes of the right leaves, before their points.
    spots = pairs.select(*_LEFT_CELL, *right_box, "best").join(lefts, _LEFT_CELL)
    spots = spots.withColumns(
        {"l_xmin": F.col("lx"), "l_xmax": F.col("lx"), "l_ymin": F.col("ly"), "l_ymax": F.col("ly")}
    )
    spots = _prune(spots, exclusive, [*_LEFT_CELL, "lx", "ly"])
    # A lonely right leaf may be the nearest of very many left locations: split those.
    crowded = hot_keys(pairs, _RIGHT_CELL, ROWS_PER_TASK, weight="l_n")
    # The locations of a right leaf, LEAF_ROWS at most, meet a left one as lists: what is dealt anew
    # is the nearest of each leaf, not every pair of locations.
    spot = F.sort_array(F.collect_list(F.struct("rx", "ry")))
    leaves = rights.groupBy(*_RIGHT_CELL).agg(spot.alias("spots")).select(
        *_RIGHT_CELL, F.col("spots.rx").alias("xs"), F.col("spots.ry").alias("ys")
    )
    candidates = join_with_hot_keys(
        spots.select("lx", "ly", *_RIGHT_CELL), leaves, _RIGHT_CELL, ["lx", "ly"], crowded
    )

    def measured(rx: Column, ry: Column) -> Column:
        d2 = geo.squared_distance(F.col("lx"), F.col("ly"), rx, ry)
        return F.when(~((rx == F.col("lx")) & (ry == F.col("ly"))), d2) if exclusive else d2

    # Columns of their own, as each is used several times; one without a distance is dropped at last.
    found = candidates.select("lx", "ly", "xs", "ys", F.zip_with("xs", "ys", measured).alias("d"))
    found = found.withColumn("least", F.array_min("d"))
    found = found.withColumn("at", F.expr("array_position(d, least)").cast("int"))
    lone = F.expr("NOT exists(slice(d, at + 1, size(d)), v -> v = least)")
    ties = F.expr("filter(arrays_zip(xs, ys, d), s -> s.d = least)")
    spot_of = "named_struct('rx', xs[at - 1], 'ry', ys[at - 1])"
    nearest = found.select(
        "lx", "ly", "least", F.when(F.col("at") > 0, F.when(lone, F.expr(f"array({spot_of})")).otherwise(
            F.transform(ties, lambda s: F.struct(s["xs"].alias("rx"), s["ys"].alias("ry")))
        )).alias("spots"),
    )
    ranked = nearest.withColumn("_min", F.min("least").over(Window.partitionBy("lx", "ly")))
    return ranked.where("least = _min").select(
        F.col("lx").alias("x"), F.col("ly").alias("y"), F.inline("spots"), F.col("least").alias("d2")
    )


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    left_xy: tuple[str, str] = ("x", "y"),
    right_xy: tuple[str, str] = ("x", "y"),
    distance_col: str = "Distance",
    exclusive: bool = False,
    max_distance: float | None = None,
) -> DataFrame:
    """Inner nearest join: left columns, right columns without coordinates, the distance.

    `exclusive` ignores right points equal to the left one. Clashing names get `_left` and
    `_right`. Distances are planar, in the unit of the coordinates.
    """
    drop_right = set(right_xy)
    kept_right = [c for c in right.columns if c not in drop_right]
    left_clash, right_clash = clashing(left.columns, kept_right), clashing(kept_right, left.columns)
    pairs = nearest_locations(_locations(left, *left_xy), _locations(right, *right_xy), exclusive)
    if max_distance is not None:
        pairs = pairs.where(F.sqrt("d2") <= F.lit(max_distance))
    pairs = cut_lineage(
        pairs.select(
            F.col("x").alias("_lx"), F.col("y").alias("_ly"),
            F.col("rx").alias("_rx"), F.col("ry").alias("_ry"),
            F.sqrt("d2").alias("_distance"),
        )
    )

    def keyed(df: DataFrame, xy: tuple[str, str], names: tuple[str, str]) -> DataFrame:
        return df.where(_real(*xy)).withColumns(
            {names[0]: quoted(xy[0]).cast("double"), names[1]: quoted(xy[1]).cast("double")}
        )

    left_rows = keyed(left, left_xy, ("_lx", "_ly")).withColumnsRenamed(
        {c: f"{c}_left" for c in left_clash}
    )
    right_rows = keyed(right, right_xy, ("_rx", "_ry")).drop(*right_xy).withColumnsRenamed(
        {c: f"{c}_right" for c in right_clash}
    )
    matched = checked_join(left_rows, pairs, ["_lx", "_ly"], spread=left_rows.columns)
    joined = checked_join(matched, right_rows, ["_rx", "_ry"], spread=left_rows.columns)
    left_out = [f"{c}_left" if c in left_clash else c for c in left.columns]
    right_out = [f"{c}_right" if c in right_clash else c for c in kept_right]
    return joined.select(
        *[quoted(c) for c in [*left_out, *right_out]], F.col("_distance").alias(distance_col)
    )


def nearest_features(
    left: DataFrame,
    right: DataFrame,
    geometry: str = "geometry",
    distance_col: str = "Distance",
    exclusive: bool = True,
) -> DataFrame:
    """The nearest join of two tables with WKT points: left geometry kept, right one dropped."""
    spots = ("_x", "_y")
    located = geo.with_points(left, geometry, *spots)
    others = geo.with_points(right, geometry, *spots).drop(geometry)
    return nearest_join(located, others, spots, spots, distance_col, exclusive).drop(*spots)
