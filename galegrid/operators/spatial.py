"""Point-in-area join on a grid: an equi join on cells, then an exact test.

Areas are cut into the grid cells their bounding box meets. A cell that no edge touches is
wholly inside or outside, so only border cells carry edges and need the exact test. Areas of
very different size use coarser or finer grid levels: no area has more than about SPAN**2
cells, and the cells of a small one are not much larger than itself.

Areas with very many edges are rasterised by edges instead: edges, not areas, are dealt to the
cells they cross, a level finer, and what lies to the right of a cell comes down to parities.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.columns import clashing, quoted
from ..session import cut_lineage
from .skew import BROADCAST_BYTES, fits, salted_join

CELLS_PER_AREA = 8
SPAN = 32
# Levels are multiples of this, so that areas of similar size share one.
LEVEL_STEP = 3
SLOTS = 8
# Areas with more edges are rasterised by edges, on cells that are LEVEL_STEP doublings smaller.
MANY_EDGES = 4096
# Columns of an edge slot and where they come from; NaN marks an empty slot.
_SLOT = {
    "x1": "e.x1",
    "y1": "e.y1",
    "x2": "e.x2",
    "y2": "e.y2",
    "left": "least(e.x1, e.x2)",
    "right": "greatest(e.x1, e.x2)",
}
CELL_KEYS = ["_level", "_cx", "_cy"]


@dataclass(frozen=True)
class Grid:
    """Cell size of level 0, the levels in use, the box around all areas, and whether any has many edges."""

    size: float
    levels: tuple[int, ...]
    box: tuple[float, float, float, float] | None
    many: bool = True


def _extent(box: Column) -> Column:
    return F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])


def _exponent(box: Column) -> Column:
    """Power of two that holds the larger side of a box; null for a box without extent."""
    return F.ceil(F.log2(_extent(box))).cast("int")


def _reach(framed_all: Column, box: Column) -> Column:
    """The exponent that decides the level: areas of many edges get smaller cells."""
    return _exponent(box) - F.when(F.size(framed_all) > MANY_EDGES, LEVEL_STEP).otherwise(0)


def _base_exponent(size: float) -> int:
    """Exponent of the widest box that level 0 cells of this size may cover."""
    return math.floor(math.log2(size * SPAN))


def _level(reach: Column, size: float) -> Column:
    """Doublings (or halvings) of the cell size until the box spans about SPAN cells or fewer."""
    steps = F.ceil((reach - _base_exponent(size)) / F.lit(LEVEL_STEP))
    return F.coalesce(steps * LEVEL_STEP, F.lit(0)).cast("int")


def framed_areas(areas: DataFrame, keys: Sequence[str], edges: str = "edges") -> DataFrame:
    """Area keys, edge list, bounding box and a number; areas without edges take no part.

    Edges made elsewhere are turned so that the lower (then left) end comes first.
    """
    framed = areas.select(*[quoted(k) for k in keys], quoted(edges).alias("_all")).withColumn(
        "_all",
        F.expr(
            "transform(_all, e -> IF(e.y1 > e.y2 OR (e.y1 = e.y2 AND e.x1 > e.x2), "
            "struct(e.x2 AS x1, e.y2 AS y1, e.x1 AS x2, e.y1 AS y2), "
            "struct(e.x1 AS x1, e.y1 AS y1, e.x2 AS x2, e.y2 AS y2)))"
        ),
    )
    boxed = framed.withColumn("_box", geo.bounds(F.col("_all"))).where("_box is not null")
    return boxed.withColumn("_area", F.monotonically_increasing_id())


def measure_grid(framed: DataFrame, cell_size: float | None = None) -> Grid:
    """Pick the grid from framed areas: one aggregate over the area table."""
    row = framed.agg(
        F.percentile_approx(_extent(F.col("_box")), 0.5).alias("typical"),
        F.min("_box.xmin"),
        F.min("_box.ymin"),
        F.max("_box.xmax"),
        F.max("_box.ymax"),
        F.collect_set(_reach(F.col("_all"), F.col("_box"))).alias("exponents"),
        F.bool_or(_extent(F.col("_box")) == 0).alias("flat"),
        F.bool_or(F.size("_all") > MANY_EDGES).alias("many"),
    ).first()
    if row[1] is None:
        return Grid(cell_size or 1.0, (0,), None)
    size = cell_size or (row["typical"] / CELLS_PER_AREA if row["typical"] > 0 else 1.0)
    base = _base_exponent(size)
    # Boxes without extent are on level 0.
    steps = {math.ceil((e - base) / LEVEL_STEP) for e in row["exponents"]}
    levels = {LEVEL_STEP * s for s in steps} | ({0} if row["flat"] else set())
    return Grid(size, tuple(sorted(levels)), tuple(row[1:5]), row["many"])


def area_cells(framed: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """One row per (area, cell): `_whole` cells lie inside, others carry edges to test.

    A border cell carries edges that tell for each of its points whether a ray to the right crosses
    an odd number, and all that can hold a point of the cell. Up to SLOTS edges are laid out in
    plain columns, which Spark compiles; cells with more keep the list in `_more`.
    """
    few = F.size("_all") <= MANY_EDGES
    cells = _cells_by_area(framed.where(few), keys, grid)
    if not grid.many:
        return _laid_out(cells, keys)
    return _laid_out(cells.unionByName(_cells_by_edge(framed.where(~few), keys, grid)), keys)


def _leveled(framed: DataFrame, grid: Grid) -> DataFrame:
    level = _level(_reach(F.col("_all"), F.col("_box")), grid.size)
    return framed.withColumn("_level", level).withColumn("_width", F.expr(f"{grid.size!r}D * pow(2D, _level)"))


# Edge positions in cell numbers; floor() is monotone, so no point can fall between.
_SPANNED = (
    "floor(least(e.x1, e.x2) / _width) AS west",
    "floor(greatest(e.x1, e.x2) / _width) AS east",
    "floor(least(e.y1, e.y2) / _width) AS south",
    "floor(greatest(e.y1, e.y2) / _width) AS north",
)


def _cells_by_area(framed: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Cells of areas whose edge list is filtered for each row of cells, then for each cell.

    A cell keeps the edges that meet its row band and do not end left of it.
    """
    banded = (
        _leveled(framed, grid)
        .withColumn("_all", F.expr(f"transform(_all, e -> struct(e.x1, e.y1, e.x2, e.y2, {', '.join(_SPANNED)}))"))
        .withColumn("_cy", F.expr("explode(sequence(floor(_box.ymin / _width), floor(_box.ymax / _width)))"))
        .withColumn("_all", F.expr("filter(_all, e -> _cy BETWEEN e.south AND e.north)"))
    )
    cells = (
        banded.withColumn(
            "_cx", F.expr("explode(sequence(floor(_box.xmin / _width), floor(_box.xmax / _width)))")
        )
        .withColumn("_all", F.expr("filter(_all, e -> e.east >= _cx)"))
        .withColumn("_border", F.expr("exists(_all, e -> e.west <= _cx)"))
    )
    inside = geo.covers("_all", "((_cx + 0.5D) * _width)", "((_cy + 0.5D) * _width)")
    kept = cells.withColumn("_whole", ~F.col("_border") & inside).where("_whole OR _border")
    edges = F.expr("transform(_all, e -> struct(e.x1, e.y1, e.x2, e.y2))").alias("_all")
    return kept.select(*[quoted(k) for k in keys], *CELL_KEYS, "_whole", "_border", edges)


def _cells_by_edge(framed: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Cells of areas with very many edges: each edge goes to the cells of its own box.

    Of the edges that lie right of a cell only the number a ray crosses counts, modulo two: an edge
    is crossed where just one of its ends is not above the point. Ends of two such edges that meet
    cancel each other, so what remains of a cell's right side are the few heights at which the
    outline passes from the cell's own columns to those right of them, and one parity for what
    begins below the row. Both become upright edges beyond the cell's right side.

    Cells without edges lie inside where the number of edges right of them that pass the middle of
    the row is odd. No list holds more than a cell's own edges, or a row's columns.
    """
    named = [F.col(f"_key{k}") for k in range(len(keys))]
    renamed = [quoted(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    leveled = _leveled(framed.select(*renamed, "_area", "_box", "_all"), grid)
    area = [*named, F.col("_area"), F.col("_level"), F.col("_width")]
    edges = leveled.select(*area, F.explode("_all").alias("e"))
    spanned = edges.selectExpr("*", *_SPANNED)
    in_rows = spanned.withColumn("_cy", F.expr("explode(sequence(south, north))"))
    row = [*area, F.col("_cy")]

    # What lies right of a column: parities by the westernmost column of the edges.
    middle = "(_cy + 0.5D) * _width"
    columns = in_rows.groupBy(*row, "west").agg(
        (F.count_if(F.col("south") < F.col("_cy")) % 2).alias("below"),
        (F.count_if(F.expr(f"e.y1 <= {middle} AND {middle} < e.y2")) % 2).alias("middle"),
    )
    parities = columns.groupBy("_area", "_cy").agg(
        *[F.collect_list(F.when(F.col(c) == 1, F.col("west"))).alias(f"_{c}") for c in ("below", "middle")]
    )

    # Heights where an odd number of ends is right of a column, as ranges of columns.
    ends = in_rows.select(
        *row, "west", F.explode(F.expr("filter(array(IF(south = _cy, e.y1, NULL), IF(north = _cy, e.y2, NULL)), y -> y IS NOT NULL)")).alias("t")
    )
    odd = ends.groupBy(*row, "t", "west").agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1")
    stacked = odd.groupBy(*row, "t").agg(F.sort_array(F.collect_list("west"), asc=False).alias("w"))
    ranges = stacked.withColumn("r", F.expr("explode(sequence(0, size(w) - 1, 2))"))
    # an outline that is not closed leaves a range without an end: down to the row's first column
    passed = ranges.join(leveled.select("_area", F.expr("floor(_box.xmin / _width)").alias("first")), "_area").select(
        *row, F.expr("explode(sequence(least(coalesce(get(w, r + 1), first), w[r] - 1), w[r] - 1))").alias("_cx"),
        F.lit(None).cast(edges.schema["e"].dataType).alias("e"), "t",
    )
    own = in_rows.select(*row, F.expr("explode(sequence(west, east))").alias("_cx"), "e", F.lit(None).cast("double").alias("t"))
    border = (
        own.unionByName(passed)
        .groupBy(*row, "_cx")
        .agg(F.collect_list("e").alias("_all"), F.collect_list("t").alias("_heights"))
        .where(F.size("_all") > 0)
    )
    border = cut_lineage(border)
    beyond = "(_cx + 2) * _width AS x{k}"
    upright = "struct({x1}, {y1} AS y1, {x2}, (_cy + 2) * _width AS y2)"
    at = {"x1": beyond.format(k=1), "x2": beyond.format(k=2)}
    all_edges = (
        f"concat(transform(_all, e -> struct(e.x1, e.y1, e.x2, e.y2)), transform(_heights, t -> {upright.format(y1='t', **at)}), "
        f"IF(size(filter(coalesce(_below, array()), w -> w > _cx)) % 2 = 1, array({upright.format(y1='(_cy - 1) * _width', **at)}), array()))"
    )
    bordered = border.join(parities.select("_area", "_cy", "_below"), ["_area", "_cy"], "left").select(
        *named, *CELL_KEYS, F.lit(False).alias("_whole"), F.lit(True).alias("_border"), F.expr(all_edges).alias("_all")
    )

    taken = border.groupBy("_area", "_cy").agg(F.collect_list("_cx").alias("_taken"))
    spans = leveled.select(*named, "_area", "_level", F.expr("floor(_box.xmin / _width)").alias("first"), F.expr("floor(_box.xmax / _width)").alias("last"),
                           F.expr("explode(sequence(floor(_box.ymin / _width), floor(_box.ymax / _width)))").alias("_cy"))
    free = spans.join(parities.select("_area", "_cy", "_middle"), ["_area", "_cy"]).join(taken, ["_area", "_cy"], "left")
    inside = free.withColumn("_cx", F.expr("explode(array_except(sequence(first, last), coalesce(_taken, array())))")).where(
        "size(filter(_middle, w -> w > _cx)) % 2 = 1"
    )
    whole = inside.select(
        *named, *CELL_KEYS, F.lit(True).alias("_whole"), F.lit(False).alias("_border"), F.expr("filter(array(struct(0D AS x1, 0D AS y1, 0D AS x2, 0D AS y2)), e -> false)").alias("_all")
    )
    return bordered.unionByName(whole).withColumnsRenamed({f"_key{i}": k for i, k in enumerate(keys)})


def _laid_out(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells with their edges in slots, or in `_more`."""
    slots = [
        f"IF(_border AND size(_all) <= {SLOTS}, {rule.replace('e.', f'get(_all, {k}).')}, NULL) AS _{c}_{k}"
        for k in range(SLOTS)
        for c, rule in _SLOT.items()
    ]
    more = f"IF(_border AND size(_all) > {SLOTS}, _all, NULL) AS _more"
    return cells.select(*[quoted(k) for k in keys], *CELL_KEYS, "_whole", *[F.expr(e) for e in [*slots, more]])


def _filled_slots(cells: DataFrame) -> DataFrame:
    """Cells whose edge slots are never null, which spares the compiled test its null checks."""
    names = [f"_{c}_{k}" for k in range(SLOTS) for c in _SLOT]
    filled = {n: F.coalesce(F.col(n), F.lit(float("nan"))) for n in names}
    return cells.withColumns({**filled, "_whole": F.coalesce("_whole", F.lit(False))})


def _inside_cell(x: str, y: str) -> Column:
    """Exact test of a point against the edges its cell carries."""
    codes = [geo.edge_code_sql(x, y, *[f"_{c}_{k}" for c in _SLOT]) for k in range(SLOTS)]
    # A list of the sums that mean inside, so that the sum is computed once.
    hits = [n for n in range(SLOTS + 1) if n % 2] + [
        border * geo.ON_BORDER + crossed
        for border in range(1, SLOTS + 1)
        for crossed in range(SLOTS + 1 - border)
    ]
    compiled = F.expr(f"({' + '.join(codes)}) IN ({', '.join(map(str, hits))})")
    listed = geo.covers("_more", x, y)
    return F.col("_whole") | F.when(F.col("_more").isNull(), compiled).otherwise(listed)


def point_cells(points: DataFrame, grid: Grid, x: str = "x", y: str = "y") -> DataFrame:
    """Points inside the box of all areas with their cell, once per grid level in use."""
    if grid.box is None:
        inside = points.where(F.lit(False))
    else:
        xmin, ymin, xmax, ymax = grid.box
        inside = points.where(
            quoted(x).between(float(xmin), float(xmax)) & quoted(y).between(float(ymin), float(ymax))
        )
    if len(grid.levels) == 1:
        leveled = inside.withColumn("_level", F.lit(grid.levels[0]))
    else:
        leveled = inside.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in grid.levels])))
    width = F.expr(f"{grid.size!r}D * pow(2D, _level)")
    return leveled.withColumns(
        {
            "_cx": F.floor(quoted(x).cast("double") / width),
            "_cy": F.floor(quoted(y).cast("double") / width),
        }
    )


def points_in_areas(
    areas: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    x: str = "x",
    y: str = "y",
    edges: str = "edges",
    cell_size: float | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of areas and the points that intersect them, border points included.

    Output: the area `keys`, then the point columns. Clashing point columns get the suffix
    `_right` and area keys `_left`. Areas measured to fit are broadcast, so points are not
    shuffled, or else points that fit; two large tables join on the cell with crowded cells split.
    """
    keys = list(keys)
    area_clash, point_clash = clashing(keys, points.columns), clashing(points.columns, keys)
    areas = areas.withColumnsRenamed({c: f"{c}_left" for c in area_clash})
    points = points.withColumnsRenamed({c: f"{c}_right" for c in point_clash})
    keys = [f"{c}_left" if c in area_clash else c for c in keys]
    x, y = (f"{c}_right" if c in point_clash else c for c in (x, y))

    framed = cut_lineage(framed_areas(areas, keys, edges))
    grid = measure_grid(framed, cell_size)
    # Small files make many cells: they are dealt out to all cores.
    dealt = framed.repartition(framed.sparkSession.sparkContext.defaultParallelism, "_area")
    cells = cut_lineage(area_cells(dealt, keys, grid))
    located = point_cells(points, grid, x, y)
    ready = _filled_slots(cells)
    if fits(ready, max_bytes):
        joined = located.join(F.broadcast(ready), CELL_KEYS)
    else:
        occupied = cells.select(*CELL_KEYS).distinct()
        if len(grid.levels) > 1 and fits(occupied, max_bytes):
            # Copies of a point on levels without an area there are not shuffled.
            located = located.join(F.broadcast(occupied), CELL_KEYS, "left_semi")
        if fits(located, max_bytes):
            joined = ready.join(F.broadcast(located), CELL_KEYS)
        else:
            joined = salted_join(located, ready, CELL_KEYS, spread=points.columns, shuffled=True)
    px, py = (f"CAST(`{c.replace('`', '``')}` AS DOUBLE)" for c in (x, y))
    return joined.where(_inside_cell(px, py)).select(*[quoted(c) for c in [*keys, *points.columns]])
