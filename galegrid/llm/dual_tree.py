"""Exact top-k inner-product search by dual-tree traversal of cover trees.

Queries and data are both indexed. Points are dealt to their nearest pivot (a bounded number of
points, taken by a hash) and each pivot's points, in parts of bounded size, become a cover tree:
the children of a node cover its points by half its radius, and each node knows the true radius
that covers what lies below it. A pair of a query node and a data node is bounded by

    <q, d> + rq * |d| + rd * |q| + rq * rd

with their centres and covering radii, and is pruned when that is below the worst k-th score of
the query group. First each query block is searched in the blocks nearest to it, which gives the
k-th scores; then block pairs are pruned as a whole, and the rest is searched node by node. No
point is sampled away and no candidate list is cut.

Equal vectors are one point with its k + 1 least ids, kept before the shuffle; a vector that
very many rows share costs no more than another. Queries with equal vectors are searched once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import checked_join
from ..session import cut_lineage

#: Points of a data block and of a query block, about; they are dealt by hash.
DATA_BLOCK, QUERY_BLOCK = 2048, 256
MAX_PIVOTS = 256
LEAF = 64
#: Nearest data blocks that give a query block its first k-th scores.
FIRST_BLOCKS = 2
_SLOTS = 32
_EXACT = float(1 << 53)


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as a double; null where the vector takes no part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return F.when(vector.isNotNull() & finite, whole)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < _EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a.astype(np.int64) @ b.astype(np.int64).T


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and the nodes: start, stop, centre, radius, first child, children.

    Points of a node lie together in that order; the centre is a place in it.
    """
    x = points.astype(np.float64)

    def away(rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((x[rows] - x[centre]) ** 2).sum(axis=1))

    nodes: list[list[float]] = [[0, len(x), 0, 0, 0, 0]]
    parts = [np.arange(len(x))]
    centres = [0]
    order = np.empty(len(x), np.int64)
    at = 0
    while at < len(nodes):
        rows, centre = parts[at], centres[at]
        distance = away(rows, centre)
        radius = float(distance.max(initial=0.0))
        start = int(nodes[at][0])
        groups: list[tuple[int, np.ndarray]] = []
        if len(rows) > leaf and radius > 0:
            rest, near = rows, centre
            gap = distance
            while len(rest) and len(groups) <= len(rows) // 8:
                inside = gap <= radius / 2
                groups.append((near, rest[inside]))
                rest = rest[~inside]
                if len(rest):
                    near = int(rest[0])
                    gap = away(rest, near)
            if len(rest):  # hardly any point is near another: leaves by distance from the centre
                ordered = rows[np.argsort(distance, kind="stable")]
                cut = [ordered[i : i + leaf] for i in range(0, len(ordered), leaf)]
                groups = [(int(part[len(part) // 2]), part) for part in cut]
        nodes[at][3], nodes[at][4], nodes[at][5] = radius, len(nodes), len(groups)
        if not groups:
            order[start : start + len(rows)] = rows
        for near, part in groups:
            nodes.append([start, start + len(part), 0, 0, 0, 0])
            parts.append(part)
            centres.append(near)
            start += len(part)
        at += 1
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    table = np.array(nodes, np.float64)
    table[:, 2] = place[centres]
    return order, table


class Tree:
    """A cover tree as a block carries it."""

    def __init__(self, vectors: bytes, nodes: bytes, width: int):
        self.vectors = np.frombuffer(vectors, np.int64).reshape(-1, width)
        table = np.frombuffer(nodes, np.float64).reshape(-1, 6)
        self.start, self.stop, self.centre, self.child, self.children = (
            table[:, i].astype(np.int64).tolist() for i in (0, 1, 2, 4, 5)
        )
        self.radius = table[:, 3].tolist()
        self.x = self.vectors.astype(np.float64)
        self.norm = np.sqrt((self.x**2).sum(axis=1)).tolist()


def bound(dot: float, rq: float, nq: float, rd: float, nd: float) -> float:
    """No inner product of points covered by the two nodes is above; with room for rounding."""
    value = dot + rq * nd + rd * nq + rq * rd
    return value + 1e-9 * (abs(dot) + (rq + nq) * (rd + nd)) + 1e-6


def search(queries: Tree, data: Tree, least_ids: np.ndarray, worst: np.ndarray, k: int):
    """Per query the places of its best k points, score descending, then least id.

    `worst` is the score that a query's k-th best had before; lower ones are of no use.
    """
    n = len(queries.vectors)
    best: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    worst = worst.astype(np.float64).copy()

    def value(a: int, b: int) -> float:
        q, d = queries.centre[a], data.centre[b]
        dot = float(queries.x[q] @ data.x[d])
        return bound(dot, queries.radius[a], queries.norm[q], data.radius[b], data.norm[d])

    todo = [(value(0, 0), 0, 0)]
    while todo:
        top, a, b = todo.pop()
        lo, hi = queries.start[a], queries.stop[a]
        if top < worst[lo:hi].min():
            continue
        if not queries.children[a] and not data.children[b]:
            first, last = data.start[b], data.stop[b]
            found = scores(queries.vectors[lo:hi], data.vectors[first:last])
            for i in np.flatnonzero((found >= worst[lo:hi, None]).any(axis=1)):
                row = found[i]
                useful = np.flatnonzero(row >= worst[lo + i])
                mine = best[lo + i]
                mine += [(-int(row[j]), int(least_ids[first + j]), int(first + j)) for j in useful]
                mine.sort()
                del mine[k:]
                if len(mine) == k:
                    worst[lo + i] = max(worst[lo + i], -mine[-1][0])
            continue
        split_query = queries.children[a] and (not data.children[b] or queries.radius[a] > data.radius[b])
        if split_query:
            pairs = [(c, b) for c in range(queries.child[a], queries.child[a] + queries.children[a])]
        else:
            pairs = [(a, c) for c in range(data.child[b], data.child[b] + data.children[b])]
        todo += sorted((value(c, d), c, d) for c, d in pairs)
    return best


# -- blocks --------------------------------------------------------------------


_BLOCK = (
    "dim int, block string, vectors binary, nodes binary, ids array<array<bigint>>, "
    "centre array<bigint>, radius double"
)


def _built(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("least")
    points = np.array([np.asarray(v, np.int64) for v in group["v"]])
    order, nodes = cover_tree(points)
    ids = group["ids"].tolist()
    return pd.DataFrame(
        {
            "dim": [points.shape[1]],
            "block": [group["block"].iloc[0]],
            "vectors": [points[order].tobytes()],
            "nodes": [nodes.tobytes()],
            "ids": [[[int(i) for i in ids[o]] for o in order]],
            "centre": [points[order][int(nodes[0, 2])].tolist()],
            "radius": [float(nodes[0, 3])],
        }
    )


def blocks(points: DataFrame, pivots: dict[int, np.ndarray], size: int, name: str) -> DataFrame:
    """Cover trees over `points` (v, ids), one row for each block of a pivot's points."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_pylist()
            nearest = np.full(len(rows), -1)
            lengths = np.array([len(r) for r in rows])
            for dim, own in pivots.items():
                here = np.flatnonzero(lengths == dim)
                if len(here) and dim:
                    x = np.array([rows[i] for i in here], np.float64)
                    gap = (own**2).sum(axis=1)[None, :] - 2 * x @ own.T
                    nearest[here] = gap.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32())], names=["v", "ids", "pivot"])

    dealt = cut_lineage(
        points.select("v", "ids").mapInArrow(deal, "v array<bigint>, ids array<bigint>, pivot int")
        .withColumn("dim", F.size("v"))
    )
    # At most MAX_PIVOTS rows for each dimension.
    counts = dealt.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("parts"))
    parted = checked_join(dealt, cut_lineage(counts), ["dim", "pivot"], ["v"])
    part = F.pmod(F.xxhash64("v"), F.col("parts"))
    block = F.concat_ws("-", F.lit(name), "dim", "pivot", part)
    keyed = parted.select("v", "ids", F.array_min("ids").alias("least"), block.alias("block"))
    return cut_lineage(keyed.groupBy("block").applyInPandas(_built, _BLOCK))


def _block_pairs(queries: DataFrame, data: DataFrame) -> DataFrame:
    """(q, d, dot, bound): every query block against every data block, by their roots only."""
    q = queries.select("dim", F.col("block").alias("q"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    d = data.select("dim", F.col("block").alias("d"), F.col("centre").alias("dc"), F.col("radius").alias("dr"))
    q = q.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(_SLOTS - 1))))
    d = d.withColumn("slot", F.pmod(F.xxhash64("d"), F.lit(_SLOTS)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            dots, tops = [], []
            for r in rows:
                a, b = np.array(r["qc"], np.float64), np.array(r["dc"], np.float64)
                dots.append(float(a @ b))
                tops.append(bound(dots[-1], r["qr"], float(np.sqrt(a @ a)), r["dr"], float(np.sqrt(b @ b))))
            names = [pa.array([r[c] for r in rows], pa.string()) for c in ("q", "d")]
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(dots, pa.float64()), pa.array(tops, pa.float64())], names=["q", "d", "dot", "bound"]
            )

    return cut_lineage(q.join(d, ["dim", "slot"]).mapInArrow(run, "q string, d string, dot double, bound double"))


_FOUND = "q string, i int, score bigint, ids array<bigint>"


def _searched(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """Best points of the queries (q, i) in the block pairs (q, d, worst)."""
    q = queries.select(F.col("block").alias("q"), "dim", F.col("vectors").alias("qv"), F.col("nodes").alias("qn"))
    d = data.select(F.col("block").alias("d"), F.col("vectors").alias("dv"), F.col("nodes").alias("dn"), "ids")
    rows = pairs.join(q, "q").join(d, "d").select("q", "worst", "dim", "qv", "qn", "dv", "dn", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                tree, other = Tree(r["qv"], r["qn"], r["dim"]), Tree(r["dv"], r["dn"], r["dim"])
                worst = np.array(r["worst"] or [-math.inf] * len(tree.vectors), np.float64)
                least = np.array([ids[0] for ids in r["ids"]], np.int64)
                out = [
                    {"q": r["q"], "i": i, "score": -s, "ids": r["ids"][place]}
                    for i, found in enumerate(search(tree, other, least, worst, k))
                    for s, _, place in found
                ]
                yield pa.RecordBatch.from_pylist(out, schema=_FOUND_ARROW)

    return cut_lineage(rows.mapInArrow(run, _FOUND))


_FOUND_ARROW = pa.schema(
    [("q", pa.string()), ("i", pa.int32()), ("score", pa.int64()), ("ids", pa.list_(pa.int64()))]
)


def _pivots(points: DataFrame, size: int) -> dict[int, np.ndarray]:
    """By dimension the pivots: MAX_PIVOTS points at most, the first by hash."""
    out = {}
    for row in points.groupBy(F.size("v").alias("dim")).count().collect():
        wanted = max(1, min(MAX_PIVOTS, row["count"] // size))
        own = points.where(F.size("v") == row["dim"]).select("v").orderBy(F.xxhash64("v"), "v").limit(wanted)
        out[row["dim"]] = np.array([r["v"] for r in own.collect()], np.float64).reshape(-1, row["dim"])
    return out


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """For each row where `queries` holds: query_id, rank, vec_id and score of its k best others.

    The score is the inner product of the quantised vectors, ties go to the least id; with fewer
    other rows all are given. Vectors that are null or hold a null or non-finite component, and
    rows with a null key, take no part. Only vectors of one length are compared. Rows that repeat
    a key count once for each distinct vector; a query is matched with every key but its own.
    """
    marked = vectors.select(
        F.col(f"`{key}`").cast("bigint").alias("id"), quantised(F.col(f"`{vector}`"), scale).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    rows = cut_lineage(marked.where("id is not null and v is not null and size(v) > 0").distinct())
    # The k + 1 least ids of equal vectors; Spark drops the others before the shuffle.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.select("id", "v").withColumn("n", place).where(F.col("n") <= k + 1)
    points = cut_lineage(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = rows.where("asks").select("v").distinct()
    pivots = _pivots(points, DATA_BLOCK)
    data = blocks(points, pivots, DATA_BLOCK, "d")
    # A query point carries its hash as id: it is looked up by its vector in the end.
    query = blocks(asked.select("v", F.array(F.xxhash64("v")).alias("ids")), pivots, QUERY_BLOCK, "q")
    pairs = _block_pairs(query, data)
    nearest = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("dot"), "d"))
    ranked = cut_lineage(pairs.withColumn("nth", nearest))
    none = F.lit(None).cast("array<double>")
    near = _searched(ranked.where(F.col("nth") <= FIRST_BLOCKS).withColumn("worst", none), query, data, k + 1)
    best = F.sort_array(F.collect_list(F.col("score")), asc=False)
    kth = near.groupBy("q", "i").agg(F.coalesce(F.get(best, F.lit(k)).cast("double"), F.lit(-math.inf)).alias("w"))
    sizes = query.select(F.col("block").alias("q"), F.posexplode("ids").alias("i", "_"))
    known = sizes.join(kth, ["q", "i"], "left").withColumn("w", F.coalesce("w", F.lit(-math.inf)))
    worst = known.groupBy("q").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("worst")
    )
    rest = ranked.where(F.col("nth") > FIRST_BLOCKS).join(worst, "q").where(F.col("bound") >= F.array_min("worst"))
    far = _searched(rest.select("q", "d", "worst"), query, data, k + 1)
    # Few rows for each query and block; the best k + 1 ids hold the best k others.
    found = near.unionByName(far).select("q", "i", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q", "i").orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    codes = query.select(F.col("block").alias("q"), F.posexplode("ids").alias("i", "code"))
    by_vector = kept.join(codes.select("q", "i", F.get("code", F.lit(0)).alias("code")), ["q", "i"])
    lists = by_vector.groupBy("code").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("best")
    )
    asking = rows.where("asks").select(F.col("id").alias("query_id"), F.xxhash64("v").alias("code"))
    answered = checked_join(asking, cut_lineage(lists), ["code"], ["query_id"])
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = answered.select("query_id", F.posexplode(others).alias("p", "b"))
    return out.select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.s")).alias("score"),
    )
