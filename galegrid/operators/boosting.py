"""Boosted trees for counts: histogram boosting with the Poisson objective, in aggregates.

A prediction is exp(margin); a row's gradient is exp(margin) - count, its hessian
exp(margin + MAX_STEP). Features are cut into bins at quantiles once. Every level of a tree is one
aggregate of gradient and hessian sums for each (node, feature, bin), which combines before the
shuffle to at most nodes x features x bins rows; the best split of each node is picked from it with
windows, and only that comes to the driver. Leaves are Newton steps.

Rows whose bins are equal have equal margins for good, so they become one row with their number
and their sum of counts before the first tree. Sums are over integers, as gradients are rounded to
2^-20: trees do not depend on partitioning, order or retries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..session import cut_lineage
from .quality import top_n

#: Margins move by at most this in a leaf, before the learning rate.
MAX_STEP = 0.7
#: Splits that gain no more than this are not made.
LEAST_GAIN = 1e-6
UNIT = float(1 << 20)
#: A tree becomes one compiled expression, which bounds its depth.
MOST_DEPTH = 8
#: Relative error of the quantiles that bins are cut at, as percentile_approx takes it.
ACCURACY = 10_000


@dataclass(frozen=True)
class Split:
    """Rows with a value below `threshold` go left, and nulls if `null_left`."""

    feature: int
    bin: int
    threshold: float
    null_left: bool
    gain: float


#: A tree by the numbers of its nodes: 1 is the root, 2n and 2n + 1 follow n; a leaf is a number.
Tree = dict[int, "Split | float"]


def _step(g: Column, h: Column, penalty: float) -> Column:
    """The Newton step of a node with these sums, bounded."""
    return F.greatest(F.least(-g / (h + penalty), F.lit(MAX_STEP)), F.lit(-MAX_STEP))


def _gain(g: Column, h: Column, penalty: float) -> Column:
    """How much that step lowers the loss, twice."""
    w = _step(g, h, penalty)
    return -(F.lit(2.0) * g * w + (h + penalty) * w * w)


@dataclass
class PoissonTrees:
    """Fitted trees: `predict` adds the expected counts, `importances` ranks the features."""

    features: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def predict(self, df: DataFrame, out: str = "prediction", trees: int | None = None) -> DataFrame:
        """`df` with the expected count of each row; of the first `trees` trees only, if given.

        Thousands of branches are more than Spark compiles in one method, so the trees are walked over
        Arrow batches, a level of all rows at a time.
        """
        base, tables = self.base, [_table(t) for t in self.trees[:trees]]

        def margins(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            rows, total = np.arange(len(x)), np.full(len(x), base)
            for feature, threshold, null_left, value, depth in tables:
                node = np.ones(len(x), np.int64)
                for _ in range(depth):
                    f = feature[node]
                    v = x[rows, f]
                    right = np.where(np.isnan(v), ~null_left[node], v >= threshold[node])
                    node = np.where(f < 0, node, 2 * node + right)
                total += value[node]
            return pd.Series(np.exp(total))

        walked = F.pandas_udf(margins, "double")
        return df.withColumn(out, walked(*[quoted(f).cast("double") for f in self.features]))

    def importances(self, spark: SparkSession, top: int | None = 20, kind: str = "gain") -> DataFrame:
        """The features that split most, ties by name, as shares that add up to 1.

        `gain` is the mean gain of a feature's splits, `total_gain` their sum, `weight` their number.
        Features that no tree splits have 0.
        """
        if kind not in ("gain", "total_gain", "weight"):
            raise ValueError(f"unknown kind {kind!r}")
        gains: list[list[float]] = [[] for _ in self.features]
        for tree in self.trees:
            for node in sorted(tree):
                if isinstance(tree[node], Split):
                    gains[tree[node].feature].append(tree[node].gain)
        strength = [float(len(g)) if kind == "weight" else sum(g) for g in gains]
        if kind == "gain":
            strength = [s / len(g) if g else 0.0 for s, g in zip(strength, gains)]
        total = sum(strength) or 1.0
        rows = [(f, s / total) for f, s in zip(self.features, strength)]
        ranked = spark.createDataFrame(rows, "Feature string, Importance double")
        return top_n(ranked, "Importance", len(rows) if top is None else top, ["Feature"])


def _table(tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """A tree by node number: feature (-1 for a leaf), threshold, whether nulls go left, value; its depth."""
    size = max(tree) + 1
    feature, threshold, null_left, value = np.full(size, -1), np.zeros(size), np.zeros(size, bool), np.zeros(size)
    for node, at in tree.items():
        if isinstance(at, Split):
            feature[node], threshold[node], null_left[node] = at.feature, at.threshold, at.null_left
        else:
            value[node] = at
    return feature, threshold, null_left, value, max(tree).bit_length() - 1


def _walk(tree: Tree, node: int, left) -> Column:
    """The value of the leaf that a row falls into."""
    at = tree[node]
    if not isinstance(at, Split):
        return F.lit(at)
    return F.when(left(at), _walk(tree, 2 * node, left)).otherwise(_walk(tree, 2 * node + 1, left))


def _place(tree: Tree, node: int, level: set[int], left) -> Column:
    """The node of `level` that a row is in, null if it ended before."""
    if node in level:
        return F.lit(node)
    at = tree.get(node)
    if not isinstance(at, Split):
        return F.lit(None).cast("int")
    return F.when(left(at), _place(tree, 2 * node, level, left)).otherwise(_place(tree, 2 * node + 1, level, left))


def _bin_left(s: Split) -> Column:
    value = F.col("bins")[s.feature]
    return F.when(value < 0, F.lit(s.null_left)).otherwise(value < s.bin)


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """For each feature the values, in order, that open a bin: distinct quantiles and the maximum.

    The least value opens the first bin and is not listed. One aggregate; nulls and NaN do not count,
    and infinite values fall into the first or last bin.
    """
    shares = [k / max_bins for k in range(1, max_bins)]
    found = []
    for f in features:
        value = quoted(f).cast("double")
        value = F.when(~F.isnan(value), value)
        found += [F.percentile_approx(value, shares, ACCURACY).alias(f"q{len(found)}"), F.min(value), F.max(value)]
    row = df.agg(*found).first()
    edges = []
    for k in range(len(features)):
        quantiles, low, high = row[3 * k : 3 * k + 3]
        edges.append(sorted(e for e in {*(quantiles or []), high} - {low, None} if math.isfinite(e)))
    return edges


def binned(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], count: Column, weight: Column) -> DataFrame:
    """Rows (bins, w, y): equal bins are one row with their weight and their weighted counts."""
    numbers = [f"_bin{k}" for k in range(len(features))]
    cut = [k for k, e in enumerate(edges) if e]
    values = df.select(
        *[F.coalesce(quoted(f).cast("double"), F.lit(float("nan"))).alias(f"_v{k}") for k, f in enumerate(features)],
        weight.cast("double").alias("w"),
        count.cast("double").alias("y"),
    )
    if cut:
        values = Bucketizer(
            splitsArray=[[-math.inf, *edges[k], math.inf] for k in cut],
            inputCols=[f"_v{k}" for k in cut], outputCols=[numbers[k] for k in cut], handleInvalid="keep",
        ).transform(values)
    bins = [
        F.when(F.isnan(f"_v{k}"), -1).otherwise(F.col(numbers[k]) if edges[k] else F.lit(0)).cast("smallint")
        for k in range(len(features))
    ]
    told = values.select(F.array(*bins).alias("bins"), "w", (F.col("w") * F.col("y")).alias("y"))
    return told.groupBy("bins").agg(F.sum("w").alias("w"), F.sum("y").alias("y"))


def _level(rows: DataFrame, tree: Tree, level: set[int], penalty: float, least_hessian: float) -> list:
    """For each node of a level its sums and its best split, null if there is none."""
    expected = F.col("w") * F.exp("margin")
    sums = rows.select(
        _place(tree, 1, level, _bin_left).alias("node"),
        F.floor((expected - F.col("y")) * UNIT + 0.5).cast("bigint").alias("g"),
        F.floor(F.col("w") * F.exp(F.col("margin") + MAX_STEP) * UNIT + 0.5).cast("bigint").alias("h"),
        F.posexplode("bins").alias("f", "b"),
    )
    hist = sums.where("node IS NOT NULL").groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    whole = Window.partitionBy("node", "f")
    upto = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    told = hist.select(
        "node", "f", "b",
        *[F.sum(c).over(whole).alias(f"all_{c}") for c in "gh"],
        *[F.coalesce(F.sum(F.when(F.col("b") >= 0, F.col(c))).over(upto), F.lit(0)).alias(f"low_{c}") for c in "gh"],
        *[F.coalesce(F.sum(F.when(F.col("b") < 0, F.col(c))).over(whole), F.lit(0)).alias(f"null_{c}") for c in "gh"],
    )
    both = told.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("null_left"))
    sides = {}
    for c in "gh":
        low = F.col(f"low_{c}") + F.when(F.col("null_left"), F.col(f"null_{c}")).otherwise(0)
        sides[c] = [x / UNIT for x in (F.col(f"all_{c}"), low, F.col(f"all_{c}") - low)]
    (g, g_left, g_right), (h, h_left, h_right) = sides["g"], sides["h"]
    gain = _gain(g_left, h_left, penalty) + _gain(g_right, h_right, penalty) - _gain(g, h, penalty)
    # a split stands at the lower edge of a bin; the lowest one and nulls have none
    able = (F.col("b") > 0) & (h_left >= least_hessian) & (h_right >= least_hessian) & (gain > LEAST_GAIN)
    order = F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("b")).alias("b"), (~F.col("null_left")).alias("n"))
    picked = F.max_by(
        F.struct("f", "b", "null_left", gain.alias("gain"), _step(g_left, h_left, penalty).alias("left"), _step(g_right, h_right, penalty).alias("right")),
        F.when(able, order),
    )
    return both.groupBy("node").agg(picked.alias("best"), F.max(_step(g, h, penalty)).alias("step")).collect()


def fit_poisson_trees(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    rounds: int = 100,
    max_depth: int = 6,
    learning_rate: float = 0.3,
    penalty: float = 1.0,
    least_hessian: float = 1.0,
    max_bins: int = 256,
) -> PoissonTrees:
    """Boosted trees for the counts in `label`, which must not be negative or null.

    The first margin is the logarithm of the mean count. `penalty` is added to hessian sums,
    `least_hessian` is what each side of a split must hold. Features are numeric; null and NaN go to
    the side that gains more. `weight` stands for repeated rows. Rows of all counts 0, or none, give
    no trees. Equal gains are decided by the order of the features, then the lower threshold.

    The driver holds the trees and the edges of the bins: at most `max_bins` for each feature.
    """
    if not 1 <= max_depth <= MOST_DEPTH:
        raise ValueError(f"max_depth is between 1 and {MOST_DEPTH}")
    if not 2 <= max_bins <= 1 << 15:
        raise ValueError("max_bins is between 2 and 32768")
    features = list(features)
    count = quoted(label).cast("double")
    checked = F.when(count >= 0, count).otherwise(F.raise_error(F.lit(f"{label}: a count is null or negative")))
    edges = bin_edges(df, features, max_bins)
    rows = cut_lineage(binned(df, features, edges, checked, quoted(weight) if weight else F.lit(1.0)))
    sums = rows.agg(F.sum("w").alias("w"), F.sum("y").alias("y")).first()
    if not sums["w"] or not sums["y"]:
        return PoissonTrees(features, -math.inf)
    model = PoissonTrees(features, math.log(sums["y"] / sums["w"]))
    current = cut_lineage(rows.withColumn("margin", F.lit(model.base)), replacing=rows)
    for _ in range(rounds):
        tree = _grow(current, edges, max_depth, learning_rate, penalty, least_hessian)
        if tree == {1: 0.0}:
            break  # neither a split nor a step gains anything
        model.trees.append(tree)
        if len(model.trees) < rounds:
            margin = F.col("margin") + _walk(tree, 1, _bin_left)
            current = cut_lineage(current.withColumn("margin", margin), replacing=current)
    return model


def _grow(rows: DataFrame, edges: Sequence[Sequence[float]], max_depth: int, learning_rate: float, penalty: float, least_hessian: float) -> Tree:
    """One tree, level by level."""
    tree: Tree = {}
    level = {1}
    for _ in range(max_depth):
        found = _level(rows, tree, level, penalty, least_hessian)
        level = set()
        for row in found:
            node, best = row["node"], row["best"]
            if best is None:
                tree[node] = learning_rate * row["step"]
                continue
            threshold = edges[best["f"]][best["b"] - 1]
            tree[node] = Split(best["f"], best["b"], threshold, best["null_left"], best["gain"])
            # leaves, unless the next level splits them
            tree[2 * node], tree[2 * node + 1] = learning_rate * best["left"], learning_rate * best["right"]
            level |= {2 * node, 2 * node + 1}
        if not level:
            break
    return tree
