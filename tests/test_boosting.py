"""Poisson boosting and the split of exact size."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from galegrid.operators import boosting, model, ranks
from galegrid.operators.boosting import Split, fit_poisson_trees


def counts(spark, n=900):
    """The count follows from a, more so where b is null; c says nothing."""
    return spark.range(n).select(
        "id",
        (F.col("id") % 10).alias("a"),
        F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("b"),
        F.xxhash64("id").cast("double").alias("c"),
        (F.col("id") % 10 + F.when(F.col("id") % 3 == 0, 15).otherwise(0)).cast("int").alias("y"),
    )


def deviance(model, df, trees):
    p = model.predict(df, trees=trees)
    return p.agg(F.sum(F.col("prediction") - F.col("y") * F.log("prediction"))).first()[0]


def test_the_deviance_falls_every_round(spark):
    df = counts(spark)
    fitted = fit_poisson_trees(df, ["a", "b", "c"], "y", rounds=6, max_depth=3, max_bins=32)
    losses = [deviance(fitted, df, k) for k in range(7)]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    assert [r["Feature"] for r in fitted.importances(spark, 2).collect()] == ["b", "a"]
    total = fitted.importances(spark, None, "total_gain").agg(F.sum("Importance"), F.count("*")).first()
    assert total[0] == pytest.approx(1) and total[1] == 3
    assert fitted.importances(spark, 1, "weight").count() == 1
    with pytest.raises(ValueError):
        fitted.importances(spark, kind="cover")


def test_the_first_tree_by_hand(spark):
    """One split on one feature: every edge and both sides for nulls are tried by hand."""
    data = [(x, y) for x, y in zip([1.0, 1.0, 2.0, 3.0, 3.0, 5.0, 8.0, 8.0, None, None], [0, 1, 1, 2, 3, 2, 7, 9, 8, 6])]
    df = spark.createDataFrame(data, "x double, y int")
    fitted = fit_poisson_trees(df, ["x"], "y", rounds=1, max_depth=1, least_hessian=0.0)
    mean = sum(y for _, y in data) / len(data)

    def sums(part):
        return sum(mean - y for _, y in part), len(part) * math.exp(math.log(mean) + 0.7)

    def step(g, h):
        return max(-0.7, min(0.7, -g / (h + 1)))

    def gain(g, h):
        return -(2 * g * step(g, h) + (h + 1) * step(g, h) ** 2)

    best = max(
        (gain(*sums(left)) + gain(*sums(right)) - gain(*sums(data)), -edge, not null_left, step(*sums(left)), step(*sums(right)))
        for edge in (2, 3, 5, 8) for null_left in (False, True)
        for left in [[d for d in data if (null_left if d[0] is None else d[0] < edge)]]
        for right in [[d for d in data if d not in left]]
    )
    tree = fitted.trees[0]
    assert tree[1].threshold == -best[1] and tree[1].null_left == (not best[2])
    assert tree[1].gain == pytest.approx(best[0], rel=1e-5)
    assert (tree[2], tree[3]) == pytest.approx((0.3 * best[3], 0.3 * best[4]), rel=1e-5)


def test_trees_do_not_depend_on_partitioning_and_weights_are_repeats(spark):
    df = counts(spark).withColumn("w", (F.col("id") % 3 + 1).cast("int"))
    options = {"rounds": 2, "max_depth": 2, "max_bins": 8}
    once = fit_poisson_trees(df, ["a", "b", "c"], "y", weight="w", **options)
    again = fit_poisson_trees(df.repartition(11), ["a", "b", "c"], "y", weight="w", **options)
    assert once.trees == again.trees
    repeated = df.withColumn("k", F.explode(F.sequence(F.lit(1), "w")))
    few = {"rounds": 2, "max_depth": 2, "max_bins": 8}
    assert fit_poisson_trees(repeated, ["a", "b"], "y", **few).trees == fit_poisson_trees(df, ["a", "b"], "y", weight="w", **few).trees


def test_edges_of_the_data(spark):
    df = counts(spark, 60)
    none = fit_poisson_trees(df.limit(0), ["a"], "y")
    assert none.trees == [] and none.predict(df).agg(F.max("prediction")).first()[0] == 0
    zeros = fit_poisson_trees(df.withColumn("y", F.lit(0)), ["a"], "y")
    assert zeros.trees == [] and zeros.base == -math.inf
    constant = df.withColumns({"a": F.lit(4), "b": F.lit(None).cast("int")})
    fitted = fit_poisson_trees(constant, ["a", "b"], "y", rounds=2, max_depth=2)
    assert not any(isinstance(n, Split) for t in fitted.trees for n in t.values())
    assert fitted.importances(spark).collect()[0]["Importance"] == 0
    odd = df.withColumn("c", F.when(F.col("id") < 5, F.lit(float("nan"))).when(F.col("id") < 9, F.lit(float("inf"))).otherwise(-F.lit(float("inf"))))
    assert fit_poisson_trees(odd, ["c"], "y", rounds=1).predict(odd).where("isnan(prediction)").count() == 0
    for bad in (F.lit(-1), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="null or negative"):
            fit_poisson_trees(df.withColumn("y", F.when(F.col("id") == 3, bad).otherwise(F.col("y"))), ["a"], "y")
    with pytest.raises(ValueError):
        fit_poisson_trees(df, ["a"], "y", max_depth=9)


def test_deep_trees_compile(spark):
    df = spark.range(3000).select(F.xxhash64("id").cast("double").alias("c"), (F.col("id") % 50).alias("y"))
    fitted = fit_poisson_trees(df, ["c"], "y", rounds=2, max_depth=boosting.MOST_DEPTH)
    assert max(fitted.trees[0]) >= 2**boosting.MOST_DEPTH
    assert deviance(fitted, df, 2) < deviance(fitted, df, 1) < deviance(fitted, df, 0)


def test_fit_count_model_with_trees(spark):
    fitted = model.fit_count_model(counts(spark).drop("id"), label="y", kind="trees", exact=True, rounds=8, max_depth=3)
    assert fitted.predictions.count() == 180 and fitted.metrics.first()["mae"] < 5
    assert fitted.importances.first()["Feature"] == "b"


@pytest.mark.parametrize("n", [0, 1, 4, 5, 101])
def test_exact_size(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    found = ranks.exact_split(df, ["k"])
    assert found.where("not is_train").count() == -(-n // 5) and found.count() == n
    assert rows(found) == rows(ranks.exact_split(df.repartition(7), ["k"]))


def test_exact_size_with_ties(spark):
    """One key holds most rows, many of them equal throughout; a column of the result's name is replaced."""
    data = [(1, k % 4, "old") for k in range(300)] + [(None, k, None) for k in range(50)] + [(k, k, "x") for k in range(2, 52)]
    df = spark.createDataFrame(data, "k int, v int, IS_TRAIN string")
    found = ranks.exact_split(df, ["k"], 0.25)
    assert found.columns == ["k", "v", "is_train"]
    assert found.where("not is_train").count() == 100
    assert Counter(rows(found, "k", "v")) == Counter(rows(df, "k", "v"))
    assert rows(found) == rows(ranks.exact_split(df.repartition(5), ["k"], 0.25))
    assert ranks.exact_split(df, ["k"], 0).where("not is_train").count() == 0
    assert ranks.exact_split(df, ["k"], 1).where("is_train").count() == 0


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_smallest(spark, monkeypatch, bins):
    monkeypatch.setattr(ranks, "BINS", bins)
    values = [-(2**63), -5, -5, -5, 0, 3, 3, 8, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    for k, v in enumerate(values, 1):
        assert ranks.smallest(df, F.col("v"), k) == (v, sum(x < v for x in values), values.count(v))
