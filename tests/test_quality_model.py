"""Profiles against pandas, and the count models."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from galegrid.operators import model, quality


@pytest.fixture(scope="module")
def numbers():
    pick = random.Random(11)
    return pd.DataFrame(
        {
            "a": [pick.gauss(0, 1e6) for _ in range(501)],
            "b": [float(pick.randrange(4)) for _ in range(501)],
            "c": [None if k % 3 == 0 else 1e-12 * k for k in range(501)],
            "d": [5.0] * 500 + [1e300],
        }
    )


def test_describe_matches_pandas(spark, numbers):
    df = spark.createDataFrame(numbers.astype(object).where(numbers.notna(), None), "a double, b double, c double, d double")
    want = numbers.describe()
    got = {(r["column"], r["metric"]): r["value"] for r in quality.describe(df).collect()}
    assert set(got) == {(c, m) for c in want.columns for m in want.index}
    for (column, metric), value in got.items():
        expected = want.loc[metric, column]
        if column == "d" and metric in ("std", "mean"):
            continue
        assert value == pytest.approx(expected, rel=1e-9, abs=1e-18), (column, metric)


def test_exact_quantiles_take_few_passes(spark, monkeypatch):
    """More values than bins: brackets narrow until one value is left."""
    monkeypatch.setattr(quality, "BINS", 4)
    values = [float(k * k % 1009) for k in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quality.exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.99, 1.0])
    want = pd.Series(values).quantile([0.0, 0.1, 0.5, 0.99, 1.0])
    assert [got[("v", p)] for p in want.index] == pytest.approx(list(want))


def test_quantiles_at_the_ends_of_the_number_range(spark):
    values = [-1.7e308, -1.0, 0.0, 5e-324, 1.0, 1.7e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quality.exact_quantiles(df, ["v"], [0.0, 0.5, 5 / 6, 1.0])
    assert list(got.values()) == [-1.7e308, 5e-324, 1.7e308, float("inf")]


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, s string")
    got = {(r["column"], r["metric"]): r["value"] for r in quality.profile(df).collect()}
    assert got[("*", "n_rows")] == 0 and got[("*", "n_columns")] == 2
    assert got[("a", "count")] == 0 and got[("a", "50%")] is None


def test_null_counts_shape_coverage(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(quality.null_counts(df)) == [("a", 1), ("b", 2)]
    assert rows(quality.shape(df)) == [(3, 2)]
    assert rows(quality.coverage(df, "a")) == [(1, 3)]
    assert quality.preview(df, 2).count() == 2


def test_hash_split_is_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    first = model.hash_split(df, ["k"])
    again = model.hash_split(df.repartition(7), ["k"])
    assert rows(first.where("is_train")) == rows(again.where("is_train"))
    assert 0.78 < first.where("is_train").count() / 20000 < 0.82
    assert rows(model.hash_split(df, ["k"], seed=1)) != rows(first)


def test_error_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 0.0)], "y double, p double")
    row = model.error_metrics(df, F.col("y"), F.col("p")).first()
    assert (row.mse, row.rmse, row.mae) == (5.0, 5.0**0.5, 2.0)


@pytest.mark.parametrize("kind", ["poisson", "boosted"])
def test_models_find_the_signal(spark, kind):
    df = spark.range(600).select(
        (F.col("id") % 4).cast("int").alias("wind"),
        (F.col("id") % 7).cast("int").alias("noise"),
        (F.pmod(F.col("id"), F.lit(4)) * 3 + 1).alias("Incident_Count"),
        F.col("id").alias("row"),
    )
    fitted = model.fit_count_model(df.drop("row"), kind=kind, split_by=["wind", "noise"])
    row = fitted.metrics.first()
    assert row.mse == pytest.approx(row.rmse**2) and row.mae < 1.5
    assert fitted.importances.first()["Feature"] == "wind"
    assert "prediction" in fitted.predictions.columns


def test_null_features_raise(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2)] * 20, "wind double, Incident_Count int")
    with pytest.raises(Exception):
        model.fit_count_model(df)


def test_weights_equal_repeated_rows(spark):
    base = spark.range(120).select(
        (F.col("id") % 5).cast("double").alias("wind"),
        (F.col("id") % 3).alias("Incident_Count"),
        (F.col("id") % 4 + 1).cast("int").alias("times"),
    )
    repeated = base.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("_k", "times")
    weighted = model.fit_count_model(base, weight_col="times", split_by=["wind"], regParam=0.0)
    plain = model.fit_count_model(repeated, split_by=["wind"], regParam=0.0)
    assert weighted.model.stages[1].coefficients.toArray() == pytest.approx(
        plain.model.stages[1].coefficients.toArray(), abs=1e-6
    )


def test_registered_models_report(spark, sf_dir):
    for name in ("count_model", "boosted_model"):
        report = entry.queries()[name](spark, sf_dir)
        kinds = [r["kind"] for r in report.collect()]
        assert kinds.count("metric") == 3 and 0 < kinds.count("importance") <= 20


def test_profile_scans_once(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_returnflag")
    text = quality.profile(lines)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") <= 1


def test_quantiles_of_many_columns(spark, monkeypatch):
    """More brackets than a pass takes."""
    monkeypatch.setattr(quality, "BRACKETS", 3)
    monkeypatch.setattr(quality, "BINS", 8)
    df = spark.range(101).select(*[(F.col("id") * (k + 1)).alias(f"c{k}") for k in range(12)])
    found = quality.exact_quantiles(df, df.columns, [0.25, 0.5])
    assert found == {(f"c{k}", p): 100 * p * (k + 1) for k in range(12) for p in (0.25, 0.5)}
