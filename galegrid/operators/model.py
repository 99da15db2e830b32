"""Count regression on grouped incidents with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..session import cut_lineage
from .align import count_incidents
from .boosting import PoissonTrees, fit_poisson_trees
from .quality import top_n
from .ranks import exact_split


def count_table(
    df: DataFrame,
    by: Sequence[str],
    id_col: str = "Incident_ID",
    out: str = "Incident_Count",
    order: Sequence[str] = (),
) -> DataFrame:
    """Incidents per group, sorted when order columns are given."""
    counted = count_incidents(df, by, id_col, out)
    return counted.orderBy(*order) if order else counted


def hash_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add `is_train`, decided by the MD5 digits of the seed and the key columns as text.

    Unlike a random split the answer depends neither on partitioning nor on retries, and other
    engines can repeat it. A null key counts as empty text.
    """
    texts = [F.coalesce(quoted(k).cast("string"), F.lit("")) for k in keys]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *texts)), 1, 8)
    draw = F.conv(digits, 16, 10).cast("bigint") % F.lit(1_000_000)
    return df.withColumn("is_train", draw < F.lit(int(train_share * 1_000_000)))


def error_metrics(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """MSE, RMSE and MAE in one pass."""
    error = actual - predicted
    return df.agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


@dataclass
class CountModel:
    """A fitted model with its test metrics and its features ranked by importance."""

    model: PipelineModel | PoissonTrees
    metrics: DataFrame
    importances: DataFrame
    predictions: DataFrame


def fit_count_model(
    df: DataFrame,
    label: str = "Incident_Count",
    kind: str = "poisson",
    split_by: Sequence[str] | None = None,
    weight_col: str | None = None,
    top: int = 20,
    seed: int = 42,
    features: Sequence[str] | None = None,
    exact: bool = False,
    **params: object,
) -> CountModel:
    """Fit on 80 % of the rows, score on the rest, rank the features.

    `trees` are boosted trees with the Poisson objective (`boosting.fit_poisson_trees`, which takes
    `params`), ranked by mean gain; null features take a side. `poisson` is a generalised linear model with the Poisson objective and log link; its
    importances are absolute coefficients. `boosted` is gradient-boosted trees on
    log(1 + count) by Spark ML. `weight_col` takes the place of repeated rows. Features, by default
    all other columns, must be numeric; a null in one is an error for the latter two, not a dropped
    row. With `exact` the test rows are a fifth of the rows to the row (`ranks.exact_split`).
    """
    features = [c for c in df.columns if c not in {label, weight_col}] if features is None else list(features)
    by = split_by or features
    split = exact_split(df, by, seed=seed) if exact else hash_split(df, by, seed=seed)
    if kind == "trees":
        return _fit_trees(cut_lineage(split), df.columns, features, label, weight_col, top, params)
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="error")
    # The fit reads its input once per iteration: keep the assembled rows, not their lineage.
    ready = cut_lineage(
        assembler.transform(split.withColumn("_label", quoted(label).cast("double")))
    )
    train, test = ready.where("is_train"), ready.where("not is_train")
    common = {"featuresCol": "_features", "predictionCol": "_prediction"}
    if weight_col:
        common["weightCol"] = weight_col
    if kind == "poisson":
        options = {"regParam": 1e-3, "maxIter": 25, **params}
        estimator = GeneralizedLinearRegression(
            family="poisson", link="log", labelCol="_label", **common, **options
        )
        fitted = estimator.fit(train)
        predicted = fitted.transform(test).withColumn("prediction", F.col("_prediction"))
        strength = [abs(v) for v in fitted.coefficients.toArray()]
    elif kind == "boosted":
        options = {"maxIter": 20, "maxDepth": 5, "seed": seed, **params}
        estimator = GBTRegressor(labelCol="_log_label", **common, **options)
        fitted = estimator.fit(train.withColumn("_log_label", F.log1p("_label")))
        predicted = fitted.transform(test).withColumn("prediction", F.expm1("_prediction"))
        strength = list(fitted.featureImportances.toArray())
    else:
        raise ValueError(f"unknown kind {kind!r}")
    metrics = error_metrics(predicted, F.col("_label"), F.col("prediction"))
    ranked = df.sparkSession.createDataFrame(
        [(name, float(value)) for name, value in zip(features, strength)],
        "Feature string, Importance double",
    )
    return CountModel(
        PipelineModel([assembler, fitted]),
        metrics,
        top_n(ranked, "Importance", top, ["Feature"]),
        predicted.select(*[quoted(c) for c in df.columns], "prediction"),
    )


def _fit_trees(
    split: DataFrame, columns: Sequence[str], features: Sequence[str], label: str, weight_col: str | None, top: int, params: dict
) -> CountModel:
    """The boosted trees of `fit_count_model`."""
    fitted = fit_poisson_trees(split.where("is_train"), features, label, weight=weight_col, **params)
    predicted = fitted.predict(split.where("not is_train").select(*[quoted(c) for c in columns]))
    metrics = error_metrics(predicted, quoted(label), F.col("prediction"))
    return CountModel(fitted, metrics, fitted.importances(split.sparkSession, top), predicted)
