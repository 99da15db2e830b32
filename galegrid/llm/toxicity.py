"""Toxicity by a classifier chain.

The categories are predicted one after another by linear models. A later model gets, beside
the words of the text, the log-odds that the earlier models gave; for training these come from
models that had not seen the row (out-of-fold), so that the later model learns how far an
earlier category can be trusted on new texts.

Training uses a bounded sample of the labelled rows (`MAX_LABELLED`, taken by a hash of the
key, so reruns agree). The models of one link, one for each fold and one over all rows, are
fitted side by side as groups of a Spark job. Scoring reads whole texts of all rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import arrow_rows
from .common import fresh

#: Labelled rows that the models are fitted on, at most.
MAX_LABELLED = 12_000
#: Words and word beginnings that one model weighs, at most.
MAX_FEATURES = 6_000
FOLDS = 3
#: Rows that are sent to a fit at a time.
FIT_BATCH = 500
RIDGE = 0.02
#: A feature counts from this many standard errors, and from this share of the clearest one's.
LEAST_Z, CLEAR_SHARE = 3.0, 0.15
#: Weight of a row of the positive class, at most; a row of the negative class weighs 1.
MAX_CLASS_WEIGHT = 4.0
#: Word beginnings that count as features: stems stay visible under any ending.
PREFIXES = (4, 6)
THRESHOLD = 0.5
_TOKEN = re.compile(r"\w+")


@dataclass(frozen=True)
class Link:
    """One linear model: a weight for each feature and for the log-odds of each earlier link."""

    category: str
    weights: dict[str, float]
    earlier: tuple[float, ...]
    bias: float

    def logit(self, features: Sequence[str], before: Sequence[float]) -> float:
        get = self.weights.get
        total = sum([get(f, 0.0) for f in features], self.bias)
        return total + sum(w * x for w, x in zip(self.earlier, before))


def features(text: str | None) -> list[str]:
    """Distinct lower-cased words of the text, and their beginnings marked by `*`."""
    found = set(_TOKEN.findall((text or "").lower()))
    for n in PREFIXES:
        found |= {w[:n] + "*" for w in found if len(w) > n and w[-1] != "*"}
    return list(found)


def shared_features(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """The features of one text after the other; those of several texts are one string."""
    known: dict[str, str] = {}
    for t in texts:
        yield [known.setdefault(f, f) for f in features(t)]


def _numbered(rows: Iterable[list[str]]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct features, and for each row the numbers of its own, which bounds the memory of a fit."""
    numbers: dict[str, int] = {}
    cols = [np.array([numbers.setdefault(f, len(numbers)) for f in r], dtype=np.int32) for r in rows]
    return list(numbers), cols


def _probability(logit: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def _squash(logit: float) -> float:
    """Log-odds as a later link sees them."""
    return max(-4.0, min(4.0, logit))


def _counts(cols: list[np.ndarray], names: int) -> np.ndarray:
    """In how many rows each feature is."""
    total = np.zeros(names, dtype=np.int64)
    for c in cols:
        total[c] += 1
    return total


def select_features(names: list[str], cols: list[np.ndarray], y: np.ndarray) -> list[int]:
    """The numbers of the features whose share differs most, in standard errors, between the classes."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return []
    ones, all_rows = _counts([c for c, label in zip(cols, y) if label], len(names)), _counts(cols, len(names))
    known = np.flatnonzero(all_rows >= 2)
    n, one = all_rows[known], ones[known]
    share = n / len(y)
    error = np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    z = np.abs((one / n1 - (n - one) / n0) / np.where(error > 0, error, 1.0))
    least = max(LEAST_Z, CLEAR_SHARE * z.max()) if len(z) else 0.0
    clear = z >= least
    scored = sorted(zip((-z[clear]).tolist(), [names[k] for k in known[clear]], known[clear].tolist()))
    return [k for _, _, k in scored[:MAX_FEATURES]]


def fit_linear(
    rows: Iterable[list[str]], before: np.ndarray, y: np.ndarray, rounds: int = 400
) -> tuple[dict[str, float], tuple[float, ...], float]:
    """Logistic regression with a ridge penalty by accelerated gradient steps.

    `before` has the earlier log-odds, a column for each earlier link; where no word tells the
    classes apart they are all there is. With one class only the model is the smoothed base rate.
    """
    known, cols = _numbered(rows)
    chosen = select_features(known, cols, y)
    names = [known[k] for k in chosen]
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    if not 0 < y.sum() < len(y) or not (names or before.shape[1]):
        return {}, (0.0,) * before.shape[1], math.log(rate / (1 - rate))
    place = np.full(len(known), -1)
    place[chosen] = np.arange(len(names))
    cols = [found[found >= 0] for found in (place[c] for c in cols)]
    del known, place
    n, dims = len(cols), len(names)
    lengths = np.array([len(c) for c in cols])
    flat, owner = np.concatenate(cols), np.repeat(np.arange(n), lengths)
    scale = 1.0 / math.sqrt(max(1.0, lengths.mean()))
    w, b, v = np.zeros(dims), math.log(rate / (1 - rate)), np.zeros(before.shape[1])
    # A bound on the curvature of the mean loss gives the step.
    squares = lengths * scale**2 + (before**2).sum(axis=1) + 1
    ridge = RIDGE / n
    # Both classes weigh alike, up to a factor, as the rarer one is what is looked for.
    heavy = min(MAX_CLASS_WEIGHT, max(1.0, (n - y.sum()) / max(1.0, y.sum())))
    weight = np.where(y > 0, heavy, 1.0)
    step = 1.0 / (0.25 * np.percentile(squares, 99) * weight.mean() + ridge)
    old, t = (w, b, v), 1.0
    look = old
    for _ in range(rounds):
        lw, lb, lv = look
        margin = np.bincount(owner, lw[flat], n) * scale + before @ lv + lb
        gap = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * weight
        gw = np.bincount(flat, gap[owner], dims) * scale / n + ridge * lw
        new = (lw - step * gw, lb - step * gap.mean(), lv - step * (before.T @ gap) / n)
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look = tuple(a + (t - 1) / t_next * (a - o) for a, o in zip(new, old))
        old, t = new, t_next
    w, b, v = old
    return dict(zip(names, (w * scale).tolist())), tuple(v.tolist()), float(b)


_FIT_SCHEMA = "model int, keys array<string>, weights array<double>, earlier array<double>, bias double"


def _fit_group(links: list[Link], category: str):
    """Fits the model of one group: group k < FOLDS leaves out fold k, group FOLDS nothing."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        k = int(group["_model"].iloc[0])
        group = group.sort_values("_row")
        rows = shared_features(group["_text"])
        before = np.array([list(x) for x in group["_before"]], dtype=float).reshape(len(group), len(links))
        weights, earlier, bias = fit_linear(rows, before, group[category].to_numpy(dtype=float))
        return pd.DataFrame(
            {
                "model": [k],
                "keys": [list(weights)],
                "weights": [list(weights.values())],
                "earlier": [list(earlier)],
                "bias": [bias],
            }
        )

    return fit


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    key: str = "doc_id",
    text: str = "text",
    limit: int = MAX_LABELLED,
) -> DataFrame:
    """Labelled texts for training: `limit` keys at most, by hash.

    `categories` maps names to conditions over the columns of `labels`. Rows with a null key or
    an unknown label are left out; of several rows for a key any is used, the same in each run.
    """
    named = [F.expr(rule).cast("int").alias(f"_y{i}") for i, rule in enumerate(categories.values())]
    known = labels.select(F.col(key).alias("_row"), *named).dropna()
    once = known.groupBy("_row").agg(*[F.max(f"_y{i}").alias(f"_y{i}") for i in range(len(named))])
    chosen = once.orderBy(F.xxhash64("_row"), "_row").limit(limit)
    texts = docs.select(F.col(key).alias("_row"), F.col(text).alias("_text"))
    # At most `limit` narrow rows: a proven bound for the broadcast.
    found = texts.join(F.broadcast(chosen), "_row")
    return found.groupBy("_row").agg(
        F.min("_text").alias("_text"), *[F.max(f"_y{i}").alias(f"_y{i}") for i in range(len(named))]
    )


def fit_chain(sample: DataFrame, categories: Sequence[str], folds: int = FOLDS) -> list[Link]:
    """The links of the chain, fitted in order on a sample from `labelled_sample`."""
    links: list[Link] = []
    fold = F.pmod(F.xxhash64(F.col("_row"), F.lit(7)), F.lit(folds)).cast("int")
    rows = sample.withColumn("_fold", fold).withColumn("_before", F.array().cast("array<double>"))
    for i, category in enumerate(categories):
        models = F.explode(F.sequence(F.lit(0), F.lit(folds))).alias("_model")
        dealt = rows.select("*", models).where(F.col("_model") != F.col("_fold"))
        grouped = dealt.groupBy("_model").applyInPandas(_fit_group(links, f"_y{i}"), _FIT_SCHEMA)
        with arrow_rows(sample.sparkSession, FIT_BATCH):
            fitted = grouped.collect()
        by_model = {
            r["model"]: Link(category, dict(zip(r["keys"], r["weights"])), tuple(r["earlier"]), r["bias"])
            for r in fitted
        }
        base = Link(category, {}, (0.0,) * i, -2.0)
        links.append(by_model.get(folds, base))
        if i + 1 < len(categories):
            rows = rows.withColumn("_before", _out_of_fold(by_model, base)("_text", "_fold", "_before"))
    return links


def _by_row(function: Callable[..., list[float]]) -> Callable[..., Column]:
    """A UDF that gets few rows at a time: batches of Arrow would hold thousands of whole texts."""
    return F.udf(function, "array<double>", useArrow=False)


def _out_of_fold(by_model: dict[int, Link], base: Link):
    """Appends the log-odds by the model that left the row's fold out."""

    def append(text: str | None, fold: int, before: list[float]) -> list[float]:
        return [*before, _squash(by_model.get(fold, base).logit(features(text), before))]

    return _by_row(append)


def _scores(links: list[Link], text: Column) -> Column:
    """The probability of each category, in the order of the chain."""
    kept = frozenset().union(*[link.weights for link in links])

    def score(text: str | None) -> list[float]:
        found = sorted(kept.intersection(features(text)))
        before: list[float] = []
        given = []
        for link in links:
            logit = link.logit(found, before)
            before.append(_squash(logit))
            given.append(_probability(logit))
        return given

    return _by_row(score)(text)


def score_chain(docs: DataFrame, links: list[Link], text: str = "text") -> DataFrame:
    """`docs` with a column `p_<category>` for each link; columns of that name are replaced.

    A null or empty text has no features and gets what the biases of the chain give.
    """
    (p,) = fresh(docs, "_p")
    scored = docs.withColumn(p, _scores(links, F.col(f"`{text}`")))
    return scored.withColumns(
        {f"p_{link.category}": F.col(p)[i] for i, link in enumerate(links)}
    ).drop(p)


#: The chain of the queries: low quality first, then toxicity, as conditions on `labels`.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    source: DataFrame | None = None,
    categories: dict[str, str] = CATEGORIES,
    threshold: float = THRESHOLD,
    limit: int = MAX_LABELLED,
) -> DataFrame:
    """`docs` with the probabilities of the chain and `is_toxic`, the verdict of its last link.

    `source` has the texts of the labelled rows, by default `docs`. Without labelled rows
    nothing is toxic. Repeated rows get equal scores; a null key has no part in the training.
    """
    sample = labelled_sample(docs if source is None else source, labels, categories, limit=limit)
    links = fit_chain(sample, list(categories))
    last = list(categories)[-1]
    return score_chain(docs, links).withColumn("is_toxic", F.col(f"p_{last}") >= threshold)
