"""URL filter: rules over hosts and paths, and gradient-boosted trees over lexical features.

A rule names a host, its subdomains included, and how the path starts; the longest rule that
fits decides. Every other URL is judged by boosted trees on what the URL looks like: lengths,
depth, shares of digits and other characters, entropy, parameters, and how the host's suffixes
fared among the labelled URLs. The trees are trained on a bounded sample of the labelled URLs
(`MAX_LABELLED`, taken by a hash, so reruns agree). All URLs are scored. Only Spark's functions
and Spark ML's trees are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Labelled URLs that the trees are trained on, at most; also the bound of the suffix table.
MAX_LABELLED = 20_000
THRESHOLD = 0.5
TREES, DEPTH, SEED = 16, 4, 7
#: Rows in a leaf, and what a split must gain, at least: labels say little about most URLs.
LEAST_LEAF, LEAST_GAIN = 40, 0.003
#: Rows of no opinion that a suffix's rate is smoothed by.
SMOOTHING = 20.0
#: The rules of the query: what they say, and where.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
_SPECIAL = "-_.~%=&?;,+@"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and what it says; null where none does.

    Of equally long rules the first one wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, where in sorted(rules, key=lambda r: len(r[1])):  # later ones go before
        name, slash, start = where.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, F.lit(where)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.split(text, "")
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)))
    total = F.greatest(F.size(chars), F.lit(1)).cast("double")
    return F.aggregate(
        counts, F.lit(0.0), lambda a, n: a - n / total * F.log2(n / total)
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """`df` with `host`, `path` and a column `f_<name>` for each feature of the URL."""
    text = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    placed = df.withColumns({"host": host(F.col(f"`{url}`")), "path": path(F.col(f"`{url}`"))})
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    length = F.greatest(F.char_length(text), F.lit(1))
    return placed.withColumns(
        {
            "f_length": F.char_length(text).cast("double"),
            "f_host_length": F.char_length("host").cast("double"),
            "f_path_length": F.char_length("path").cast("double"),
            "f_labels": _count(F.col("host"), r"\."),
            "f_depth": _count(F.col("path"), "/[^/]"),
            "f_digits": _count(text, "[0-9]") / length,
            "f_host_digits": _count(F.col("host"), "[0-9]"),
            "f_hyphens": _count(F.col("host"), "-"),
            "f_special": _count(text, "[" + _SPECIAL.replace("-", r"\-") + "]") / length,
            "f_parameters": _count(query, "[^&=]+=") + F.when(query != "", 1).otherwise(0),
            "f_fragment": F.contains(text, F.lit("#")).cast("double"),
            "f_secure": F.startswith(text, F.lit("https:")).cast("double"),
            "f_entropy": _entropy(text),
            "f_host_entropy": _entropy(F.col("host")),
            "_top": F.substring_index("host", ".", -1),
            "_domain": F.substring_index("host", ".", -2),
        }
    )


_SUFFIXES = {"_top": "f_top_rate", "_domain": "f_domain_rate", "host": "f_host_rate"}


def suffix_rates(sample: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """For each kind of suffix a table of its labels; at most one row for each sampled URL."""
    rate = sample.agg(F.avg(label).alias("r")).first()["r"] or 0.0
    return {
        suffix: cut_lineage(
            sample.groupBy(suffix)
            .agg(F.sum(label).alias("_bad"), F.count(F.lit(1)).alias("_n"))
            .withColumn("_rate", F.lit(float(rate)))
        )
        for suffix in _SUFFIXES
    }


def _with_rates(df: DataFrame, rates: dict[str, DataFrame]) -> DataFrame:
    """`df` with the suffix features: smoothed rates of the label."""
    for suffix, feature in _SUFFIXES.items():
        # Bounded by MAX_LABELLED rows.
        df = df.join(F.broadcast(rates[suffix]), suffix, "left")
        bad, n = F.coalesce("_bad", F.lit(0)), F.coalesce("_n", F.lit(0))
        base = F.coalesce("_rate", F.lit(0.0))
        df = df.withColumn(feature, (bad + SMOOTHING * base) / (n + SMOOTHING)).drop("_bad", "_n", "_rate")
    return df


def labelled_urls(pages: DataFrame, labels: DataFrame, url: str = "url", limit: int = MAX_LABELLED) -> DataFrame:
    """(url, label): 1 where the document that the URL's path names was found bad.

    The document is the number that is a whole segment of the path, `.html` allowed. Distinct
    URLs, `limit` at most.
    """
    named = F.regexp_extract(path(F.col(f"`{url}`")), r"/([0-9]{1,18})(?:/|\.html|$)", 1)
    doc_id = F.nullif(named, F.lit("")).cast("bigint").alias("doc_id")
    with_id = pages.select(F.col(f"`{url}`").alias("url"), doc_id)
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("double")
    known = labels.select("doc_id", bad.alias("label")).dropna()
    found = with_id.where("doc_id is not null").join(known, "doc_id").groupBy("url").agg(F.max("label").alias("label"))
    return found.orderBy(F.xxhash64("url"), "url").limit(limit)


class UrlModel:
    """Boosted trees with the suffix tables they were trained with; no trees without labels."""

    def __init__(self, rates, features, trees):
        self.rates, self.features, self.trees = rates, features, trees

    def score(self, df: DataFrame) -> DataFrame:
        """`df`, from `lexical`, with `p_block`, the probability of a bad URL."""
        if self.trees is None:
            return df.withColumn("p_block", F.lit(0.0))
        rated = _with_rates(df, self.rates)
        made = VectorAssembler(inputCols=self.features, outputCol="_features").transform(rated)
        scored = self.trees.transform(made)
        return scored.withColumn("p_block", vector_to_array("_probability")[1])


def train(sample: DataFrame, trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    """Trees from rows (url, label).

    One half of the rows, by hash, gives the suffix rates and the other half the trees: rates of
    rows that the trees learn from would tell them the label.
    """
    rows = cut_lineage(lexical(sample))
    if rows.isEmpty():
        return UrlModel({}, [], None)
    features = [c for c in rows.columns if c.startswith("f_")] + list(_SUFFIXES.values())
    first = F.pmod(F.xxhash64("url", F.lit(SEED)), F.lit(2)) == 0
    rates = suffix_rates(rows.where(first))
    rated = _with_rates(rows.where(~first), rates)
    if rated.isEmpty():
        return UrlModel({}, [], None)
    made = VectorAssembler(inputCols=features, outputCol="_features").transform(rated).select("_features", "label")
    learner = GBTClassifier(
        featuresCol="_features", labelCol="label", predictionCol="_prediction",
        maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=LEAST_LEAF, minInfoGain=LEAST_GAIN, seed=SEED,
    )
    learner = learner.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    return UrlModel(rates, features, learner.fit(cut_lineage(made)))


def judge(
    pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row of `pages`: the key, host, path, rule, verdict (allow or block) and p_block.

    A null URL, or one without `://`, has an empty host and path, which no rule fits.
    """
    rows = lexical(pages.select(F.col(f"`{key}`"), F.col(f"`{url}`").alias("url")))
    scored = model.score(rows)
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(says, F.when(F.col("p_block") >= THRESHOLD, "block").otherwise("allow"))
    return scored.select(key, "host", "path", rule.alias("rule"), verdict.alias("verdict"), "p_block")
