"""The corpus pipeline: stages that filter, clean, thin out and mix `documents`.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but
the last return the columns of `documents`; the last adds the mix. A stage begins when the result of
the one before is written, so what that one staged on the way is deleted then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galegrid.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from galegrid.llm.common import columns_of, table
from galegrid.operators.skew import checked_join
from galegrid.session import cut_lineage, free_owned, owned_by

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    """Free what earlier stages staged, unless `docs` still reads it, and own what this one stages."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_owned(spark, __name__, unless_read_by=docs)
        with owned_by(__name__):
            return function(spark, docs, sf_dir)

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the classifier chain rejects go.

    The chain is trained on the labelled rows of `documents`; a document without text is kept.
    """
    labels, source = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    scored = toxicity.toxicity(docs, labels, source=source)
    return columns_of(scored.where(~F.col("is_toxic") | (F.length(F.coalesce("text", F.lit(""))) == 0)), docs)


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: passages that repeat earlier text are deleted from the texts.

    `n_chars` becomes the length that is left. A document that was nothing but repeats, a copy of
    earlier ones, goes; one that had no text before stays.
    """
    cleaned = line_dedup.line_dedup(docs)
    left = cleaned.where((F.col("n_runs") == 0) | (F.length(F.btrim("text", F.lit(" \t\r\n"))) > 0))
    return columns_of(left.withColumn("n_chars", F.when(F.col("n_runs") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))), docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: of each group that links at 80 % of 5-word shingles the least key stays.

    Documents without words, and rows without key, stay.
    """
    joined = ngram_join.ngram_jaccard(docs.select("doc_id", "text"), size=5, percent=80)
    others = joined.where("component_id <> doc_id").select("doc_id").distinct()
    return checked_join(docs, cut_lineage(others), ["doc_id"], ["doc_id"], "left_anti")


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents that overlap with a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: the documents with their size, their source's target, copies and words taken.

    This is the plan of the mix: a document that the mix leaves out has no copies, one that it
    takes twice has two; its row stays, once. Rows are told apart by key, text and source, so
    that those with a null or repeated key have numbers of their own.
    """
    of = ["doc_id", "text", "source"]
    rows = docs.withColumn("_row", F.xxhash64(*of, *[F.col(c).isNull() for c in of]))
    mixed = mixing.mix(rows, key="_row")
    known = mixed.dropDuplicates(["_row"])  # rows with one `_row` are equal and have equal numbers
    return checked_join(rows, cut_lineage(known), ["_row"], ["_row"], "left").select(
        *[F.col(c) for c in docs.columns], "size", "source_size", "target", "copies", "taken"
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The classifier of the first stage cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`; each result is written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
