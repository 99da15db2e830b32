"""Benchmark decontamination by spaced-seed hashing.

A mask looks at some positions of a short span of words and ignores the others, so that a
passage is still found when words at ignored positions were replaced. The hashes of all spans
of the corpus under each mask are joined to those of the benchmark. A hit fixes how document
and item lie upon each other; around it the words are compared one by one, and a window of
WINDOW words with at most ERRORS replaced ones is an overlap.

The two masks are lossless for that window: wherever the replaced words lie in it, one of the
masks fits between them. Items shorter than the window must occur whole and unchanged. Only
Spark functions are used. The benchmark's hashes are broadcast after their size was measured,
else the join shuffles and splits hashes with very many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import checked_join
from ..session import cut_lineage
from .common import lower_ascii, words

WINDOW = 13
ERRORS = 2
#: Offsets that a mask looks at. For any two positions of a window of 13 there is a mask and a
#: place of it in the window that looks at neither.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 5, 6, 7, 8))
#: Items with fewer words prove no leak and are left out.
LEAST_WORDS = 5


def word_hashes(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """(`name`, h): hashes of the lower-cased words; rows without key go."""
    hashed = F.transform(words(lower_ascii(F.col(f"`{text}`"))), lambda w: F.xxhash64(w))
    return df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias(name), hashed.alias("h"))


def _masks(lengths: list[int]) -> list[tuple[int, ...]]:
    """The spaced masks, and one for each length of shorter items that looks at all words."""
    return [*MASKS, *[tuple(range(n)) for n in sorted(lengths)]]


def seeds(hashed: DataFrame, name: str, masks: list[tuple[int, ...]]) -> DataFrame:
    """(`name`, pos, seed) for each span and mask; pos counts from 0."""
    span = max(m[-1] for m in masks) + 1
    size = F.size("h")
    shifted = [F.slice("h", F.lit(k + 1), F.greatest(size, F.lit(1))).alias(f"h{k}") for k in range(span)]
    zipped = F.arrays_zip(F.sequence(F.lit(0), size - 1).alias("pos"), *shifted)
    rows = hashed.where(size > 0).select(name, F.inline(zipped).alias("pos", *[f"h{k}" for k in range(span)]))
    made = [
        F.when(F.col(f"h{mask[-1]}").isNotNull(), F.xxhash64(F.lit(i), *[F.col(f"h{k}") for k in mask]))
        for i, mask in enumerate(masks)
    ]
    return rows.select(name, "pos", F.explode(F.array(*made)).alias("seed")).where("seed is not null")


def _best_window(equal: Column) -> Column:
    """The window with most equal words: how many, and minus its start (the first of several)."""
    width = F.least(F.size(equal), F.lit(WINDOW))
    starts = F.sequence(F.lit(0), F.size(equal) - width)
    counted = F.transform(
        starts,
        lambda s: F.struct(
            F.aggregate(F.slice(equal, s + 1, width), F.lit(0), lambda a, x: a + x).alias("same"), (-s).alias("back")
        ),
    )
    return F.array_max(counted)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs (`key`, `item_key`) that overlap, with the best overlap of each.

    `start` and `item_start` are the word positions, from 0, of its window, `n_words` the window's
    length and `n_equal` the words that agree; of equally good overlaps it is the first in the
    document, then in the item. Words are parted by ASCII white space and compared with A-Z
    lower-cased. Null or empty texts and null keys overlap with nothing; rows repeated in full
    give one pair.
    """
    item_words = cut_lineage(
        word_hashes(items, item_key, item_text, "item").where(F.size("h") >= LEAST_WORDS).distinct()
    )
    short = item_words.where(F.size("h") < WINDOW).select(F.size("h").alias("n")).distinct()
    masks = _masks([r["n"] for r in short.collect()])  # fewer than WINDOW numbers
    long_seeds = seeds(item_words.where(F.size("h") >= WINDOW), "item", MASKS)
    wanted = long_seeds
    for i in range(len(MASKS), len(masks)):
        whole = F.xxhash64(F.lit(i), *[F.get("h", F.lit(k)) for k in masks[i]])
        exact = item_words.where(F.size("h") == len(masks[i]))
        wanted = wanted.unionByName(exact.select("item", F.lit(0).alias("pos"), whole.alias("seed")))
    wanted = cut_lineage(wanted.select("seed", "item", F.col("pos").alias("at")).distinct())
    # The join carries each seed once; items that share it are looked up for the hits only.
    known = wanted.select("seed").distinct()
    found = checked_join(seeds(word_hashes(docs, key, text, "doc"), "doc", masks), known, ["seed"], ["doc", "pos"])
    hits = cut_lineage(found)
    lying = checked_join(hits, wanted, ["seed"], ["doc", "pos"])
    placed = cut_lineage(lying.select("doc", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct())
    return _overlaps(docs, placed, item_words, key, text).select(
        F.col("doc").alias(key), F.col("item").alias(item_key),
        F.col("best.start").alias("start"), F.col("best.item_start").alias("item_start"),
        F.col("best.n_words").alias("n_words"), F.col("best.n_equal").alias("n_equal"),
    )


def _overlaps(docs: DataFrame, placed: DataFrame, item_words: DataFrame, key: str, text: str) -> DataFrame:
    """The best overlap of each pair of document and item among its placings."""
    hit_docs = placed.select(F.col("doc").alias(key)).distinct()
    texts = checked_join(docs.select(key, text), cut_lineage(hit_docs), [key], [key], "left_semi")
    doc_words = word_hashes(texts, key, text, "doc")
    by_item = checked_join(placed, item_words.withColumnRenamed("h", "i"), ["item"], ["doc", "shift"])
    both = by_item.join(doc_words, "doc")
    low = F.greatest(F.lit(0), -F.col("shift"))
    size = F.greatest(F.least(F.size("i"), F.size("h") - F.col("shift")) - low, F.lit(0))
    own = F.slice("h", low + F.col("shift") + 1, size)
    their = F.slice("i", low + 1, size)
    equal = F.zip_with(own, their, lambda a, b: (a == b).cast("int"))
    needed = F.least(F.size("i"), F.lit(WINDOW))
    marked = both.select("doc", "item", "shift", needed.alias("needed"), low.alias("low"), equal.alias("e"))
    # Enough equal words at all, before windows are looked at.
    enough = F.aggregate("e", F.lit(0), lambda a, x: a + x) >= F.col("needed") - ERRORS
    best = marked.where((F.size("e") >= F.col("needed")) & enough).withColumn("w", _best_window(F.col("e")))
    errors = F.when(F.col("needed") < WINDOW, 0).otherwise(ERRORS)
    over = best.where(F.col("w.same") >= F.col("needed") - errors)
    at = F.col("low") - F.col("w.back")
    entry = F.struct(
        F.col("w.same").alias("n_equal"),
        (-(at + F.col("shift"))).alias("first"),
        (-at).alias("item_first"),
        (at + F.col("shift")).cast("bigint").alias("start"),
        at.cast("bigint").alias("item_start"),
        F.col("needed").alias("n_words"),
    )
    return over.groupBy("doc", "item").agg(F.max(entry).alias("best"))


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the documents that overlap with an item; a null key is kept."""
    found = leaks(docs, items, key, text)
    return checked_join(docs, cut_lineage(found.select(key).distinct()), [key], [key], "left_anti")
