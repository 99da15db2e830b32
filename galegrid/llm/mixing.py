"""Mixing of sources to target weights by entropy balancing.

Each source gets a target number of words (`source_targets`). Document rates come from entropy
balancing: of all rates from 0 to 2 whose words add up to the target of each source, those
nearest to 1 in relative entropy. They are exponentially tilted, `min(2, exp(l * size / mean))`,
with one multiplier `l` for each source, found by Newton steps on the convex dual. A step is one
aggregate over how often each size occurs in a source, so its cost follows the sizes, not the
documents, and all sources take it together.

Rates are rounded into whole copies: the whole part is certain; who gets one copy more goes by
a hash of the key against the fraction, up to the words that the source still lacks; what is
left then goes to the documents that fill it best. Sums are taken over whole numbers, so reruns
agree whatever order Spark adds in. Only Spark functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import checked_join
from ..session import cut_lineage
from .common import WORD

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
TOLERANCE = 1e-7
MAX_STEPS = 60
BUCKETS = 256
#: Passes over the documents; each tells priorities apart BUCKETS times finer.
NARROWING = 4
FILL_ROUNDS = 5
_SCALE = 1_000_000
_EXACT = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Words parted by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _exact_sum(value: Column) -> Column:
    """A sum of doubles that does not depend on their order, to a millionth."""
    return (F.sum(F.round(value * _SCALE).cast(_EXACT)) / _SCALE).cast("double")


def _ranked(sources: DataFrame) -> DataFrame:
    """`sources` with `sid`, counting from 0 in the order of `name`, without a single task."""
    ordered = cut_lineage(sources.orderBy("name").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    # One row for each partition of the sort.
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("sid", F.col("_before") + inside).drop("_at", "_part", "_before")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT
) -> DataFrame:
    """(name, sid, source_size, target) from rows (name, size).

    Sources in the order of their name weigh `weights`, repeating, and share `percent` of all
    words. A target stops at MOST_COPIES times its source's words; the excess is shared again by
    weight until none is above.
    """
    summed = sizes.groupBy("name").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(summed)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    table = cut_lineage(
        ranked.withColumn("weight", F.get(cycle, (F.col("sid") % len(weights)).cast("int")))
    )
    most = F.col("source_size") * MOST_COPIES
    total = (table.agg(F.sum("source_size").alias("all")).first()["all"] or 0) * percent / 100
    level, stopped_before = 0.0, -1
    while True:
        # Sources that stop at this level stay stopped, as the level only rises.
        stops = most.cast("double") <= F.lit(level) * F.col("weight")
        now = table.agg(
            F.sum(F.when(stops, most).otherwise(0)).alias("taken"),
            F.sum(F.when(stops, 0).otherwise(F.col("weight"))).alias("weight"),
            F.count_if(stops).alias("stopped"),
        ).first()
        if now["stopped"] == stopped_before or not now["weight"]:
            break
        stopped_before = now["stopped"]
        level = max(level, (total - now["taken"]) / now["weight"])
    target = F.least(most.cast("double"), F.lit(level) * F.col("weight"))
    return cut_lineage(table.select("name", "sid", "source_size", target.alias("target")))


def _rate(multiplier: str, size: str, mean: str) -> Column:
    """The tilted rate; 1 for documents without words."""
    tilt = F.col(multiplier) * F.col(size) / F.col(mean)
    return F.when(F.col(size) > 0, F.least(F.lit(float(MOST_COPIES)), F.exp(tilt))).otherwise(1.0)


def multipliers(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(sid, mean, multiplier): the solution of the dual, from rows (sid, size).

    Newton steps, kept inside a bracket that the sizes prove: between rates all at most the
    share of the target (below 1) and rates all at the top (above 1). A source whose target is
    the top exactly gets the upper end of the bracket.
    """
    histogram = cut_lineage(
        sizes.where("size > 0").groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n"))
    )
    facts = histogram.groupBy("sid").agg(
        F.min("size").alias("least"), (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean")
    )
    share = F.col("target") / F.col("source_size")
    start = targets.where("target > 0").join(facts, "sid")
    top = F.log(F.lit(float(MOST_COPIES))) * F.col("mean") / F.col("least")
    bottom = F.log(share) * F.col("mean") / F.col("least")
    state = cut_lineage(
        start.select(
            "sid", "target", "mean",
            F.least(bottom, F.lit(0.0)).alias("lo"),
            F.when(share > 1, top).otherwise(0.0).alias("hi"),
            F.when(share >= MOST_COPIES, top).otherwise(F.log(share)).alias("multiplier"),
            (share >= MOST_COPIES).alias("done"),
        )
    )
    for _ in range(MAX_STEPS):
        if state.where("not done").isEmpty():
            break
        rows = checked_join(histogram, state, ["sid"], ["size"])
        rate = _rate("multiplier", "size", "mean")
        mass = F.col("n") * F.col("size") * rate
        sums = rows.groupBy("sid").agg(
            _exact_sum(mass).alias("sum"),
            _exact_sum(F.when(rate < MOST_COPIES, mass * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("sum") - F.col("target")
        lo = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("hi"))
        newton = F.col("multiplier") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > lo) & (newton < hi)
        met = F.col("done") | (F.abs(gap) <= F.lit(TOLERANCE) * F.col("target"))
        step = F.when(met, F.col("multiplier")).when(inside, newton).otherwise((lo + hi) / 2)
        state = cut_lineage(
            state.join(sums, "sid").select(
                "sid", "target", "mean", lo.alias("lo"), hi.alias("hi"), step.alias("multiplier"), met.alias("done")
            )
        )
    return state.select("sid", "mean", "multiplier")


def _priorities(docs: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows (key, sid, size) with whole copies `base` and `order`; the least orders go first."""
    rated = checked_join(docs, solved, ["sid"], ["key"], "left")
    rate = F.when(F.col("multiplier").isNull(), 0.0).otherwise(_rate("multiplier", "size", "mean"))
    with_rate = rated.select("key", "sid", "size", F.round(rate, 9).alias("rate"))
    base = F.floor("rate").cast("bigint")
    fraction = F.col("rate") - base
    uniform = (F.pmod(F.xxhash64("key", "size"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    order = F.when((fraction > 0) & (F.col("size") > 0), uniform / fraction)
    # A sequential sample: expected cut at 1, so this keeps the orders in a bounded range.
    return with_rate.select("key", "sid", "size", base.alias("base"), (order / (order + 1)).alias("order"))


def _cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(sid, cut, gap): documents with an order below `cut` get a copy more, `gap` words still lack."""
    sure = rows.groupBy("sid").agg(F.sum(F.col("base") * F.col("size")).alias("sure"))
    state = targets.join(sure, "sid").select(
        "sid", F.lit(0.0).alias("cut"), (F.col("target") - F.col("sure")).alias("gap")
    )
    state = cut_lineage(state)
    open_rows = rows.where("order is not null")
    width = 1.0
    for _ in range(NARROWING):
        step = width / BUCKETS
        near = checked_join(open_rows, state, ["sid"], ["key"])
        inside = near.where((F.col("order") >= F.col("cut")) & (F.col("order") < F.col("cut") + F.lit(width)))
        bucket = F.least(F.floor((F.col("order") - F.col("cut")) / F.lit(step)), F.lit(BUCKETS - 1))
        sums = inside.groupBy("sid", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        # At most BUCKETS rows for each source.
        upto = Window.partitionBy("sid").orderBy("bucket")
        added = sums.withColumn("upto", F.sum("words").over(upto))
        full = added.join(state, "sid").where(F.col("upto") <= F.col("gap"))
        best = full.groupBy("sid").agg(F.max("bucket").alias("bucket"), F.max("upto").alias("upto"))
        # The first bucket that does not fit is looked into next; empty buckets before it are passed.
        over = added.join(state, "sid").where(F.col("upto") > F.col("gap"))
        first = over.groupBy("sid").agg(F.min("bucket").alias("next"))
        state = cut_lineage(
            state.join(best, "sid", "left").join(first, "sid", "left").select(
                "sid",
                F.when(F.col("next").isNotNull(), F.col("cut") + F.col("next") * F.lit(step))
                .otherwise(F.col("cut") + F.lit(width)).alias("cut"),
                (F.col("gap") - F.coalesce("upto", F.lit(0))).alias("gap"),
            )
        )
        width = step
    return state


def _filled(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """(key, sid, size, copies): whole copies, one more below the cut, and those that fill the gap best."""
    raised = checked_join(rows, cuts.select("sid", "cut"), ["sid"], ["key"], "left")
    copies = F.col("base") + F.coalesce(F.col("order") < F.col("cut"), F.lit(False)).cast("bigint")
    given = cut_lineage(raised.select("key", "sid", "size", copies.alias("copies")))
    gaps = cuts.select("sid", "gap")
    extra: DataFrame | None = None
    spare = given.where((F.col("copies") < MOST_COPIES) & (F.col("size") > 0))
    for k in range(FILL_ROUNDS):
        free = spare if extra is None else checked_join(spare, extra, ["key"], ["key"], "left_anti")
        last = k == FILL_ROUNDS - 1
        near = checked_join(free, gaps, ["sid"], ["key"])
        if last:
            fits = near.where((F.col("gap") > 0) & (F.col("size") < F.col("gap") * 2))
            score = -F.abs(F.col("size") - F.col("gap"))
        else:
            fits, score = near.where(F.col("size") <= F.col("gap")), F.col("size").cast("double")
        best = fits.groupBy("sid").agg(F.max(F.struct(score, F.xxhash64("key"), "key", "size")).alias("b"))
        chosen = cut_lineage(best.select("sid", F.col("b.key").alias("key"), F.col("b.size").alias("size")))
        gaps = cut_lineage(
            gaps.join(chosen.select("sid", F.col("size").alias("_s")), "sid", "left").select(
                "sid", (F.col("gap") - F.coalesce("_s", F.lit(0))).alias("gap")
            )
        )
        keys = chosen.select("key")
        extra = cut_lineage(keys if extra is None else extra.unionByName(keys))
    marked = checked_join(given, extra.distinct().withColumn("_more", F.lit(1)), ["key"], ["key"], "left")
    more = F.least(F.col("copies") + F.coalesce("_more", F.lit(0)), F.lit(MOST_COPIES))
    return marked.select("key", "sid", "size", more.alias("copies"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    percent: int = SHARE_PERCENT,
) -> DataFrame:
    """Per row of `docs`: the key, size, source_size, target, copies and taken (copies * size).

    A null source is a source of its own, the last one; null texts have no words. Documents
    without words are taken once, which adds nothing. Rows that repeat a key and a size get equal
    copies. A row with a null key is never among those that fill a gap.
    """
    named = F.coalesce(F.concat(F.lit("0"), F.col(f"`{source}`")), F.lit("1")).alias("name")
    sized = cut_lineage(
        docs.select(F.col(f"`{key}`").alias("key"), named, word_count(F.col(f"`{text}`")).alias("size"))
    )
    targets = source_targets(sized.select("name", "size"), weights, percent)
    by_source = targets.select("name", "sid")
    rows = cut_lineage(checked_join(sized, by_source, ["name"], ["key"]).select("key", "sid", "size"))
    solved = multipliers(rows, targets)
    ordered = cut_lineage(_priorities(rows, solved))
    given = _filled(ordered, _cuts(ordered, targets))
    out = checked_join(given, targets.select("sid", "source_size", "target"), ["sid"], ["key"])
    return out.select(
        F.col("key").alias(key), "size", "source_size", "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )
