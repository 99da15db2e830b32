"""Exact Jaccard join of word n-gram sets by partitioning the universe of tokens.

A set's tokens (word shingles as 64-bit hashes) are dealt by hash into segments. Two sets whose
Jaccard similarity reaches the threshold differ in at most H tokens, where H follows from their
size band; by the pigeonhole principle they agree on a segment, or differ there by one token
where a segment counts double. Signatures are therefore the subset of a segment, and for
segments that count double also the subsets without one of their tokens (the one-deletion
neighbourhood). `allocate` picks for a band how many segments are of either kind, by a cost
model; the segments with the fewest tokens, which unrelated sets share, are left out, one for
each spare segment. What shares a signature and is not ruled out by its size or
by a parity sketch, which bounds how many tokens differ, is verified exactly.

Bands grow by the threshold, so that a set meets sets of its own and the next band only: each
set has signatures under the scheme of its band and of the one below.

Equal sets are joined as one. Within the sets that share a signature the one that shares most
with others is the pivot: the rest is verified against it, unless other links have joined them by then. Sets that these links leave in different components
are then verified against each other, unless their distances to the pivot rule the link out,
as the Jaccard distance is a metric. So a large group of near copies costs a link for each, and
no link between different components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import checked_join
from ..session import cut_lineage, discard
from .components import components

#: Sets of a band that the cost model reckons with.
BAND_SETS = 100_000
#: A segment with fewer tokens counts as one that unrelated sets share.
FILLED = 2
#: Spare segments to choose from: numbers, and shares of the tokens that may differ.
SPARE, SPARE_SHARES = (*range(9), 12, 16, 24, 32), tuple(k / 20 for k in range(1, 31))
#: Bits of the parity sketch that a set carries, at least, and for each token.
SKETCH_BITS, BITS_PER_TOKEN = 2048, 4
#: 64-bit words of the short sketch that the rows of a signature carry.
SHORT_WORDS = 8
#: Pairs whose sketches are compared in one round, unless there would be more than SKETCH_ROUNDS.
ROUND_PAIRS, SKETCH_ROUNDS = 250_000, 16
#: Rounds that verify the best pair of any two components before all other pairs.
BEST_FIRST = 2
_DEALT_ROWS = 500
_MASK = (1 << 64) - 1


# -- token sets ----------------------------------------------------------------


class _Words(dict):
    """Hash of a word, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of the whole text if it is shorter.

    Words are parted by ASCII white space, A-Z are lower-cased. Without words the set is empty.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    table = _words
    h = np.fromiter([table[w] for w in found], np.uint64, len(found))
    width = min(size, len(found))
    total = h[: len(h) - width + 1].copy()
    for k in range(1, width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
    return np.unique(_mixed(total + np.uint64(width)))


# -- size bands and segments ---------------------------------------------------


@lru_cache(maxsize=64)
def band_starts(percent: int, largest: int = 1 << 40) -> tuple[int, ...]:
    """Least size of each band; a set meets sets of its own and of the next band only."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    return tuple(starts)


def _light_share(mean: float) -> float:
    """Share of segments with fewer than FILLED tokens, as tokens are dealt by hash."""
    return sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(FILLED))


def _beyond(count: int, share: float, spare: int) -> float:
    """Expected excess over `spare` of the segments, out of `count`, that a share makes light."""
    mean, spread = count * share, math.sqrt(count * share * (1 - share))
    if not spare or not spread:
        return max(0.0, mean - spare)
    z = (spare - mean) / spread
    tail = math.erfc(z / math.sqrt(2)) / 2
    return max(0.0, spread * math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - (spare - mean) * tail)


@lru_cache(maxsize=4096)
def allocate(size: int, differ: int) -> tuple[int, int, int]:
    """Segments that count once, segments that count double, and spare ones.

    The segments count `differ` + 1 + spare together. Least cost: signatures of a set of `size`
    tokens, and the sets that unrelated light segments would bring together.
    """
    best: tuple[float, tuple[int, int, int]] | None = None
    for double in range(0, min(differ + 1, 12) // 2 + 1):
        for spare in sorted({*SPARE, *(int(differ * share) for share in SPARE_SHARES)}):
            once = differ + 1 + spare - 2 * double
            if once < 0 or once + double == 0 or spare and not once:
                continue
            count = once + double
            light = _light_share(size / count)
            bad = BAND_SETS * (_beyond(once, light, spare) + 2 * double * light)
            cost = max(0, once - spare) + double * (1 + size / count) + bad
            if best is None or cost < best[0]:
                best = (cost, (once, double, spare))
    return best[1]


def _of_scheme(tokens: np.ndarray, scheme: int, percent: int) -> np.ndarray:
    """Signatures of a set under the scheme of a band.

    Of the segments that count once each set drops those that come first by their tokens' number
    and their hash, as many as are spare. Segments on which two sets agree are in the same order in
    both; where no segment that counts double brings the sets together, they agree on one more than
    either drops, so both keep the last of these. A set smaller than the largest of the band
    differs from its partners in fewer tokens and drops more.
    """
    largest = band_starts(percent)[scheme + 1] - 1
    differ = (100 - percent) * largest // percent
    if differ == 0:
        return np.empty(0, np.uint64)  # only equal sets link, and those are one already
    once, double, spare = allocate(largest, differ)
    count = once + double
    dealt = _mixed(tokens + np.uint64((scheme + 1) * 0x632BE59BD9B4E019 & _MASK))
    segment = (dealt % np.uint64(count)).astype(np.int64)
    sums = np.zeros(count, np.uint64)
    np.add.at(sums, segment, dealt)
    salt = _mixed((np.arange(count, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95) + np.uint64(scheme))
    codes = _mixed(sums + salt)
    filled = np.bincount(segment, minlength=count)
    dropped = spare + differ - (100 - percent) * min(largest, len(tokens)) // percent
    order = np.lexsort((codes[double:], filled[double:]))
    out = [codes[:double], codes[double:][order[dropped:]]]
    if double:
        ours = segment < double
        out.append(_mixed(sums[segment[ours]] - dealt[ours] + salt[segment[ours]]))
    return np.concatenate(out)


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set: any set that reaches the threshold with it shares one of them."""
    if not len(tokens):
        return tokens
    band = int(np.searchsorted(band_starts(percent), len(tokens), "right")) - 1
    schemes = [s for s in (band, band - 1) if s >= 0]
    return np.unique(np.concatenate([_of_scheme(tokens, s, percent) for s in schemes]))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """For each hash bucket the parity of the tokens in it, as 64-bit words.

    Every token that only one of two sets has turns one bit, so their sketches differ in no more
    bits than the sets in tokens. The length is a power of two that follows the size; a longer
    sketch is folded to a shorter one by joining its halves.
    """
    bits = max(SKETCH_BITS, 1 << (BITS_PER_TOKEN * len(tokens) - 1).bit_length() if len(tokens) else 0)
    counts = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _DEALT_ROWS):
            part = batch.slice(start, _DEALT_ROWS)
            yield part.column(0), part.column(1).to_pylist()


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _texts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("binary")), kind


def indexed(docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    """Per document the size of its set, two hashes of the whole set, its sketch and signatures."""
    source, kind = _texts(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _parts(batches):
            sets = [shingles(t, size) for t in texts]
            codes = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
            low = np.array([c & _MASK for c in codes], np.uint64).view(np.int64)
            high = np.array([c >> 64 for c in codes], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([len(s) for s in sets], pa.int64()), pa.array(low), pa.array(high),
                 _lists([sketch(s) for s in sets]), _lists([signatures(s, percent) for s in sets])],
                names=["doc", "n", "low", "high", "bits", "signatures"],
            )

    return source.mapInArrow(run, f"doc {kind}, n bigint, low bigint, high bigint, bits array<bigint>, signatures array<bigint>")


def token_sets(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """Per document its whole token set."""
    source, kind = _texts(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _parts(batches):
            yield pa.RecordBatch.from_arrays(
                [keys, _lists([shingles(t, size) for t in texts])], names=["doc", "tokens"]
            )

    return source.mapInArrow(run, f"doc {kind}, tokens array<bigint>")


# -- candidates and links ------------------------------------------------------


def _halved(x: Column) -> Column:
    """A sketch of half the length."""
    half = (F.size(x) / 2).cast("int")
    return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda a, b: a.bitwiseXOR(b))


def _turned(first: str, second: str) -> Column:
    """Bits in which two sketches differ: a lower bound of the tokens that do.

    Sizes that may link differ by less than a factor of two for thresholds from 50 %, and so do
    the sketches; nothing is told of others.
    """
    x, y = F.col(first), F.col(second)
    shorter = F.when(F.size(x) == F.size(y) * 2, _halved(x)).otherwise(x)
    other = F.when(F.size(y) == F.size(x) * 2, _halved(y)).otherwise(y)
    bits = F.zip_with(shorter, other, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    told = F.aggregate(bits, F.lit(0), lambda t, n: t + n)
    return F.when(F.size(shorter) == F.size(other), told).otherwise(0)


def _may_link(turned: Column, percent: int) -> Column:
    """Whether sizes and sketches of a pair allow a link; no link is ever ruled out."""
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    # common >= percent / (100 + percent) of both sizes, so at most the rest of them differs.
    return (small * 100 >= large * percent) & (turned * (100 + percent) <= (small + large) * (100 - percent))


def shared_signatures(sets: DataFrame) -> DataFrame:
    """Rows (signature, doc, pivot, rank) of signatures that several sets have.

    The pivot is the set that shares most with others, of equal ones the first; `rank` is how
    much that is. Among edited copies of a text that is the text itself, or the copy next to it.
    """
    rows = sets.select("doc", F.explode("signatures").alias("signature"))
    counted = rows.groupBy("signature").agg(F.count(F.lit(1)).alias("sets"))
    # Stored first: what the aggregate shuffled is then done with before the join shuffles.
    several = cut_lineage(counted.where("sets > 1"))
    members = cut_lineage(rows.join(several, "signature"))
    ranks = members.groupBy("doc").agg(F.sum("sets").alias("rank"))
    ranked = members.select("signature", "doc").join(ranks, "doc")
    best = ranked.groupBy("signature").agg(F.max("rank").alias("rank"))
    leaders = ranked.join(best, ["signature", "rank"]).groupBy("signature", "rank").agg(F.min("doc").alias("pivot"))
    shared = cut_lineage(members.select("signature", "doc").join(leaders, "signature"))
    discard(several, members)
    return shared


def _told(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) with their sizes, the bits in which they differ, and `may` link."""
    both = pairs.distinct()
    for side in ("a", "b"):
        named = [F.col("doc").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits")]
        both = both.join(sketches.select(*named), side)
    told = both.withColumn("turned", _turned("a_bits", "b_bits"))
    return told.select("a", "a_n", "b", "b_n", "turned", _may_link(F.col("turned"), percent).alias("may")).distinct()


def _sized(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    return cut_lineage(_told(pairs, sketches, percent))


def _sized_in_rounds(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The same for very many pairs.

    Sketches travel with the pairs, so each of several rounds frees what it shuffled before the next
    begins.
    """
    distinct = cut_lineage(pairs.distinct(), free=True)
    rounds = max(1, min(SKETCH_ROUNDS, -(-distinct.count() // ROUND_PAIRS)))
    told = None
    for turn in range(rounds):
        chosen = distinct.where(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == turn) if rounds > 1 else distinct
        part = cut_lineage(_told(chosen, sketches, percent), free=rounds > 1)
        told = part if told is None else told.unionByName(part)
    discard(distinct)
    return told


def verified(pairs: DataFrame, docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """`pairs` with `common`, the tokens that both sets have.

    The token sets are made anew, only for the documents in question.
    """

    def sets(ids: DataFrame, side: str) -> DataFrame:
        wanted = cut_lineage(ids.select(F.col(side).alias(key)).distinct())
        chosen = checked_join(docs.select(key, text), wanted, [key], [key], "left_semi")
        return token_sets(chosen, size, key, text).select(F.col("doc").alias(side), F.col("tokens").alias(f"{side}_s"))

    both = pairs.join(sets(pairs, "a"), "a").join(sets(pairs, "b"), "b")
    common = F.size(F.array_intersect("a_s", "b_s")).alias("common")
    return both.select("a", "a_n", "b", "b_n", "turned", common).distinct()


def _ruled_out(pairs: DataFrame) -> DataFrame:
    """The pairs that cannot link, in the form of `verified`, with a null for `common`."""
    return pairs.where("not may").select("a", "a_n", "b", "b_n", "turned", F.lit(None).cast("int").alias("common"))


def _linked(percent: int) -> Column:
    return F.col("common") * 100 >= (F.col("a_n") + F.col("b_n") - F.col("common")) * percent


def _labels(checked: DataFrame, percent: int) -> DataFrame:
    """(node, component) by the links among the verified pairs."""
    links = checked.where(_linked(percent)).select(F.col("a").alias("u"), F.col("b").alias("v"))
    return cut_lineage(components(links))


def _across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose documents lie in different components, with these as `_a` and `_b`."""
    for side in ("a", "b"):
        named = label.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
        pairs = checked_join(pairs, named, [side], ["a", "b"], "left").withColumn(f"_{side}", F.coalesce(f"_{side}", side))
    return pairs.where("_a <> _b")


def _joined_up(
    checked: DataFrame, label: DataFrame, pairs: DataFrame, percent: int, source: tuple
) -> tuple[DataFrame, DataFrame]:
    """`checked` and the components, after the pairs between components are verified.

    First the most similar pair, by the sketches, of any two components: most often it joins
    them, and their other pairs need no verification. What is left after BEST_FIRST such rounds
    is verified at once.
    """
    checked = checked.unionByName(_ruled_out(pairs))
    rest = pairs.where("may")
    for turn in range(BEST_FIRST + 1):
        rest = cut_lineage(_across(rest.select("a", "a_n", "b", "b_n", "turned", "may"), label))
        if rest.isEmpty():
            break
        chosen = rest
        if turn < BEST_FIRST:
            best = rest.groupBy(F.least("_a", "_b").alias("_x"), F.greatest("_a", "_b").alias("_y")).agg(
                F.min(F.struct("turned", "a", "b")).alias("m")
            )
            keys = best.select(F.col("m.a").alias("a"), F.col("m.b").alias("b"))
            chosen = cut_lineage(rest.join(keys, ["a", "b"]))
            rest = rest.join(keys, ["a", "b"], "left_anti")
        checked = cut_lineage(checked.unionByName(verified(chosen.drop("_a", "_b"), *source)))
        label = _labels(checked, percent)
    return checked, label


def _folded(bits: Column) -> Column:
    """A sketch of SHORT_WORDS words; it bounds the differing tokens as well."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(SHORT_WORDS - 1)),
        lambda k: F.aggregate(
            F.filter(bits, lambda _, i: i % SHORT_WORDS == k),
            F.lit(0).cast("bigint"),
            lambda a, x: a.bitwiseXOR(x),
        ),
    )


def _second_pairs(
    shared: DataFrame, checked: DataFrame, label: DataFrame, sketches: DataFrame, percent: int
) -> DataFrame:
    """Pairs that share a signature, lie in different components and may still link.

    Both distances to the pivot must allow it (each known exactly, or from below by the sketch),
    and so must the sizes and a short sketch of the pair.
    """
    union = F.col("a_n") + F.col("b_n") - F.col("common")
    least = 2 * F.col("turned") / (F.col("a_n") + F.col("b_n") + F.col("turned"))
    known = checked.select(
        F.col("a").alias("doc"), F.col("b").alias("pivot"),
        F.coalesce(1 - F.col("common") / union, least).alias("lo"),
        F.coalesce(1 - F.col("common") / union, F.lit(1.0)).alias("hi"),
    )
    placed = (
        shared.select("signature", "doc", "pivot")
        .join(label.select(F.col("node").alias("doc"), "component"), "doc", "left")
        .withColumn("component", F.coalesce("component", "doc"))
    )
    mixed = (
        placed.groupBy("signature")
        .agg(F.min("component").alias("one"), F.max("component").alias("other"))
        .where("one <> other")
        .select("signature")
    )
    short = sketches.select("doc", "n", _folded(F.col("bits")).alias("w"))
    others = placed.where("doc <> pivot").join(mixed, "signature").join(known, ["doc", "pivot"], "left")
    bounds = [F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(1.0)).alias("hi")]
    rest = cut_lineage(others.join(short, "doc").select("signature", "doc", "component", *bounds, "n", "w"))
    # signatures and sketches of all are not needed beside those that are compared
    discard(shared)

    def side(name: str) -> DataFrame:
        # The short sketch in columns of its own, which Spark compiles.
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("doc", "component", "lo", "hi", "n")]
        return rest.select("signature", *columns, *[F.col("w")[k].alias(f"{name}_w{k}") for k in range(SHORT_WORDS)])

    left, right = side("a"), side("b")
    turned = F.lit(0)
    for k in range(SHORT_WORDS):
        turned = turned + F.bit_count(F.col(f"a_w{k}").bitwiseXOR(F.col(f"b_w{k}")))
    reach = (100 - percent) / 100 + 1e-9
    joined = left.join(
        right,
        (left["signature"] == right["signature"])
        & (F.col("a_doc") < F.col("b_doc"))
        & (F.col("a_component") != F.col("b_component"))
        & (F.col("a_lo") - F.col("b_hi") <= reach)
        & (F.col("b_lo") - F.col("a_hi") <= reach)
        & _may_link(turned, percent),
    )
    return joined.select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"))


def ngram_jaccard(
    docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of `docs`: the key, `n_shingles`, and `component_id`, the least key of its component.

    Two documents link when 100 * common >= `percent` * united, over their sets of `size` words;
    `percent` is a whole number from 1 to 99. Documents without words (null, empty or white
    space) have an empty set, link with nothing and are their own component. A row with a null
    key has a null component. Rows repeated in full are one document.
    """
    sets = cut_lineage(indexed(docs, size, percent, key, text))
    full = sets.where("n > 0 and doc is not null")
    copies = full.groupBy("n", "low", "high").agg(F.min("doc").alias("rep"), F.max("doc").alias("last"))
    repeated = cut_lineage(copies.where("rep <> last").drop("last"))
    members = cut_lineage(
        checked_join(full.select("doc", "n", "low", "high"), repeated, ["n", "low", "high"], ["doc"]).select("doc", "rep")
    )
    others = members.where("doc <> rep").select("doc")
    firsts = checked_join(full.select("doc", "signatures"), others, ["doc"], ["doc"], "left_anti")
    shared = shared_signatures(firsts)
    sketches = full.select("doc", "n", "bits")
    star = shared.where("doc <> pivot").select(F.col("doc").alias("a"), F.col("pivot").alias("b"), "rank")
    star = cut_lineage(star.distinct())
    # First the pivot that shares most, then those pivots that are still in another component.
    top = star.groupBy("a").agg(F.max("rank").alias("rank"))
    first = star.join(top, ["a", "rank"]).groupBy("a").agg(F.min("b").alias("b"))
    sized = _sized(first, sketches, percent)
    found = verified(sized.where("may"), docs, size, key, text)
    checked = cut_lineage(found.unionByName(_ruled_out(sized)))
    label = _labels(checked, percent)
    apart = _across(star.select("a", "b").join(first, ["a", "b"], "left_anti"), label).select("a", "b")
    source = (docs, size, key, text)
    checked, label = _joined_up(checked, label, _sized(apart, sketches, percent), percent, source)
    second = _sized_in_rounds(_second_pairs(shared, checked, label, sketches, percent), sketches, percent)
    _, label = _joined_up(checked, label, second.where("may"), percent, source)
    placed = members.withColumnRenamed("doc", key).distinct()
    out = sets.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"))
    out = checked_join(out, placed, [key], [key], "left").withColumn("rep", F.coalesce("rep", key))
    named = label.select(F.col("node").alias("rep"), "component")
    return checked_join(out, named, ["rep"], [key], "left").select(
        key, "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
