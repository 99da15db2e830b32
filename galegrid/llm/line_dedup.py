"""Deletes passages that repeat earlier text, found by winnowing over line hashes.

A text is folded into lines by what it says alone, not by its punctuation: a word opens a line if its
hash is small, or if none of the STEP words from it on has a small one. A line has OPENED_WORDS words
and may overlap with the next ones. Every 50 words thus hold a whole line, and the same 50 words hold
the same one wherever they stand, so that a repeated passage always shares a line with each of its
occurrences.

What is deleted is exact: all words of later occurrences of any MIN_WORDS words in a row; the
first occurrence, in the order of key and place, stays. Lines that come once rule out most of the
text. For the others, the words around a line are first matched as one, with up to STEP - 1 words on
the left and so many on the right that every passage through the line is among them: where these came
before, so did all passages through the line. Only where one line has different words around it, the
passages of MIN_WORDS words through it are matched one by one, each with its own first occurrence, at
one place for all with the same words around.

All of it is Spark's: no Python runs on the executors. `fingerprints` finds lines of another length by
numpy, batch by batch; the query does not use it.

Nothing is gathered for a line or a passage: first occurrences come from an aggregate that Spark
combines before shuffling, and the rows of a very common one are joined to one row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import checked_join, fits
from ..session import cut_lineage
from .common import SPACE, columns_of, fresh, with_arrow_columns

MIN_WORDS = 50
#: Words of which one opens a line, and words of a line; together one more than MIN_WORDS.
WINDOW = 25
LINE_WORDS = MIN_WORDS + 1 - WINDOW
#: Of STEP neighbouring words one opens a line for the query, and such a line has OPENED_WORDS words; they
#: too are one more than MIN_WORDS together. A word does so by itself if its hash is below OPENS_BELOW.
STEP = 36
OPENED_WORDS = MIN_WORDS + 1 - STEP
OPENS_BELOW = -(2**31) + 2**32 // 10
_TRIM = " \t\n\r\x0b\x0c"
#: Bits of a code that hold the place of a word.
_PLACE_BITS = 28
_PLACE = (1 << _PLACE_BITS) - 1


def _lines(text: Column) -> Column:
    """The words with the white space behind them, and that before the first: joined they give the text."""
    return F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+[{SPACE}]*|[{SPACE}]+"), F.lit(0))


def _words(text: Column) -> Column:
    return F.split(_trimmed(text), f"[{SPACE}]+")


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(_TRIM))


def _long_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents that are long enough for MIN_WORDS words."""
    return docs.where(F.col(f"`{key}`").isNotNull() & (F.octet_length(f"`{text}`") >= 2 * MIN_WORDS - 1))


def fold(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document (`doc`) the hashes `h` of its words; some with fewer than MIN_WORDS words go."""
    known = _long_texts(docs, key, text)
    parts = _words(F.col(f"`{text}`"))
    return known.select(F.col(f"`{key}`").alias("doc"), F.transform(parts, lambda w: F.xxhash64(w)).alias("h"))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers whose every bit depends on every bit of `x`."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Sums:
    """Hashes of runs of numbers as differences of running sums, modulo 2**64.

    A number weighs a power of an odd base by its place; the inverse power makes runs comparable.
    """

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def hashes(self, values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(values):
            size = 2 * len(values) + 1
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=sums[1:])
        return _mixed((sums[stops] - sums[starts]) * self.inverses[starts] + (stops - starts).astype(np.uint64))


_LINE = T.StructType([T.StructField(c, T.IntegerType()) for c in ("at", "start", "end")] + [T.StructField(c, T.LongType()) for c in "gc"])


def _find_lines() -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """The lines of the texts of a batch, whose bytes are worked on as one array."""
    of_bytes, of_words = _Sums(0x9E3779B97F4A7C15), _Sums(0xD1342543DE82EF95)
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    byte_codes = _mixed(np.arange(1, 257, dtype=np.uint64))

    def lines(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(0).cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        # A word begins behind white space or where its text does, and ends likewise.
        blank = space[data]
        begins, ends = ~blank, ~blank
        begins[1:] &= blank[:-1]
        ends[:-1] &= blank[1:]
        firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
        begins[firsts] = ~blank[firsts]
        lasts = bounds[1:][bounds[:-1] < bounds[1:]] - 1
        ends[lasts] = ~blank[lasts]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        words = of_bytes.hashes(byte_codes[data], starts, stops)
        edges = np.searchsorted(starts, bounds)  # the words of text k: from edges[k] to edges[k + 1]
        counts = np.diff(edges)
        base, size = np.repeat(edges[:-1], counts), np.repeat(counts, counts)
        place = np.arange(len(words)) - base
        # Low codes win, so that of equal hashes the last does.
        codes = (words << np.uint64(_PLACE_BITS)).view(np.int64) | (_PLACE - place)
        least = codes
        for step in (1, 2, 4, 8, WINDOW - 16):  # the least of 2, 4, 8, 16, WINDOW neighbours
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        window = np.flatnonzero(place[: len(least)] <= size[: len(least)] - MIN_WORDS)
        least = least[window]
        new = np.ones(len(window), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (base[window[1:]] != base[window[:-1]])
        window, at = window[new], _PLACE - (least[new] & _PLACE)
        first, size = base[window], size[window]
        start = np.maximum(at - (WINDOW - 1), 0)
        end = np.minimum(at + MIN_WORDS, size)
        g = of_words.hashes(words, first + at, first + at + LINE_WORDS)
        c = of_words.hashes(words, first + start, first + end)
        columns = [*[(x).astype(np.int32) for x in (at + 1, start + 1, end)], g.view(np.int64), c.view(np.int64)]
        of = np.searchsorted(first, edges).astype(np.int32)
        found = pa.StructArray.from_arrays([pa.array(x) for x in columns], names=_LINE.names)
        return [pa.ListArray.from_arrays(pa.array(of), found)]

    return lines


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines of each document: doc, place `at`, hash `g`, and the words around.

    These stand from `start` to `end`, with the hash `c`.
    """
    texts = _long_texts(docs, key, text).select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    found = with_arrow_columns(texts, [T.StructField("lines", T.ArrayType(_LINE))], _find_lines, ["text"], ["doc"], rows=64)
    return found.select("doc", F.inline("lines"))


def openers(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines of each document by SQL: doc, place `at`, hash `g`."""
    w, p, n = F.col("w"), F.col("p"), F.size("w")
    known = _long_texts(docs, key, text).select(F.col(f"`{key}`").alias("doc"), _words(F.col(f"`{text}`")).alias("w"))

    def opens(word: Column, i: Column) -> Column:
        return F.when((F.hash(word) < F.lit(OPENS_BELOW)) & (i <= n - F.lit(OPENED_WORDS)), i + 1)

    marked = known.select("doc", "w", F.when(n >= MIN_WORDS, F.array_compact(F.transform(w, opens))).alias("p"))
    # Between two of them, words with none among themselves and the next ones open lines as well.
    before, behind = F.concat(F.array(F.lit(0)), p), F.concat(p, F.array(n - F.lit(OPENED_WORDS - 2)))
    gaps = F.filter(F.arrays_zip(before.alias("a"), behind.alias("b")), lambda x: x["b"] - x["a"] > STEP)
    dense = F.flatten(F.transform(gaps, lambda x: F.sequence(x["a"] + 1, x["b"] - STEP)))
    # A generator over a plain column, so that a line does not copy all words; an outer one, as for others the
    # planner would ask for the size of `places` before the texts are split, and split them once more.
    places = marked.select("doc", "w", F.concat(p, dense).alias("places"))
    placed = places.select("doc", "w", F.explode_outer("places").alias("at")).where("at IS NOT NULL")
    return placed.select("doc", "at", F.xxhash64(F.slice("w", F.col("at"), F.lit(OPENED_WORDS))).alias("g"))


def _of(rows: DataFrame, few: DataFrame, by: str) -> DataFrame:
    """`rows` whose `by` is in `few`, a column of distinct values."""
    return rows.join(F.broadcast(few) if fits(few) else few.hint("shuffle_hash"), by)


def _with_first(rows: DataFrame, by: str, place: str) -> DataFrame:
    """Those of `rows` whose `by` comes at several places, with its first place (doc, place) as `first`.

    They come dealt by `by` and document, so that the join of a very common one can be split.
    """
    where = F.struct("doc", F.col(place).alias("place"))
    ends = rows.groupBy(by).agg(F.min(where).alias("first"), F.max(where).alias("last"))
    first = cut_lineage(ends.where("first <> last").drop("last"))
    return rows.join(first.hint("shuffle_hash"), by).repartition(by, "doc")


def _later(place: str) -> Column:
    return F.col("first") != F.struct("doc", F.col(place).alias("place"))


def _with_words(docs: DataFrame, places: DataFrame, key: str, text: str) -> DataFrame:
    """`places`, one row for each document, with the words `w` of its text."""
    texts = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    held = checked_join(texts, places.select("doc"), ["doc"], ["doc"], "left_semi")
    return held.join(places, "doc").withColumn("w", _words(F.col("text"))).drop("text")


def _around(docs: DataFrame, common: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, at, g, start, end, c): the lines of `common`, and the hash of the words around each."""
    places = cut_lineage(common.groupBy("doc").agg(F.collect_set(F.struct("at", "g")).alias("places")))

    start = F.greatest(F.col("at") - F.lit(STEP - 1), F.lit(1)).alias("start")
    end = F.least(F.col("at") + F.lit(MIN_WORDS - 1), F.size("w")).alias("end")
    ends = _with_words(docs, places, key, text).select("doc", "w", F.inline("places")).select("*", start, end)
    around = F.xxhash64(F.slice("w", F.col("start"), F.col("end") - F.col("start") + F.lit(1))).alias("c")
    return ends.select("doc", "at", "g", "start", "end", around)


def _passages(docs: DataFrame, open_: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, start, g): the passages of MIN_WORDS words through the lines of `open_`."""
    places = cut_lineage(open_.groupBy("doc").agg(F.collect_set("at").alias("places")))
    starts = F.flatten(F.transform("places", lambda at: F.sequence(F.greatest(at - F.lit(STEP - 1), F.lit(1)), at)))
    hashes = F.transform("w", lambda w: F.xxhash64(w)).alias("h")
    chosen = _with_words(docs, places, key, text).select("doc", F.array_distinct(starts).alias("starts"), hashes)
    each = chosen.select("doc", "h", F.explode("starts").alias("start")).where(F.col("start") <= F.size("h") - F.lit(MIN_WORDS - 1))
    return each.select("doc", "start", F.xxhash64(F.slice("h", F.col("start"), F.lit(MIN_WORDS))).alias("g"))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Later occurrences of passages of MIN_WORDS words and more: doc, start, end; they may overlap."""
    lines = cut_lineage(openers(docs, key, text))
    often = cut_lineage(lines.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g"))
    common = cut_lineage(_around(docs, _of(lines, often, "g"), key, text))
    around = _with_first(common.select("doc", "start", "end", "c"), "c", "start").where(_later("start"))
    # Where a line has the same words around it wherever it stands, this found all. Else one place stands for all
    # with the same words around.
    kinds = cut_lineage(common.groupBy("g", "c").agg(F.min(F.struct("doc", "at")).alias("at")))
    several = cut_lineage(kinds.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g"))
    single = cut_lineage(_passages(docs, _of(kinds, several, "g").select("at.doc", "at.at"), key, text))
    later = _with_first(single, "g", "start").where(_later("start"))
    return around.select("doc", "start", "end").unionByName(
        later.select("doc", "start", (F.col("start") + F.lit(MIN_WORDS - 1)).alias("end"))
    )


def cuts_by_doc(found: DataFrame, key: str, out: str) -> DataFrame:
    """Per document its runs in order, those that touch or overlap as one, as `out`."""
    ordered = Window.partitionBy("doc").orderBy("start", "end")
    earlier = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(earlier.isNull() | (F.col("start") > earlier + 1), 1).otherwise(0)
    marked = found.distinct().withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(ordered))
    one = marked.groupBy("doc", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return one.groupBy(F.col("doc").alias(key)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(out))


def _cleaned(text: Column, lines: Column, cuts: Column) -> Column:
    """What stands between the runs, with its white space."""
    # White space before the first word is a piece without a word.
    lead = F.when(F.length(F.ltrim(text, F.lit(_TRIM))) < F.length(text), 1).otherwise(0)
    starts = F.concat(F.array(F.lit(1)), F.transform(cuts, lambda c: c["end"] + lead + 1))
    stops = F.concat(F.transform(cuts, lambda c: c["start"] + lead - 1), F.array(F.size(lines)))
    gaps = F.arrays_zip(starts.alias("start"), stops.alias("stop"))

    def kept(gap: Column) -> Column:
        return F.array_join(F.slice(lines, gap["start"], F.greatest(gap["stop"] - gap["start"] + 1, F.lit(0))), "")

    run = cuts[0]
    whole = (F.size(cuts) == 1) & (run["start"] == 1) & (run["end"] + lead == F.size(lines))
    return F.when(whole, "").otherwise(F.array_join(F.transform(gaps, kept), ""))


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated passages deleted from `text`, and `n_runs`, the runs deleted.

    The first occurrence in the order of key and place stays, but for what an earlier text holds.
    Rows with a null key or a null or empty text stay as they are. Rows with one key and different
    texts are documents of their own, in the order of a hash of the text; rows with equal key and
    text are one, so each of them is left with the same text. A document of nothing but repeats keeps
    its row with an empty text. A column `n_runs` of `docs` is replaced.
    """
    row, cut, line = fresh(docs, "_row", "_cuts", "_l")
    alone = docs.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias(row)).where(F.col(row) > 1).isEmpty()
    code = F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("text"))
    # the key alone is shorter, where it tells all rows apart
    rows = docs.withColumn(row, F.col(f"`{key}`") if alone else F.when(F.col(f"`{key}`").isNotNull(), code))
    cuts = cut_lineage(cuts_by_doc(repeats(rows, row, text), row, cut))
    marked = checked_join(rows, cuts, [row], [row], "left")
    # A column of its own, as it is used many times.
    cuts_of = F.col(cut)
    near = marked.select("*", F.when(cuts_of.isNotNull(), _lines(F.col(f"`{text}`"))).alias(line))
    whole = F.col(f"`{text}`")
    near = near.withColumn(line, F.when(cuts_of.isNotNull(), _cleaned(whole, F.col(line), cuts_of)))
    left = F.when(_trimmed(F.col(line)) == "", "").otherwise(F.col(line))
    cleaned = F.when(cuts_of.isNull(), whole).otherwise(left)
    count = F.when(cuts_of.isNull(), 0).otherwise(F.size(cuts_of)).cast("int")
    out = near.withColumns({text: cleaned, "n_runs": count})
    return columns_of(out, docs if "n_runs" in docs.columns else docs.withColumn("n_runs", F.lit(0)))
