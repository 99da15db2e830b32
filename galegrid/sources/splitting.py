"""Large feature collections in one JSON document, read by many tasks.

A document is read as pieces that end with a closing brace, so the text reader cuts it wherever its
splits fall. Whether a piece begins inside a string, and how deep, depends on all pieces before it:
every split adds up its quotes and brackets for both cases, a running sum over the splits, one row
for each, tells where each one begins, and a running sum inside the split does the rest. A feature
ends where a closing brace leads back to the array of features; the pieces up to it are its text,
whichever splits they came from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import checked_join
from ..schemas import feature_collection
from ..session import cut_lineage

#: What stands around the features of a document is kept together; more of it is an error.
MOST_AROUND = 64 * 1024 * 1024
_OPENS = r'"features"\s*:\s*\[\s*(?:\{|$)'
_OPENING = r'(?s)^(.*?"features"\s*:\s*\[)'


def _pieces(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Pieces with what they add to each state, stored: their text is read by the last pass only."""
    read = spark.read.text(path if isinstance(path, str) else list(path), lineSep="}")
    told = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        (F.octet_length("value") + 1).alias("bytes"),
        # without escapes, every quote left begins or ends a string
        F.regexp_replace("value", r"(?s)\\.", "").alias("plain"),
    )

    def net(text: Column, opening: str, closing: str) -> Column:
        return F.regexp_count(text, F.lit(opening)) - F.regexp_count(text, F.lit(closing))

    told = told.withColumn("quotes", F.regexp_count("plain", F.lit('"')))
    for inside in (0, 1):
        text = F.regexp_replace("plain", r'^[^"]*("|$)', "") if inside else F.col("plain")
        code = F.regexp_replace(text, r'"[^"]*("|$)', "")
        closes = F.when((F.col("quotes") + inside) % 2 == 0, 1).otherwise(0)
        if not inside:
            # behind a closed object: whether its array ends before anything opens
            told = told.withColumn("leaves", code.rlike(r"^[^\[\]{]*\]"))
        told = told.withColumns({f"brace{inside}": net(code, r"\{", r"\}") - closes, f"bracket{inside}": net(code, r"\[", r"\]")})
    return cut_lineage(told.drop("plain"))


def _running(column: str, last: int) -> Column:
    """The sum of a column over the pieces of a split: before a piece (-1), or up to it (0)."""
    order = Window.partitionBy("file", "split").orderBy("seq")
    return F.coalesce(F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, last)), F.lit(0))


def _begins(totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each split what the splits of its file before it add up to."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", "split", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_at") for c in columns])


def _changes(pieces: DataFrame, parity: Column) -> DataFrame:
    """The change of depth of each piece, `parity` being that of the quotes before its split."""
    inside = (parity + _running("quotes", -1)) % 2
    chosen = {c: F.when(F.col("inside") == 1, F.col(f"{c}1")).otherwise(F.col(f"{c}0")) for c in ("brace", "bracket")}
    closed = (F.col("inside") + F.col("quotes")) % 2 == 0
    return pieces.withColumn("inside", inside).withColumns({**chosen, "closed": closed})


def _numbered(pieces: DataFrame) -> DataFrame:
    """Pieces with the depth at their end and the number of the record that they belong to."""
    quotes = cut_lineage(_begins(pieces.groupBy("file", "split").agg(F.sum("quotes").alias("quotes")), ["quotes"]))
    changed = _changes(checked_join(pieces, quotes, ["file", "split"], ["seq"]), F.col("quotes_at"))
    sums = changed.groupBy("file", "split").agg(F.sum("brace").alias("brace"), F.sum("bracket").alias("bracket"))
    depths = cut_lineage(_begins(sums, ["brace", "bracket"]))

    def deep(df: DataFrame) -> DataFrame:
        joined = checked_join(df, depths.join(quotes, ["file", "split"]), ["file", "split"], ["seq"])
        found = _changes(joined, F.col("quotes_at"))
        ends = {f"{c}_end": F.col(f"{c}_at") + _running(c, 0) for c in ("brace", "bracket")}
        found = found.withColumns(ends)
        return found.withColumn("ends", (F.col("closed") & (F.col("brace_end") == 1) & (F.col("bracket_end") == 1)).cast("int"))

    counted = deep(pieces).groupBy("file", "split").agg(F.sum("ends").alias("ends"))
    before = cut_lineage(_begins(counted, ["ends"]))
    records = checked_join(deep(pieces), before, ["file", "split"], ["seq"])
    return records.withColumn("record", F.col("ends_at") + _running("ends", -1))


def read_split_collections(
    spark: SparkSession, path: str | Sequence[str], properties: T.StructType, page_pattern: str = r".*page[=_-]?(\d+)"
) -> tuple[DataFrame, DataFrame]:
    """The features of all documents below `path`, and one row (file, type, page) for each document.

    Features come as struct `f` with their `page`, as `flatten_features` wants them. Documents that are
    not JSON, in whatever place, have a null type and give no feature, as `files.read_pages` has it.
    Arrays of other names are no features. One feature must fit into a row, what stands around the
    features of a document into MOST_AROUND bytes.
    """
    records = _numbered(_pieces(spark, path))
    brace, bracket = F.col("brace_end") - F.col("brace"), F.col("bracket_end") - F.col("bracket")
    leaves = (F.col("inside") == 0) & (brace == 1) & (bracket == 1) & F.col("leaves")
    opens = (((brace <= 1) & (bracket == 0)) | leaves) & F.col("value").rlike(_OPENS)
    texts = cut_lineage(
        records.groupBy("file", "record").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "seq", "value"))), lambda p: p["value"]), "}").alias("text"),
            F.max("ends").alias("ends"),
            F.sum("bytes").alias("bytes"),
            F.max("size").alias("size"),
            F.max(opens.cast("int")).alias("opens"),
            F.max(leaves.cast("int")).alias("leaves"),
        )
    )
    first = texts.where("opens = 1").groupBy("file").agg(F.min("record").alias("first"))
    # with a brace behind every piece, the pieces of a file are as long as the file
    files = texts.groupBy("file").agg((F.sum("bytes") == F.max("size")).alias("braced"))
    bounds = cut_lineage(files.join(first, "file", "left"))
    placed = checked_join(texts, bounds, ["file"], ["record"])
    # the features end where their array does: the next record opens behind it
    last = placed.where("record > first AND leaves = 1").groupBy("file").agg(F.min("record").alias("last"))
    placed = checked_join(placed, cut_lineage(bounds.select("file").join(last, "file", "left")), ["file"], ["record"])
    whole = F.concat("text", F.when((F.col("ends") == 1) | F.col("braced"), "}").otherwise(""))
    placed = placed.withColumn("text", whole).withColumn(
        "is_feature", F.expr("first IS NOT NULL AND ends = 1 AND record >= first AND record < coalesce(last, record + 1)")
    )
    # the first record holds the opening of the array as well
    opened = F.when(F.col("record") == F.col("first"), F.regexp_extract("text", _OPENING, 1)).otherwise("")
    record = F.expr("substr(text, length(opened) + 1)")
    parts = placed.withColumn("opened", opened).withColumns(
        {
            "around": F.when(F.col("is_feature"), F.col("opened")).otherwise(F.col("text")),
            "feature": F.when(F.col("is_feature"), F.regexp_replace(record, r"^\s*,?\s*", "")),
        }
    )
    parts = parts.withColumn("good", F.col("feature").isNull() | F.try_parse_json("feature").isNotNull())
    sizes = parts.groupBy("file").agg(
        F.sum(F.octet_length("around")).alias("around_bytes"), F.bool_and("good").alias("all_good")
    )
    sized = checked_join(parts.where("around <> ''"), cut_lineage(sizes), ["file"], ["record"])
    kept = F.when(F.col("around_bytes") <= MOST_AROUND, F.col("around")).otherwise(
        F.raise_error(F.concat(F.lit("too much around the features of "), F.col("file"))).cast("string")
    )
    skeletons = sized.withColumn("around", kept).groupBy("file", "all_good").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record", "around"))), lambda p: p["around"]), "").alias("around")
    )
    told = F.when(F.col("all_good") & F.try_parse_json("around").isNotNull(), F.get_json_object("around", "$.type"))
    number = F.regexp_extract("file", page_pattern, 1)
    documents = cut_lineage(skeletons.select("file", told.alias("type"), F.when(number != "", number).cast("int").alias("page")))
    element = feature_collection(properties)["features"].dataType.elementType
    good = documents.where("type = 'FeatureCollection'").select("file", "page")
    found = checked_join(parts.where("is_feature").select("file", "feature"), good, ["file"], ["feature"])
    return found.select("page", F.from_json("feature", element).alias("f")), documents
