"""Fetch plans as DataFrames: time windows, page chunks, and what has not landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import format_hour_stamp

PAGES_PER_TASK = 100_000


def fetch_windows(
    spans: DataFrame, start: str = "start", end: str = "end", days: int = 180
) -> DataFrame:
    """Cut each [start, end) into consecutive windows of `days`; the last one ends at `end`.

    Adds the request texts `YYYYMMDDHH`. Consecutive windows share their border hour.
    """
    step = F.make_dt_interval(F.lit(days))
    return (
        spans.withColumn("window_start", F.explode(F.sequence(F.col(start), F.col(end), step)))
        .where(F.col("window_start") < F.col(end))
        .withColumn("window_end", F.least(F.col("window_start") + step, F.col(end)))
        .withColumn("start_text", format_hour_stamp(F.col("window_start")))
        .withColumn("end_text", format_hour_stamp(F.col("window_end")))
    )


def page_plan(totals: DataFrame, pages: Column, chunk: int = 20) -> DataFrame:
    """Pages 2..N of each row, numbered by chunks of `chunk` pages; none when N < 2.

    A row first becomes one row per PAGES_PER_TASK pages; those are dealt out before they make
    their pages, so no task holds the list of a long collection.
    """
    partitions = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = totals.withColumn("_pages", pages.cast("bigint")).where("_pages >= 2")
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_pages") - 2) / PAGES_PER_TASK))
    dealt = known.withColumn("_part", F.explode(parts)).repartition(partitions, "_part", "_pages")
    first = F.col("_part") * PAGES_PER_TASK + 2
    last = F.least(F.col("_pages"), first + (PAGES_PER_TASK - 1))
    return (
        dealt.withColumn("page", F.explode(F.sequence(first, last)))
        .withColumn("chunk", F.floor((F.col("page") - 2) / chunk).cast("bigint"))
        .drop("_pages", "_part")
    )


def missing_pages(planned: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned pages that did not land as a feature collection."""
    good = landed.where("type = 'FeatureCollection'").select("page").distinct()
    return planned.join(good, "page", "left_anti")
