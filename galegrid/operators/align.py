"""Feature columns of single tables, and the hourly alignment of weather and incidents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import age_in_years, clashing, front_columns, quoted, require_columns
from .skew import BROADCAST_BYTES, checked_join, fits, salted_outer_join

CONDITIONS = ("DD", "FH", "FF", "FX")
NO_INCIDENT = "No-Incident"


def tree_features(
    trees: DataFrame,
    as_of_year: int | None = None,
    year_col: str = "jaarVanAanleg",
    out: str = "leeftijdBoom",
) -> DataFrame:
    """Add the age in years of every tree."""
    return trees.withColumn(out, age_in_years(quoted(year_col), as_of_year))


def incident_features(
    incidents: DataFrame,
    start_col: str = "Incident_Starttime",
    hour_col: str = "IncStrt_Hour",
    front: Sequence[str] = ("Incident_ID", "Incident_Date", "IncStrt_Hour"),
) -> DataFrame:
    """Add the start hour; id, date and hour come first, other columns sorted by name."""
    return front_columns(incidents.withColumn(hour_col, F.hour(quoted(start_col))), front)


def utc_slot(start: Column, zone: str) -> tuple[Column, Column]:
    """Date and hour slot 1..24 in UT that hold a local start time."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), start.cast("timestamp_ntz"))
    return F.to_date(utc), F.hour(utc) + 1


def _on_weather_keys(
    weather: DataFrame,
    incidents: DataFrame,
    weather_keys: Sequence[str],
    incident_keys: Sequence[str],
    zone: str | None,
    start_col: str,
) -> DataFrame:
    """Incidents keyed like the weather; other clashing columns get the suffix `_right`."""
    if zone is not None:
        day, slot = utc_slot(quoted(start_col), zone)
        incidents = incidents.withColumns({incident_keys[0]: day, incident_keys[1]: slot})
    require_columns(incidents, *incident_keys)
    others = [c for c in incidents.columns if c not in incident_keys]
    clash = clashing(others, weather.columns)
    renames = {c: f"{c}_right" for c in clash} | dict(zip(incident_keys, weather_keys))
    return incidents.withColumnsRenamed(renames)


def align_hourly(
    weather: DataFrame,
    incidents: DataFrame,
    weather_keys: Sequence[str] = ("YYYYMMDD", "HH"),
    incident_keys: Sequence[str] = ("Incident_Date", "IncStrt_Hour"),
    zone: str | None = None,
    start_col: str = "Incident_Starttime",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Weather left join incidents on date and hour; incident keys are not in the output.

    The plain form joins the hour number as it is. With `zone`, incident times are turned
    into UT and into the 1..24 slot numbering of the weather first.
    """
    right = _on_weather_keys(weather, incidents, weather_keys, incident_keys, zone, start_col)
    keys = list(weather_keys)
    if fits(right, max_bytes):
        joined = weather.join(F.broadcast(right), keys, "left")
    else:
        joined = salted_outer_join(weather, right, keys, spread=right.columns)
    rest = [c for c in right.columns if c not in keys]
    return joined.select(*[quoted(c) for c in [*weather.columns, *rest]])


def left_join_renamed(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join on differently named keys; the right key is not in the output."""
    clash = clashing([c for c in right.columns if c != right_on], left.columns)
    right = right.withColumnsRenamed({c: f"{c}_right" for c in clash} | {right_on: left_on})
    joined = checked_join(left, right, [left_on], left.columns, "left", max_bytes)
    rest = [c for c in right.columns if c != left_on]
    return joined.select(*[quoted(c) for c in [*left.columns, *rest]])


def count_incidents(
    df: DataFrame, by: Sequence[str], id_col: str = "Incident_ID", out: str = "Total_Incidents"
) -> DataFrame:
    """Number of non-null ids per group; null group keys form groups of their own."""
    return df.groupBy(*[quoted(c) for c in by]).agg(F.count(quoted(id_col)).alias(out))


def label_nulls(df: DataFrame, column: str, label: str = NO_INCIDENT) -> DataFrame:
    """Replace nulls of a text column by a label."""
    return df.withColumn(column, F.coalesce(quoted(column), F.lit(label)))


def label_counts(
    weather_incident: DataFrame,
    conditions: Sequence[str] = CONDITIONS,
    damage: str = "Damage_Type",
    id_col: str = "Incident_ID",
    out: str = "Total_Incidents",
) -> DataFrame:
    """Incidents per weather condition and damage type of an aligned table."""
    counts = count_incidents(weather_incident, [*conditions, damage], id_col, out)
    return label_nulls(counts, damage)


def label_counts_direct(
    weather: DataFrame,
    incidents: DataFrame,
    conditions: Sequence[str] = CONDITIONS,
    damage: str = "Damage_Type",
    id_col: str = "Incident_ID",
    out: str = "Total_Incidents",
    by: Sequence[str] = (),
    weather_keys: Sequence[str] = ("YYYYMMDD", "HH"),
    incident_keys: Sequence[str] = ("Incident_Date", "IncStrt_Hour"),
    zone: str | None = None,
    start_col: str = "Incident_Starttime",
) -> DataFrame:
    """`label_counts(align_hourly(...))` without the row-level join.

    Incidents are counted per hour and damage type first, so what is joined has at most one
    row per hour and type, however many incidents a stormy hour holds. `by` names further
    incident columns to keep the counts apart by (an area code, for located labels).
    """
    right = _on_weather_keys(weather, incidents, weather_keys, incident_keys, zone, start_col)
    keys = list(weather_keys)
    hourly = count_incidents(right, [*keys, *by, damage], id_col, "_n")
    hours = weather.select(*[quoted(c) for c in [*keys, *conditions]])
    joined = hours.join(hourly, keys, "left")
    counts = joined.groupBy(*[quoted(c) for c in [*conditions, *by, damage]]).agg(
        F.sum(F.coalesce("_n", F.lit(0))).cast("bigint").alias(out)
    )
    return label_nulls(counts, damage)


def hourly_counts(
    weather: DataFrame,
    incidents: DataFrame,
    measures: Sequence[str],
    by: Sequence[str] = ("Service_Area", "Damage_Type"),
    out: str = "Incident_Count",
) -> DataFrame:
    """Incidents per date, hour, `by` and the weather of that hour; hours without any count 0.

    The measures follow from the hour, so incidents are counted by their narrow keys before the
    wide weather is joined. Weather rows that occur several times count as often.
    """
    keys = {"Incident_Date": "YYYYMMDD", "IncStrt_Hour": "HH"}
    counted = incidents.groupBy(*keys, *[quoted(c) for c in by]).agg(F.count("Incident_ID").alias(out))
    hours = weather.groupBy("YYYYMMDD", "HH", *[quoted(c) for c in measures]).agg(F.count(F.lit(1)).alias("_times"))
    joined = hours.join(counted.withColumnsRenamed(keys), ["YYYYMMDD", "HH"], "left")
    total = (F.coalesce(quoted(out), F.lit(0)) * F.col("_times")).alias(out)
    return joined.select("YYYYMMDD", "HH", *[quoted(c) for c in [*by, *measures]], total)
