from __future__ import annotations

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from galegrid.functions import columns as col


def test_clean_header(spark):
    df = spark.createDataFrame([(1, 2)], ["  YYYY MMDD\t", "HH "])
    assert col.clean_header(df).columns == ["YYYYMMDD", "HH"]


def test_front_columns_sorts_the_rest_by_code_point(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["b", "id", "a", "C"])
    assert col.front_columns(df, ["id"]).columns == ["id", "C", "a", "b"]


def test_expand_variables():
    have = ["DD", "FH", "FF", "FX", "T", "T10N", "TD"]
    assert col.expand_variables("WIND:T", have) == ["DD", "FH", "FF", "FX", "T"]
    assert col.expand_variables("ALL", have) == have
    assert col.expand_variables("TEMP:T", have) == ["T", "T10N", "TD"]
    with pytest.raises(ValueError):
        col.expand_variables("NOPE", have)


def test_feature_names_collide():
    assert col.feature_name("Trees", "c", "a b c") == "Trees_c_a-b-c"
    with pytest.raises(ValueError):
        col.unique_names([col.feature_name("T", "c", v) for v in ("a b", "a-b")])


def test_dates(spark):
    df = spark.createDataFrame([(20200131,), (20201399,)], ["d"])
    lenient = df.select(col.parse_yyyymmdd(F.col("d"), lenient=True).alias("d"))
    assert rows(lenient) == [(None,), (datetime.date(2020, 1, 31),)]
    with pytest.raises(Exception):
        df.select(col.parse_yyyymmdd(F.col("d"))).collect()
    stamp = spark.range(1).select(col.parse_hour_stamp(F.lit(2020013117)).alias("t"))
    assert stamp.select(col.format_hour_stamp(F.col("t"))).first()[0] == "2020013117"


def test_one_hot_keeps_other_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], ["id", "c"])
    wide = col.one_hot(df, {"c": ["a", "b", None]})
    assert wide.columns == ["id", "c_a", "c_b", "c_null"]
    assert rows(wide) == [(1, 1, 0, 0), (2, 0, 0, 1), (3, 0, 0, 0)]


def test_one_hot_looks_values_up(spark, monkeypatch):
    df = spark.createDataFrame([(1, "b", "z"), (2, None, "z"), (3, "a", "z")], ["id", "c", "d"])
    wide = col.one_hot(df, ["c", "d"])
    assert wide.columns == ["id", "c_a", "c_b", "c_null", "d_z"]
    assert rows(wide) == [(1, 0, 1, 0, 1), (2, 0, 0, 1, 1), (3, 1, 0, 0, 1)]
    with pytest.raises(ValueError, match="c \\(3\\)"):
        col.distinct_values(df, ["c", "d"], nulls=True, most=2)
    with pytest.raises(ValueError, match="same column name"):
        col.unique_names(["T_Iep", "T_iep"])


def test_age_defaults_to_the_current_year(spark):
    row = spark.range(1).select(col.age_in_years(F.year(F.current_date()) - 3).alias("a")).first()
    assert row["a"] == 3
