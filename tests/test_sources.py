"""Readers and loaders on files written by the tests."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galegrid import schemas
from galegrid.plans import staged
from galegrid.sources import catalog, fetch, files, loaders, splitting

SCHEMA = T.StructType([T.StructField(c, T.IntegerType()) for c in ("STN", "YYYYMMDD", "HH", "DD", "FX")])


@pytest.fixture
def weather_files(tmp_path):
    (tmp_path / "one.txt").write_text(
        "# station 240\n# STN = station\nSTN,YYYYMMDD, \tHH,   DD,   FX\n"
        "  240,20240101,    1,   10,    5\n  240,20240101,    2,   20,     \n"
    )
    (tmp_path / "two.txt").write_text(
        "# more\nSTN,YYYYMMDD, \tHH,   DD,   FX\n  240,20240102,    1,   30,    7\n"
        "  240,20240101,    2,   20,     \n"
    )
    return [str(tmp_path / "one.txt"), str(tmp_path / "two.txt")]


def test_load_weather(spark, weather_files):
    df = loaders.load_weather(spark, weather_files, SCHEMA)
    assert dict(df.dtypes)["HH"] == "tinyint" and dict(df.dtypes)["YYYYMMDD"] == "date"
    got = [(r.YYYYMMDD.day, r.HH, r.DD, r.FX) for r in df.collect()]
    assert got == [(2, 1, 30, 7), (1, 2, 20, None), (1, 2, 20, None), (1, 1, 10, 5)]
    assert loaders.load_weather(spark, weather_files, SCHEMA, deduplicate=True).count() == 3


def test_missing_weather_column_raises(spark, weather_files):
    with pytest.raises(ValueError):
        files.read_commented(spark, weather_files, schemas.WEATHER)


def test_load_weather_json(spark, tmp_path):
    for k in (1, 2):
        records = [
            {"STN": 240, "YYYYMMDD": 20240100 + k, "HH": h, "DD": 1, "FX": None} for h in (1, 24)
        ]
        records.append({"STN": 240, "YYYYMMDD": 20240101, "HH": 24, "DD": 1, "FX": None})
        (tmp_path / f"w{k}.json").write_text(json.dumps(records))
    df = loaders.load_weather_json(spark, str(tmp_path), SCHEMA)
    assert [(r.YYYYMMDD.day, r.HH) for r in df.collect()] == [(2, 24), (2, 1), (1, 24), (1, 1)]


def test_load_incidents(spark, tmp_path):
    (tmp_path / "i.csv").write_text(
        "Incident_ID,Date,LON,LAT,Damage_Type\n1,2024-01-01 05:06:07,4.5,52.25,Tree\n2,2024-01-02,4,52,NULL\n"
    )
    schema = T.StructType(
        [f for f in schemas.INCIDENTS if f.name in ("Incident_ID", "Date", "LON", "LAT", "Damage_Type")]
    )
    df = loaders.load_incidents(spark, str(tmp_path / "i.csv"), schema)
    assert df.columns == ["Incident_ID", "Damage_Type", "geometry", "Incident_Date"]
    assert rows(df, "Incident_ID", "Damage_Type", "Incident_Date") == [
        (1, "Tree", dt.date(2024, 1, 1)),
        (2, None, dt.date(2024, 1, 2)),
    ]
    assert df.first().geometry == "POINT (4.5000000000000000 52.2500000000000000)"
    decoded = loaders.load_incidents(spark, str(tmp_path / "i.csv"), schema, decoded=True)
    assert rows(decoded, "x", "y") == [(4.0, 52.0), (4.5, 52.25)]
    inferred = loaders.load_incidents(spark, str(tmp_path / "i.csv"), None)
    assert rows(inferred, "Damage_Type") == [(None,), ("Tree",)]


def test_load_service_areas(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        'area,geomtext,geom\nX,"POLYGON ((155000 463000, 155100 463000, 155000 463100, 155000 463000))",0\n'
    )
    df = loaders.load_service_areas(spark, str(tmp_path / "s.csv"), infer=True)
    assert df.columns == ["area", "geometry"]
    assert df.first().geometry.startswith("POLYGON ((5.3872062100000004 52.1551743999999999, ")


def collection(*features, kind="FeatureCollection"):
    return json.dumps({"type": kind, "features": list(features)})


def feature(shape, coordinates, **properties):
    return {"type": "Feature", "geometry": {"type": shape, "coordinates": coordinates}, "properties": properties}


@pytest.fixture
def tree_pages(tmp_path):
    tree = lambda k: feature("Point", [4.0 + k, 52], id=str(k), jaarVanAanleg=1990 + k, extra="x")
    (tmp_path / "page_1.json").write_text(collection(tree(1), tree(2)))
    (tmp_path / "page_2.json").write_text(collection(kind="Error"))
    (tmp_path / "page_4.json").write_text(collection(tree(4)))
    (tmp_path / "page_5.json").write_text("<html>busy</html>")
    return str(tmp_path)


def test_load_features_skips_bad_pages(spark, tree_pages):
    df = loaders.load_features(spark, tree_pages, schemas.TREE_PROPERTIES)
    assert df.columns == [*schemas.TREE_PROPERTIES.names, "geometry"]
    assert rows(df, "id", "jaarVanAanleg") == [("1", 1991), ("2", 1992), ("4", 1994)]
    assert df.where("id = '4'").first().geometry == "POINT (8.0000000000000000 52.0000000000000000)"


def test_decoded_geometry(spark, tree_pages, tmp_path_factory):
    trees = loaders.load_features(spark, tree_pages, schemas.TREE_PROPERTIES, decoded="point")
    assert rows(trees, "x", "y") == [(5.0, 52.0), (6.0, 52.0), (8.0, 52.0)]
    ring = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    path = tmp_path_factory.mktemp("areas") / "areas.json"
    made = [("Polygon", ring), ("MultiPolygon", [ring, ring])]
    path.write_text(
        collection(*[feature(t, c, code=t, name="n", gemeentenaam="Diemen") for t, c in made])
    )
    areas = loaders.load_areas(spark, str(path), "code", "name", decoded="polygon")
    from galegrid.functions.geometry import wkt_edges

    for row in areas.withColumn("again", wkt_edges(F.col("geometry"))).collect():
        assert row.edges == row.again and len(row.edges) in (3, 6)
    with pytest.raises(ValueError):
        loaders.load_areas(spark, str(path), "code", "name", decoded="line")


def test_missing_pages_are_reported(spark, tree_pages):
    pages = files.read_pages(spark, tree_pages, schemas.TREE_PROPERTIES)
    planned = fetch.page_plan(spark.range(1), F.lit(5)).select("page", "chunk")
    assert rows(fetch.missing_pages(planned, pages), "page") == [(2,), (3,), (5,)]


def test_first_page_must_be_a_collection(spark, tmp_path):
    (tmp_path / "page_1.json").write_text(collection(kind="Error"))
    with pytest.raises(ValueError):
        loaders.load_features(spark, str(tmp_path), schemas.TREE_PROPERTIES)


def test_load_areas(spark, tmp_path):
    ring = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    made = [("W1", "Oost", "Amsterdam"), ("W2", " ", "Amsterdam"), ("W3", "Zuid", "Elsewhere"), ("W4", None, "Diemen")]
    (tmp_path / "wijken.json").write_text(
        collection(
            *[feature("Polygon", ring, wijkcode=a, wijknaam=b, gemeentenaam=c) for a, b, c in made],
        )
    )
    df = loaders.load_areas(spark, str(tmp_path / "wijken.json"), "wijkcode", "wijknaam")
    assert rows(df, "wijkcode") == [("W1",)]


def test_area_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("W1", "Oost", "Amsterdam")], "wijkcode string, wijknaam string, gemeentenaam string")
    df.write.parquet(str(tmp_path / "areas"))
    kept = loaders.keep_named_areas(
        spark.read.parquet(str(tmp_path / "areas")), "wijknaam", loaders.MUNICIPALITIES
    )
    text = plan(kept.select("wijkcode"))
    assert "In(gemeentenaam" in text and "PushedFilters" in text


def test_fetch_windows(spark):
    spans = spark.createDataFrame(
        [
            (1, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 21)),
            (2, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 15, 6)),
            (3, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)),
        ],
        "k int, start timestamp, end timestamp",
    )
    df = fetch.fetch_windows(spans, days=10)
    assert rows(df, "k", "start_text", "end_text") == [
        (1, "2020010100", "2020011100"),
        (1, "2020011100", "2020012100"),
        (2, "2020010100", "2020011100"),
        (2, "2020011100", "2020011506"),
    ]


def test_page_plan_chunks(spark):
    pages = rows(fetch.page_plan(spark.range(1), F.lit(43)), "page", "chunk")
    assert sorted(pages) == [(p, (p - 2) // 20) for p in range(2, 44)]
    assert fetch.page_plan(spark.range(1), F.lit(1)).count() == 0


def test_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    catalog.save_table(df, "joined_t", "one", str(tmp_path / "wh"))
    catalog.save_table(df.union(df), "joined_t", "one")
    catalog.save_table(df, "joined_t", "two")
    assert catalog.read_table(spark, "joined_t", "one").count() == 2
    listed = catalog.list_tables(spark).where("schema = 'joined_t'")
    assert rows(listed, "name") == [("one",), ("two",)]
    assert listed.first().column_types == ["int", "string"]
    catalog.drop_table(spark, "joined_t", "two")
    catalog.drop_table(spark, "joined_t", "two")
    with pytest.raises(Exception):
        catalog.read_table(spark, "joined_t", "two").count()
    with pytest.raises(Exception):
        catalog.read_table(spark, "joined_t", "one; DROP TABLE x").count()


def test_other_header_orders(spark, tmp_path):
    """Every file is read by its own header, also within a path; other columns are an error."""
    one, two = tmp_path / "one", tmp_path / "two"
    for folder, header, values in ((one, "STN,YYYYMMDD,HH,DD,FX", "240,20240101,1,10,20"), (two, "STN,YYYYMMDD,HH,FX,DD", "240,20240101,2,20,10")):
        folder.mkdir()
        (folder / "w.txt").write_text(f"# note\n{header}\n{values}\n")
    df = loaders.load_weather(spark, [str(one), str(two)], SCHEMA)
    assert [(r.HH, r.DD, r.FX) for r in df.collect()] == [(2, 10, 20), (1, 10, 20)]
    (one / "x.txt").write_text((two / "w.txt").read_text())
    both = loaders.load_weather(spark, str(one), SCHEMA)
    assert [(r.HH, r.DD, r.FX) for r in both.collect()] == [(2, 10, 20), (1, 10, 20)]
    (one / "y.txt").write_text("STN,YYYYMMDD,HH,FX,OTHER\n240,20240101,2,20,10\n")
    with pytest.raises(Exception):
        loaders.load_weather(spark, str(one), SCHEMA).collect()


def test_unreadable_values_raise(spark, tmp_path):
    (tmp_path / "w.json").write_text("<html>error 500</html>")
    with pytest.raises(Exception):
        loaders.load_weather_json(spark, str(tmp_path / "w.json"), SCHEMA).collect()
    (tmp_path / "w.txt").write_text("STN,YYYYMMDD,HH,DD,FX\n240,20240101,1,ten,2\n")
    with pytest.raises(Exception):
        loaders.load_weather(spark, str(tmp_path / "w.txt"), SCHEMA).collect()
    (tmp_path / "i.csv").write_text("Incident_ID,Date,LON,LAT\n1,2024-01-01 05:06:07,4;9,52.25\n2,2024-01-02 00:00:00,4,52\n")
    schema = T.StructType([f for f in schemas.INCIDENTS if f.name in ("Incident_ID", "Date", "LON", "LAT")])
    with pytest.raises(Exception):
        loaders.load_incidents(spark, str(tmp_path / "i.csv"), schema).collect()
    kept = loaders.load_incidents(spark, str(tmp_path / "i.csv"), schema, bad_rows="bad")
    told = [(r.Incident_ID, r.bad) for r in kept.orderBy("Incident_ID").collect()]
    assert told == [(1, "1,2024-01-01 05:06:07,4;9,52.25"), (2, None)]
    with pytest.raises(ValueError):
        loaders.load_plain(spark, str(tmp_path / "i.csv"))


def test_page_plan_of_a_long_collection(spark):
    plan = fetch.page_plan(spark.range(1), F.lit(1_000_001))
    assert plan.count() == 1_000_000 and plan.agg(F.max("page"), F.min("page")).first() == (1_000_001, 2)
    assert plan.select("page").distinct().count() == 1_000_000


def _failing(spark, n=50):
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken row")).cast("bigint")).otherwise(F.col("id"))
    return spark.range(n).select(bad.alias("id"))


def test_a_failing_save_leaves_the_old_table(spark, tmp_path):
    catalog.save_table(spark.range(7), "swap_t", "kept", str(tmp_path / "wh"))
    with pytest.raises(Exception, match="broken row"):
        catalog.save_table(_failing(spark), "swap_t", "kept")
    assert catalog.read_table(spark, "swap_t", "kept").count() == 7
    with pytest.raises(Exception, match="broken row"):
        catalog.save_table(_failing(spark), "swap_t", "never")
    assert not spark.catalog.tableExists("swap_t.never")
    assert len(list((tmp_path / "wh" / "kept.versions").iterdir())) == 1


def test_a_table_replaces_itself_and_changes_its_columns(spark, tmp_path):
    def read():
        return catalog.read_table(spark, "swap_s", "own")

    catalog.save_table(spark.range(10), "swap_s", "own", str(tmp_path / "it's here"))
    for n in (8, 6, 4):
        catalog.save_table(read().where(F.col("id") < n), "swap_s", "own")
        assert read().count() == n
    before = read()
    catalog.save_table(read().select(F.col("id").cast("string").alias("Odd name"), F.lit(1).alias("n")), "swap_s", "own")
    assert read().columns == ["Odd name", "n"] and read().count() == 4
    assert before.count() == 4  # the version before is still there
    assert len(list((tmp_path / "it's here" / "own.versions").iterdir())) == 2
    catalog.drop_table(spark, "swap_s", "own")
    assert not (tmp_path / "it's here" / "own.versions").exists()
    catalog.save_table(spark.range(3), "swap_s", "own")
    assert read().count() == 3


def test_a_plain_table_of_that_name_is_replaced(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA swap_p LOCATION '{tmp_path}/wh'")
    spark.range(5).write.saveAsTable("swap_p.plain")
    catalog.save_table(catalog.read_table(spark, "swap_p", "plain").where("id > 1"), "swap_p", "plain")
    assert rows(catalog.read_table(spark, "swap_p", "plain")) == [(2,), (3,), (4,)]


def test_the_profile_comes_with_the_write(spark, tmp_path):
    """Every row is computed once: the observation needs no scan of its own."""
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    counted = F.udf(count, "bigint").asNondeterministic()
    df = spark.range(100).select(counted("id").alias("v"), F.when(F.col("id") < 30, F.date_add(F.lit("2024-02-03").cast("date"), F.col("id").cast("int"))).alias("day"), F.lit("x").alias("s"))
    told = catalog.save_table(df, "profiled", "t", str(tmp_path / "wh"), profile=True, dates="day")
    assert seen.value == 100
    found = {(r["column"], r["metric"]): r["value"] for r in told.collect()}
    assert found["*", "n_rows"] == 100 and found["*", "n_columns"] == 3
    assert found["v", "mean"] == 49.5 and found["v", "max"] == 99 and found["day", "nulls"] == 70 and found["s", "nulls"] == 0
    assert found["day", "last_day"] - found["day", "first_day"] == 29
    empty = catalog.save_table(df.limit(0), "profiled", "e", profile=True, dates="day")
    assert {r["value"] for r in empty.where("metric = 'n_rows'").collect()} == {0}
    assert empty.where("metric in ('mean', 'first_day')").where("value is not null").count() == 0


ODD = ["a", "}{", '"]}', "\\", '\\"features":[{', "[[[", "é\n", '{"x":[1]}', '\\\\"}', None, ""]
SPLIT_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])


def _odd_features(first, last):
    return [
        {
            "type": "Feature",
            "geometry": {"type": "Point", "coordinates": [k / 7, k / 3]} if k % 5 else None,
            "properties": {"id": k, "s": ODD[k % len(ODD)], "nested": {"features": [{"a": 1}]}},
        }
        for k in range(first, last)
    ]


def _documents(folder):
    collection = {"type": "FeatureCollection"}
    around = {"crs": {"p": {"name": "x"}}, "bbox": [1, 2], "links": [{"a": 1}, {"b": [2]}]}
    texts = [
        json.dumps({**collection, **around, "features": _odd_features(0, 120), "after": [{"q": 1}], "z": {"y": 1}}),
        json.dumps({"features": _odd_features(120, 150), **collection}, indent=1) + "\n",
        json.dumps({"type": "Error", "features": _odd_features(0, 2)}),
        "<html>{error} 500</html>",
        json.dumps({**collection, "features": _odd_features(400, 430)})[:-40],
        json.dumps({**collection, "features": []}),
        json.dumps({**collection, "features": _odd_features(500, 510)}).replace('"id": 505', '"id" 505'),
        "",
        json.dumps({**collection, "features": None}),
    ]
    for k, text in enumerate(texts, 1):
        (folder / f"page={k}.json").write_text(text)


@pytest.mark.parametrize("size", ["128m", "700b"])
def test_documents_are_split_anywhere(spark, tmp_path, size):
    """Strings with brackets and quotes, other arrays, bad pages: as the reader of whole documents."""
    _documents(tmp_path)
    whole = files.read_features(spark, str(tmp_path), SPLIT_SCHEMA)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        parts = splitting._pieces(spark, str(tmp_path)).where("file LIKE '%page=1.json'").select("split").distinct().count()
        found = files.read_features(spark, str(tmp_path), SPLIT_SCHEMA, split=True)
        assert rows(found) == rows(whole) and found.columns == whole.columns and found.count() == 150
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert (parts > 5) == (size == "700b")
    _, documents = splitting.read_split_collections(spark, str(tmp_path), SPLIT_SCHEMA)
    assert {r["page"] for r in documents.where("type = 'FeatureCollection'").collect()} == {1, 2, 6, 9}


def test_a_first_document_that_is_none_is_an_error(spark, tmp_path):
    (tmp_path / "page=1.json").write_text("<html>")
    with pytest.raises(ValueError, match="first page"):
        files.read_features(spark, str(tmp_path), SPLIT_SCHEMA, split=True)


def test_files_of_one_folder_by_their_own_header(spark, tmp_path):
    """Two orders of columns in one folder; names with blanks; bad values with ANSI mode off."""
    schema = T.StructType([T.StructField("A", T.IntegerType()), T.StructField("B", T.IntegerType())])
    folder = tmp_path / "two orders"
    folder.mkdir()
    (folder / "x 1.txt").write_text("# note\n\n#A, B\n  A,   B\t,C\n 1,  2, p\n 3,, q\n")
    (folder / "x%2.txt").write_text("# other\nC,B,A\nr,5,4\n# last\n")
    (folder / "x 3.txt").write_text("A,B,C\n7,8,s\n")
    (folder / "empty.txt").write_text("# nothing\n")
    read = files.read_commented(spark, str(folder), schema)
    assert read.columns == ["A", "B", "C"]
    assert rows(read) == rows(spark.createDataFrame([(1, 2, "p"), (3, None, "q"), (4, 5, "r"), (7, 8, "s")], "A int, B int, C string"))
    (folder / "x 4.txt").write_text("A,B,C\n7,x8,s\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="B: x8"):
            files.read_commented(spark, str(folder), schema).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    (folder / "x 5.txt").write_text("A,D\n1,2\n")
    with pytest.raises(Exception):
        files.read_commented(spark, str(folder), schema).collect()


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    left = spark.range(500).select((F.col("id") % 50).alias("k"), (F.col("id") % 7).cast("int").alias("h"), "id")
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 7).cast("int").alias("h"), F.lit("x").alias("v"))
    catalog.save_table(left, "bucketed_t", "l", str(tmp_path / "wh"), buckets=4, by=["k", "h"])
    catalog.save_table(right, "bucketed_t", "r", buckets=4, by=["k", "h"])

    def joined():
        return catalog.read_table(spark, "bucketed_t", "l").join(catalog.read_table(spark, "bucketed_t", "r").hint("merge"), ["k", "h"])

    assert "Exchange" not in plan(joined())
    assert joined().count() == left.join(right, ["k", "h"]).count()
    catalog.save_table(catalog.read_table(spark, "bucketed_t", "l").where("id < 100"), "bucketed_t", "l", buckets=4, by=["k", "h"])
    assert "Exchange" not in plan(joined()) and catalog.read_table(spark, "bucketed_t", "l").count() == 100
    catalog.save_table(left, "bucketed_t", "l")
    assert "Exchange" in plan(joined()) and catalog.read_table(spark, "bucketed_t", "l").count() == 500
    assert {t.name for t in spark.catalog.listTables("bucketed_t")} == {"l", "r"}


def test_small_pages_are_written_by_all_cores(spark, tmp_path):
    path = str(tmp_path / "pages")
    bodies = spark.range(64).selectExpr("CAST(id AS INT) AS page", "'{}' AS value")
    staged._write_pages(bodies, path)
    files = list((tmp_path / "pages").glob("page=*/part-*"))
    tasks = {f.name.split("-")[1] for f in files}
    assert len(files) == 64 and len(tasks) > min(spark.sparkContext.defaultParallelism, 4) // 2
