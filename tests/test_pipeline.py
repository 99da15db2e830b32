"""From files to training rows, and the shape of the physical plans."""

from __future__ import annotations

import json

import pytest
from conftest import plan, rows

import __spark_entry__ as entry
from galegrid import schemas
from galegrid.operators import align, grid, model, nearest, profile_counts
from galegrid.sources import catalog, loaders
from pyspark.sql import types as T


def collection(*features):
    return json.dumps({"type": "FeatureCollection", "features": list(features)})


def feature(shape, coordinates, **properties):
    return {"type": "Feature", "geometry": {"type": shape, "coordinates": coordinates}, "properties": properties}


@pytest.fixture
def landed(tmp_path):
    columns = schemas.WEATHER_COLUMNS
    lines = ["# hourly weather", ",".join(f" {c}" for c in columns)]
    for hour, wind in ((1, (10, 20, 30, 40)), (2, (10, 20, 30, 40)), (3, (50, 60, 70, 80)), (4, (1, 1, 1, ""))):
        lines.append(",".join(map(str, [240, 20240101, hour, *wind, *[0] * (len(columns) - 7)])))
    (tmp_path / "weather.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "incidents.csv").write_text(
        "Incident_ID,Date,LON,LAT,Incident_Starttime,Damage_Type\n"
        "1,2024-01-01,0.5,0.5,2024-01-01 02:10:00,Tree\n"
        "2,2024-01-01,0.5,0.5,2024-01-01 02:50:00,Tree\n"
        "3,2024-01-01,1.5,0.5,2024-01-01 03:00:00,NULL\n"
        "4,2024-01-01,1.5,0.5,2024-01-01 04:00:00,Tree\n"
    )
    square = lambda x: [[[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]]
    (tmp_path / "areas").mkdir()
    (tmp_path / "areas" / "wijken.json").write_text(
        collection(
            feature("Polygon", square(0), wijkcode="W1", wijknaam="Oost", gemeentenaam="Amsterdam"),
            feature("Polygon", square(1), wijkcode="W2", wijknaam="West", gemeentenaam="Diemen"),
            feature("Polygon", square(9), wijkcode="W3", wijknaam="Leeg", gemeentenaam="Diemen"),
            feature("Polygon", square(0), wijkcode="W4", wijknaam=" ", gemeentenaam="Diemen"),
        )
    )
    (tmp_path / "trees").mkdir()
    tree = lambda k, x, kind: feature("Point", [x, 0.5], id=str(k), soortnaamTop=kind, jaarVanAanleg=2000)
    (tmp_path / "trees" / "page_1.json").write_text(collection(tree(1, 0.25, "Linde"), tree(2, 1.0, "Es top")))
    (tmp_path / "trees" / "page_2.json").write_text(collection(tree(3, 1.75, None)))
    return tmp_path


def test_files_to_training_rows(spark, landed):
    weather = loaders.load_weather(spark, str(landed / "weather.txt"))
    schema = T.StructType(
        [f for f in schemas.INCIDENTS if f.name in
         ("Incident_ID", "Date", "LON", "LAT", "Incident_Starttime", "Damage_Type")]
    )
    incidents = align.incident_features(
        loaders.load_incidents(spark, str(landed / "incidents.csv"), schema, decoded=True)
    )
    areas = loaders.load_areas(spark, str(landed / "areas"), "wijkcode", "wijknaam", decoded="polygon")
    trees = align.tree_features(
        loaders.load_features(spark, str(landed / "trees"), schemas.TREE_PROPERTIES, decoded="point"), 2024
    )
    assert rows(trees, "leeftijdBoom") == [(24,)] * 3

    profile = profile_counts.area_profile(areas, trees, "wijknaam", ["soortnaamTop"])
    assert profile.columns == ["wijknaam", "Trees_Totaal", "Trees_soortnaamTop_Es-top", "Trees_soortnaamTop_Linde"]
    assert rows(profile) == [("Oost", 2, 1, 1), ("West", 2, 1, 0)]

    # Stored like any other table, then read back.
    catalog.save_table(profile, "joined_p", "wijken_bomen", str(landed / "tables"))
    stored = catalog.read_table(spark, "joined_p", "wijken_bomen")

    aligned = align.align_hourly(weather, incidents)
    counts = align.label_counts(aligned)
    labelled = grid.labelled_set(areas, weather, stored, counts, "wijkcode", "wijknaam")
    out = grid.training_rows(labelled, drop=["wijkcode"])
    # Windy condition 1: hour 1 empty, hour 2 two trees; condition 2: one unnamed incident;
    # the condition with a null gust finds no counts. Two areas have trees.
    per_area = [("No-Incident", 10), ("No-Incident", 50), ("Tree", 10), ("Tree", 10)]
    assert rows(out, "wijknaam", "Damage_Type", "DD") == sorted(
        (a, t, d) for a in ("Oost", "West") for t, d in per_area
    )

    hit = nearest.nearest_features(trees.drop("x", "y"), incidents.drop("x", "y"))
    assert rows(hit, "id", "Incident_ID") == [
        ("1", 1), ("1", 2), ("2", 1), ("2", 2), ("2", 3), ("2", 4), ("3", 3), ("3", 4),
    ]

    table = model.count_table(aligned, ["YYYYMMDD", "HH", "Damage_Type", "DD"], order=["YYYYMMDD", "HH"])
    assert [(r.HH, r.Incident_Count) for r in table.collect()] == [(1, 0), (2, 2), (3, 1), (4, 1)]


PLANNED = [
    "label_counts", "hourly_align", "incidents_by_hour", "spatial_join", "spatial_polygons_shuffled",
    "area_profile", "label_grid", "training_rows", "nearest_incident",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_in_the_engine(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for operator in ("NestedLoop", "Cartesian", "Python", "Pandas"):
        assert operator not in text


def test_points_are_not_shuffled_to_a_small_area_table(spark, sf_dir):
    assert "Exchange hashpartitioning" not in plan(entry.queries()["spatial_join"](spark, sf_dir))


def test_scans_read_only_what_is_needed(spark, sf_dir):
    text = plan(entry.queries()["spatial_join"](spark, sf_dir))
    schema = next(line for line in text.splitlines() if "lineitem" in line)
    assert "l_comment" not in schema and "l_shipdate" not in schema and "l_tax" not in schema
    filtered = plan(entry.queries()["incidents_by_type"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in filtered


def test_listed_nations_are_pushed(spark, sf_dir):
    assert "In(c_nationkey" in plan(entry.queries()["named_and_listed"](spark, sf_dir))


def test_clear_scratch(spark):
    from galegrid import session

    kept = session.cut_lineage(spark.range(3))
    assert kept.count() == 3
    path = session._scratch_root(spark)
    session.clear_scratch(spark)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path)


def test_configured_folder_is_used(spark, tmp_path, monkeypatch):
    from galegrid import session

    conf = {"spark.checkpoint.dir": str(tmp_path)}
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: conf)
    assert session.staging_path(spark, "x").startswith(f"{tmp_path}/galegrid-")
    assert session.cut_lineage(spark.range(3)).count() == 3
    assert list(tmp_path.iterdir())


def test_a_cluster_needs_the_folder(spark, monkeypatch):
    from galegrid import session

    context = type(spark.sparkContext)
    monkeypatch.setattr(context, "getConf", lambda self: {})
    monkeypatch.setattr(context, "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077", raising=False)
    with pytest.raises(RuntimeError):
        session.shared_dir(spark)


def test_training_rows_shuffle_narrow_rows(spark, sf_dir):
    """No exchange carries the profile, which is broadcast."""
    from galegrid.plans.registry import QUERIES

    text = QUERIES["training_rows"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    shown = QUERIES["training_rows"](spark, sf_dir)
    shuffled = [n for n in text.split("\n") if "Exchange hashpartitioning" in n]
    assert shuffled and not any("Trees_" in n for n in shuffled) and "Trees_Totaal" in shown.columns
