"""Tables of the session catalogue: save, read, list, drop.

A save writes a new version of the table's files beside the old one and then points the table at
it. Until that moment readers see the old version, a write that fails changes nothing, and a frame
that reads the table can replace it. Tables can be stored in sorted buckets of the columns that they
will be joined by; a join of two such tables then shuffles neither.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import quoted
from ..operators.quality import observe_profile
from ..session import delete

#: Table property that names the folder with a table's versions.
VERSIONS = "galegrid.versions"
#: Table property that names the buckets.
LAYOUT = "galegrid.layout"


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(spark: SparkSession, name: str) -> dict[str, str] | None:
    """The properties of a table; None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _location(spark: SparkSession, schema: str) -> str:
    """Where a schema keeps its tables; the catalogue gives it as an encoded URI."""
    uri = spark._jvm.java.net.URI(spark.catalog.getDatabase(_name(schema)).locationUri)
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString().rstrip("/")


def save_table(
    df: DataFrame,
    schema: str,
    table: str,
    location: str | None = None,
    profile: bool = False,
    dates: str | None = None,
    buckets: int = 0,
    by: Sequence[str] = (),
) -> DataFrame | None:
    """Write `schema.table` as Parquet, replacing what it held once all is written.

    `location` is where a new schema keeps its tables; by default the warehouse folder. With
    `profile` the write itself observes the rows: the result is a table (column, metric, value) of the
    number of rows and columns, nulls, count, mean, std, min and max, at no further scan; `dates`
    adds the first and last day of that column. `buckets` deals the rows to that many buckets by the
    columns `by`, a sorted file for each; tables that are to be joined need the same number and
    columns of the same types. A key with very many rows makes a large bucket. The version before the
    last stays until the next save, for readers that still go through it.
    """
    spark = df.sparkSession
    where = "" if location is None else f" LOCATION {_text(location)}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(schema)}{where}")
    name = _name(schema, table)
    found = _properties(spark, name)
    folder = f"{_location(spark, schema)}/{table}.versions"
    path = f"{folder}/{uuid.uuid4().hex}"
    told = None
    if profile:
        df, told = observe_profile(df, dates=dates)
    layout = f"{buckets}: {', '.join(by)}" if buckets else ""
    try:
        _write(df, path, _name(schema, f"{table}_{path.rsplit('/', 1)[1]}"), buckets, by)
    except BaseException:
        delete(spark, path)
        raise
    same = found is not None and VERSIONS in found and found.get(LAYOUT, "") == layout
    if same and spark.table(name).schema == spark.read.parquet(path).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")
        spark.catalog.refreshTable(name)
    else:
        # other columns: files of a version are not the table's own, so they outlive its entry
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        written = spark.read.parquet(path)
        columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in written.schema.fields)
        keys = ", ".join(_name(c) for c in by)
        clustered = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if buckets else ""
        properties = f"{_text(VERSIONS)} = {_text(folder)}, {_text(LAYOUT)} = {_text(layout)}"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{clustered} LOCATION {_text(path)} TBLPROPERTIES ({properties})")
    _forget(spark, folder, path)
    return told() if told else None


def _write(df: DataFrame, path: str, entry: str, buckets: int, by: Sequence[str]) -> None:
    """The files of a version; buckets are written through an entry of the catalogue that goes again."""
    if not buckets:
        df.write.format("parquet").save(path)
        return
    dealt = df.repartition(buckets, *[quoted(c) for c in by])
    try:
        dealt.write.format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(entry)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {entry}")


def _forget(spark: SparkSession, folder: str, path: str) -> None:
    """Delete all versions but this one and the one before."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    versions = sorted(((f.getModificationTime(), f.getPath().getName()) for f in listed), reverse=True)
    current = path.rsplit("/", 1)[1]
    for _, version in [v for v in versions if v[1] != current][1:]:
        delete(spark, f"{folder}/{version}")


def read_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """The table as a DataFrame; an unknown name is an error."""
    return spark.table(_name(schema, table))


def drop_table(spark: SparkSession, schema: str, table: str) -> None:
    """Drop a table with all its versions; one that is not there is no error."""
    name = _name(schema, table)
    found = _properties(spark, name) or {}
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if VERSIONS in found:
        delete(spark, found[VERSIONS])


def list_tables(spark: SparkSession) -> DataFrame:
    """All tables of the catalogue with their column names and types."""
    rows = []
    for database in spark.catalog.listDatabases():
        for table in spark.catalog.listTables(database.name):
            if table.isTemporary:
                continue
            columns = spark.catalog.listColumns(_name(database.name, table.name))
            rows.append(
                (database.name, table.name, [c.name for c in columns], [c.dataType for c in columns])
            )
    return spark.createDataFrame(
        rows, "schema string, name string, column_names array<string>, column_types array<string>"
    )
