"""Run registered queries and their SQL twins side by side."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT", "double": "DOUBLE",
    "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(_value(r[k]) for k in order) for r in rows)


def difference(spark, connection, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when names, types and rows agree, else what differs."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    relation = connection.sql(sql)
    ours = {c: SAME_TYPE.get(t, t) for c, t in df.dtypes}
    theirs = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        return f"{name}: schema {sorted(set(ours.items()) ^ set(theirs.items()))}"
    a, b = _bag(df.columns, rows), _bag(relation.columns, relation.fetchall())
    if a != b:
        return f"{name}: {len(rows)} rows, sql {sum(b.values())}; only ours {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}"
    return None


def main(sf: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from galegrid.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    connection, twins = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in twins:
                found = difference(spark, connection, name, query, twins[name], sf_dir)
            else:
                found = f"no sql, {len(query(spark, sf_dir).collect())} rows"
        except Exception as error:  # noqa: BLE001
            found = f"ERROR {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
