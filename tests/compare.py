"""Compare a Spark result with the result of its SQL in DuckDB, value by value."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """What differs: columns, types, row count or values (order of rows aside)."""
    relation = connection.sql(sql)
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != sql_types:
        both = set(spark_types) | set(sql_types)
        return [
            f"{c}: {spark_types.get(c)} / {sql_types.get(c)}"
            for c in sorted(both) if spark_types.get(c) != sql_types.get(c)
        ]
    columns = sorted(spark_types)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    theirs = relation.select(*columns).fetchall()
    if len(ours) != len(theirs):
        return [f"rows: {len(ours)} / {len(theirs)}"]
    ours, theirs = sorted(ours, key=repr), sorted(theirs, key=repr)
    return [f"{columns}: {a} / {b}" for a, b in zip(ours, theirs) if repr(a) != repr(b)]
