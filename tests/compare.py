"""Value comparison of a Spark result with the SQL check engine's result."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None if both sides hold the same rows under the same names, else what differs."""
    result = connection.execute(sql)
    names, kinds = [c[0] for c in result.description], [str(c[1]) for c in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    want = dict(zip(names, kinds))
    for name, kind in spark_df.dtypes:
        if spark_kinds.get(kind, kind) != want[name]:
            return f"type of {name}: {kind} against {want[name]}"
    got = rows_of(spark_df.columns, spark_df.collect())
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{got.total()} rows against {expected.total()}; "
        f"only in Spark {list(extra)[:3]}; only in SQL {list(missing)[:3]}"
    )
