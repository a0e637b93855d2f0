"""Compare a query with its SQL statement: columns by name, rows in any order, values exactly."""

from __future__ import annotations

import os

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v + 0.0, 9) if isinstance(v, float) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    for a, b in zip(got, expected, strict=True):
        if repr(a) != repr(b):
            return f"{sorted(df.columns)}\n  spark {a}\n  sql   {b}\n  {types}"
    return ""
