"""Run registered queries beside their SQL and compare row count, schema names and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def second_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        if name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both give the same result."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {d[0]: str(d[1]).split("(")[0] for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    odd = {n: (t, kinds[n]) for n, t in df.dtypes if same.get(t) != kinds[n]}
    if odd:
        return f"types {odd}"
    found = _rows(df.columns, df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows != {len(expected)}"
    for a, b in zip(found, expected):
        if a != b:
            return f"{a} != {b}"
    return ""
