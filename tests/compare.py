"""Runs a query and its SQL on the same tables and compares the rows."""

import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def differences(frame, connection, sql: str) -> str | None:
    """What differs between a Spark result and that of the SQL; None when nothing does."""
    columns = sorted(frame.columns)
    got = Counter(tuple(_value(row[c]) for c in columns) for row in frame.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(_value(row[i]) for i in order) for row in result.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list(extra)[:2]}; missing {list(missing)[:2]}; columns {columns}")[:1500]
