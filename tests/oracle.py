"""Compare a Spark result with DuckDB: names, types and values as a bag of rows."""

from __future__ import annotations

import datetime
import decimal
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, order):
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty when names, types and rows agree."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = [str(d[1]) for d in answer.description]
    expected = answer.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} sql {sorted(names)}"]
    spark_types = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if TYPES.get(kind.upper(), kind) != spark_types[name]:
            problems.append(f"type of {name}: spark {spark_types[name]} sql {kind}")
    actual = [tuple(r) for r in df.collect()]
    common = sorted(names)
    left = _bag(actual, [df.columns.index(c) for c in common])
    right = _bag(expected, [names.index(c) for c in common])
    if left != right:
        problems.append(f"rows: spark {sum(left.values())} sql {sum(right.values())}, columns {common}")
        problems += [f"  only spark {r}" for r in list((left - right))[:3]]
        problems += [f"  only sql   {r}" for r in list((right - left))[:3]]
    return problems
