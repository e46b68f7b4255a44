"""Runs a registered query and its SQL on the same tables and compares them row by row."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"DATE": "date", "VARCHAR": "string", "DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int",
         "BOOLEAN": "boolean"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def differences(result, connection, sql: str) -> list[str]:
    """Empty when both sides have the same columns, types and rows (any order)."""
    expected = connection.sql(sql)
    want_types = {n: TYPES.get(str(t), str(t)) for n, t in zip(expected.columns, expected.types)}
    have_types = dict(result.dtypes)
    problems = [] if want_types == have_types else [f"types: expected {want_types}, got {have_types}"]
    names = sorted(have_types)
    if names != sorted(want_types):
        return problems
    have = Counter(tuple(row[n] for n in names) for row in result.collect())
    order = [expected.columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    if have != want:
        problems.append(f"rows: expected {sum(want.values())}, got {sum(have.values())}; "
                        f"missing {str(list((want - have).items())[:3])[:600]}; "
                        f"extra {str(list((have - want).items())[:3])[:600]}")
    return problems
