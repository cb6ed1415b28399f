"""Runs registered queries next to their SQL oracles and compares whole results."""

from __future__ import annotations

import math
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value: object) -> object:
    if isinstance(value, Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, name: str, query, sql: str, sf_dir: str) -> str:
    """'' when the results are equal, else what differs."""
    started = time.time()
    df = query(spark, sf_dir)
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    theirs = _rows(names, relation.fetchall())
    took = time.time() - started
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        only = [row for row in ours if row not in set(theirs)][:3]
        other = [row for row in theirs if row not in set(ours)][:3]
        return f"{len(ours)} / {len(theirs)} rows; only ours {only}; only SQL {other}"
    print(f"{name}: {len(ours)} rows, {took:.1f}s")
    return "" if ours else "no rows"
