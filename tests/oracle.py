"""Compare registered queries with their SQL on the same Parquet files, ignoring row order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def spark_table(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(connection, sql):
    result = connection.execute(sql)
    return _table([c[0] for c in result.description], result.fetchall())
