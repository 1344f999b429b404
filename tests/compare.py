"""Comparison of Spark results with DuckDB results, as sorted rows by column name."""

import datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def oracle_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return canonical(names, result.fetchall())


def spark_rows(frame):
    return canonical(frame.columns, [tuple(row) for row in frame.collect()])


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    columns = [names[i] for i in order]
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return columns, sorted(cells, key=repr)


def _cell(value):
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value
