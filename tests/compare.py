"""Run a query and its SQL statement over the same tables and compare all rows."""

import math
from pathlib import Path

import duckdb

TABLES = ["events", "orders"]


def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=repr)


def compare(spark, sf_dir, query, sql):
    got = query(spark, sf_dir)
    want = duck(sf_dir).execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    expected = rows(names, want.fetchall())
    actual = rows(got.columns, got.collect())
    assert len(actual) == len(expected)
    assert actual == expected
    return len(actual)
