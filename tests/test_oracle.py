"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    got = table(frame.columns, frame.collect())
    cursor = duck.execute(ORACLE[name])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE) - {"pipeline"}))
def test_query_without_sql_runs(spark, name):
    if name.startswith("op"):
        pytest.skip("has tests of its own")
    assert not entry.queries()[name](spark, FOLDER).isEmpty()


def test_entry(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and "n_blocks" in found.columns
