"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from colfit.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(df.columns, df.collect()) == normal(names, cursor.fetchall())


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() == 4


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
