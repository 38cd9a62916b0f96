"""Every query against the SQL registered next to it, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from flowspark.plans import all_queries
from flowspark.plans.views import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value if isinstance(value, (int, bool, type(None))) else str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    sql = entry.oracle_sql().get(name)
    assert sql is not None
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, want.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
