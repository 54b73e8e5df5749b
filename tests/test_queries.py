"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(rows):
    return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows], key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    names = sorted(df.columns)
    found = con.execute(ORACLES[name])
    described = [c[0] for c in found.description]
    assert sorted(described) == names
    at = [described.index(n) for n in names]
    assert canonical([tuple(r[n] for n in names) for r in df.collect()]) == canonical([tuple(r[i] for i in at) for r in found.fetchall()])


def test_entry(spark):
    assert driver.entry(spark).count() == 849


def test_all_queries_are_described():
    assert len(driver.queries()) >= 45
