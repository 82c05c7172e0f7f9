"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not there")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return "NaN" if math.isnan(v) else repr(float(v) + 0.0)
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert table(got.columns, got.collect()) == table(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, SF).collect()) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
