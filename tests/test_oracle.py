"""Every catalogue query against its DuckDB oracle at sf0.01 (row count, column
names, order-insensitive values), as the driver's correctness gate does."""

import os

import pytest

import __spark_entry__ as E
from civiclake.plans.oracle import SQL as SQLS
from civiclake.plans.queries import REGISTRY as QUERIES
from tools.oracle_check import TABLES, value_hash

SF = os.environ.get("CIVICLAKE_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQLS)
    assert set(QUERIES) <= set(E.queries()) and set(SQLS) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "taxa_obitos_100k" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQLS[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert value_hash(df.columns, rows)[0] == value_hash(ocols, orows)[0]
