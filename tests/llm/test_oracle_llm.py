"""Training-data queries against their DuckDB SQL at sf0.01."""

import os

import duckdb
import pytest

from civiclake.llm.queries import REGISTRY, SQL
from tools.oracle_check import TABLES, value_hash

SF = os.environ.get("CIVICLAKE_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert value_hash(df.columns, rows)[0] == value_hash(cols, cur.fetchall())[0]
