"""Plan shapes: the scale properties claimed in the README, checked on the
physical plans of the catalogue queries."""

import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
Q = E.queries()
# queries that only build a plan (no files written while constructing them)
PURE = [n for n in Q if n.startswith(("gold_", "mart_", "top_", "sum_", "scatter", "filter_", "source_",
                                      "stratified", "year_", "key_", "alias", "orphan", "series_",
                                      "envelope", "dim_flatten", "stamp"))]


def plan(spark, name):
    df = Q[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_python_udf_no_cartesian(spark, name):
    p = plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_health_one_scan_one_shuffle_partial_first(spark):
    p = plan(spark, "gold_health")
    assert p.count("orders.parquet") == 1                 # all event kinds in one scan
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len(shuffles) == 1 and "cod_mun_ibge_7" in shuffles[0] and "ano" in shuffles[0]
    assert "partial_max" in p and "partial_sum" in p       # map-side combine before the exchange


def test_year_filter_reaches_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # untruncated scan metadata
    p = plan(spark, "gold_health_year")
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_sample_uses_partial_window_group_limit(spark):
    p = plan(spark, "stratified_sample")
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "TakeOrderedAndProject" in p


def test_top_n_limits_before_label_join(spark):
    p = plan(spark, "top_n_measure")
    assert "TakeOrderedAndProject" in p
    assert "BroadcastExchange" in p                        # the <= n top rows are the broadcast side


def test_column_pruning(spark):
    p = plan(spark, "gold_gdp")
    m = re.search(r"orders.parquet\].*?ReadSchema: (struct<[^>]*>)", p)
    assert m and m.group(1) == "struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>"


def test_population_is_spread_before_the_years_multiply_it(spark):
    """The customer table is a few row groups: no task may expand and aggregate all of it."""
    from civiclake.plans import analogs
    sizes = analogs.v_pop(spark, SF).groupBy(F.spark_partition_id().alias("p")).count().collect()
    n = spark.read.parquet(f"{SF}/customer.parquet").count() * 7
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in sizes) < 1.1 * n / len(sizes)
    assert plan(spark, "gold_health").count("RoundRobinPartitioning") == 1


def test_series_payloads_collect_once(spark):
    """All measures of a customer are collected and sorted as one list."""
    from civiclake.plans.io_queries import series_payloads
    assert series_payloads(spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("collect_list(") == 1
