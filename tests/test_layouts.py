"""Variants tell absent from null; file order does not follow split sizes; bucketed
marts join without an exchange."""

import json

from pyspark.sql import functions as F

from civiclake.functions.keys import KEY
from civiclake.plans import gold, published
from civiclake.session import scratch_dir
from civiclake.sinks import tables as sinks
from civiclake.sources import payloads


def pages(spark, *texts):
    return spark.createDataFrame([(t if t is None or isinstance(t, str) else json.dumps(t),) for t in texts], "payload string")


def test_records_of_any_page(spark):
    p = pages(spark, [{"a": 1}], {"data": None, "items": [{"a": 2}]}, {"items": [{"a": 3}, {"a": None}, {}]}, "no json", "[", None, 5, [], {"data": 7}, '  [{"a": "x"}]')
    rows = payloads.variant_fields(payloads.variant_records(p, "payload", ["data", "items"]), ["a"])
    assert sorted(((r.a, r.tem_a) for r in rows.collect()), key=str) == sorted([("1", True), ("3", True), (None, True), (None, False), ("x", True)], key=str)


def facilities(spark, *texts):
    got = gold.facility_counts(payloads.facility_rows_from_variants(pages(spark, *texts), "payload", 2024), stamp=False).collect()
    return [(r.total_estabelecimentos, r.hospitais, r.leitos_totais) for r in got]


def test_facility_columns_are_those_of_the_payload(spark):
    def rec(**more):
        return {"co_municipio": "3550308", "qt_leito": "3", **more}
    assert facilities(spark, [rec(st_ativo="S"), rec(st_ativo=None), rec()]) == [(1, 0, 3)]      # the column exists: null and absent are not active
    assert facilities(spark, [rec(), rec()]) == [(2, 0, 6)]                                      # it does not: all are
    first_wins = [rec(co_tipo_estabelecimento=None, ds_tipo_estabelecimento="HOSPITAL"), rec(co_tipo_estabelecimento="05")]
    assert facilities(spark, first_wins) == [(2, 1, 6)]
    assert facilities(spark, [rec(ds_tipo_estabelecimento="HOSPITAL GERAL")], {"data": [rec()]}) == [(2, 1, 6)]
    assert facilities(spark, {"estabelecimentos": None, "data": [rec()]}) == []


def test_first_row_in_file_order_for_any_split_size(spark, tmp_path):
    d = tmp_path / "c"
    d.mkdir()
    rows = [f"{1000000 + i % 400},{i / 10},{-i / 10}" for i in range(4000)]
    for k in range(4):
        (d / f"part-{k}.csv").write_text("codigo_ibge,latitude,longitude\n" + "\n".join(rows[k * 1000:(k + 1) * 1000]) + "\n")
    from civiclake.plans.marts import first_centroids
    want = {str(1000000 + i): i / 10 for i in range(400)}
    for size in ("128m", "1k", "7k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r[KEY]: r.latitude for r in first_centroids(payloads.read_centroids(spark, str(d))).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == want, size


def test_bucketed_mart_has_no_exchange(spark):
    loc = scratch_dir(spark, "by-key")
    db = "bk_" + loc.rsplit("-", 1)[-1]
    sinks.create_tables(spark, db, loc)
    rows = spark.range(1000).select(F.format_string("%07d", "id").alias(KEY), F.lit(2020).alias("ano"), F.col("id").alias("populacao"))
    dim = spark.range(900).select(F.format_string("%07d", "id").alias(KEY), F.lit("n").alias("nome_municipio"), F.lit("UF").alias("sigla_uf"))
    g = published.publish_by_key(spark, db, loc, "gold_indicadores_saude_municipio", rows, 4)
    d = published.publish_by_key(spark, db, loc, "dim_municipio", dim, 4)
    m = published.mart_by_key(spark, g, d, "saude")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert m.count() == 1000 and m.where("sigla_uf is null").count() == 100
