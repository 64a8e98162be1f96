"""Landed files of differing layout lose nothing; upserts keep what they do not replace."""

import pytest
from pyspark.sql import functions as F

from civiclake.plans import gold
from civiclake.sinks import tables as sinks
from civiclake.sources import files, payloads, snapshots


def test_event_files_of_two_key_types_and_mixed_year(spark, tmp_path):
    d = tmp_path / "sim"
    spark.createDataFrame([("3550308",), ("3550308",)], "CODMUNRES string").write.parquet(str(d / "a"))
    spark.createDataFrame([(3550308, 2023), (3304557, 2024)], "CODMUNRES long, ano int").write.parquet(str(d / "b"))
    report = files.ScanReport()
    got = {tuple(r)[:2]: r.total_obitos for r in files.death_counts(spark, str(d), 2024, report).collect()}
    assert got == {("3550308", 2024): 2, ("3304557", 2024): 1}
    assert not report.skipped


def test_microdata_of_other_order_count_and_encoding(spark, tmp_path):
    d = tmp_path / "inep"
    d.mkdir()
    (d / "matricula_1.csv").write_text("ID;CO_MUNICIPIO\n9999999;3550308\n8888888;3550308\n")
    (d / "matricula_2.csv").write_text("CO_MUNICIPIO;ID\n3304557;7777777\n")
    (d / "matricula_3.csv").write_bytes("SIT\u00c7;ID;CO_MUNICIPIO\nx;1;3304557\n".encode("latin-1"))
    got = {r[0]: r.matriculas for r in files.microdata_counts(spark, str(d), 2024).collect()}
    assert got == {"3550308": 2, "3304557": 2}


def test_sheet_with_dotted_header_and_dash_cells(spark):
    sheet = spark.createDataFrame([("3550308", "10"), ("3304557", "-")], "`C\u00f3d. Munic\u00edpio` string, matriculas string")
    got = {r[0]: r.matriculas for r in files.synopsis_sums([sheet], 2024).collect()}
    assert got == {"3550308": 10.0, "3304557": 0.0}


def test_facilities_without_the_active_field(spark):
    rows = spark.createDataFrame([("3550308", None, None, "HOSPITAL"), ("3550308", "N", None, "HOSPITAL"), ("35503081", None, None, "HOSPITAL")],
                                 "co_municipio string, st_ativo string, co_tipo_estabelecimento string, ds_tipo_estabelecimento string")
    got = gold.facility_counts(payloads.facility_rows(rows, 2024)).collect()
    assert [(r.total_estabelecimentos, r.hospitais) for r in got] == [(1, 1)]


def test_gdp_takes_the_exact_year(spark):
    text = spark.createDataFrame([('[{"id":"37","resultados":[{"series":[{"localidade":{"id":"3550308"},"serie":{"2021":"5"}}]}]}]',)], "payload string")
    items = payloads.series_from_text(text)
    assert payloads.gdp_rows(items, 2022, exact=True).count() == 0
    assert payloads.gdp_rows(items, 2021, exact=True).count() == 1


def test_upsert_rejects_null_keys_and_stops_on_listing_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1, 2023), ("b", 2, 2024)], "k string, v int, ano int")
    assert sinks.upsert_partitioned(spark, path, old, ["k", "ano"], "ano") == 0
    new = spark.createDataFrame([("b", 3, 2024), ("c", 4, None)], "k string, v int, ano int")
    assert sinks.upsert_partitioned(spark, path, new, ["k", "ano"], "ano") == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [("a", 1), ("b", 3)]
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        sinks.upsert_partitioned(spark, "nosuchfs://x/t", new, ["k", "ano"], "ano")


def test_upsert_evaluates_the_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()
    rows = spark.createDataFrame([("a", 2024), ("b", 2024)], "k string, ano int").coalesce(1)
    for _ in range(2):
        seen.value = 0
        sinks.upsert_partitioned(spark, str(tmp_path / "t"), rows.withColumn("k", count("k")), ["k", "ano"], "ano")
        assert seen.value == 2


def test_newest_committed_snapshot_even_if_empty(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "x int")
    one.write.parquet(str(tmp_path / "s1" / "parquet"))
    one.limit(0).write.parquet(str(tmp_path / "s2" / "parquet"))
    one.write.parquet(str(tmp_path / "s3" / "parquet"))
    (tmp_path / "s3" / "parquet" / "_SUCCESS").unlink()
    import os
    os.utime(tmp_path / "s1" / "parquet" / "_SUCCESS", (1, 1))
    assert snapshots.latest_snapshot(spark, str(tmp_path / "*" / "parquet")).count() == 0
    assert snapshots.latest_snapshot(spark, str(tmp_path / "none" / "*")) is None
