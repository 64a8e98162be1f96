"""Catalog tables, audited publication, snapshots by year, figures by filter choice."""

import random
import statistics

from pyspark.sql import functions as F

from civiclake import schemas
from civiclake.functions.keys import KEY
from civiclake.operators import core
from civiclake.plans import batch, marts, published
from civiclake.plans.landing import land_from_tables
from civiclake.session import scratch_dir
from civiclake.sinks import tables as sinks
from civiclake.sources import payloads, snapshots

SF = "/root/testdata/sf0.001"


def test_catalog_rows_equal_published_rows(spark):
    landing = land_from_tables(spark, SF, scratch_dir(spark, "landing"))
    lake = scratch_dir(spark, "lake")
    db = "cat_" + lake.rsplit("-", 1)[-1]
    res = batch.run(spark, landing, lake, 1998, all_municipalities=True, include=("pib", "cnes"), database=db, check=True)
    assert set(snapshots.list_tables(spark, db)) == set(schemas.TABLES)
    for t, df in res.gold.items():
        served = sinks.published(spark, db, t)
        assert served.exceptAll(df.select(*served.columns)).isEmpty() and df.select(*served.columns).exceptAll(served).isEmpty(), t
        assert res.audit[t]["publicadas"] == df.count() and res.checks[t][0] == 0
    assert sinks.published(spark, db, "gold_transparencia_transferencias").count() == 0      # not in this run: empty
    m = published.mart(spark, db, "saude")
    assert m.columns[-1] == "data_carga" and m.where("data_carga is null").isEmpty() and m.count() > 0
    # a second year is registered beside the first, and a filter prunes to its partition
    batch.run(spark, landing, lake, 1997, all_municipalities=True, database=db)
    health = spark.table(f"{db}.gold_indicadores_saude_municipio")
    assert {r.ano for r in health.select("ano").distinct().collect()} == {1997, 1998}
    files = health.where("ano = 1997").select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("ano=1997" in r.f for r in files)
    assert "PartitionFilters: [isnotnull(ano" in health.where("ano = 1997")._jdf.queryExecution().executedPlan().toString()
    assert {r.kind for r in snapshots.snapshot_inventory(spark, f"{lake}/bronze").collect()} >= {"ibge_pib", "cnes_estabelecimentos", "ibge_populacao"}
    assert snapshots.latest_by_year(spark, f"{lake}/silver", "ibge_populacao", 1998).count() == snapshots.latest_by_year(spark, f"{lake}/bronze", "ibge_populacao", 1998).count()


def test_education_source_order(spark, tmp_path):
    landing = land_from_tables(spark, SF, scratch_dir(spark, "landing"))
    (tmp_path / "matricula.csv").write_text("ID;CO_MUNICIPIO\n1;3550308\n")
    landing.microdados = str(tmp_path)
    assert batch.run(spark, landing, scratch_dir(spark, "lake"), 1998).education_source == "sinopse"
    assert batch.run(spark, landing, scratch_dir(spark, "lake"), 1998, microdata_first=True).education_source == "microdados"
    landing.sinopse = None
    assert batch.run(spark, landing, scratch_dir(spark, "lake"), 1998).education_source == "microdados"


def test_audit_counts_and_refusal(spark, tmp_path):
    path = str(tmp_path / "gold_pib_municipio")
    rows = [("0000001", 2020, 1.0), ("0000001", 2020, 3.0), ("0000002", None, 1.0), (None, 2020, 1.0), (None, None, 1.0), ("0000003", 2021, None)]
    df = spark.createDataFrame(rows, f"{KEY} string, ano int, pib_total_mil_reais double")
    dim = spark.createDataFrame([("0000001",)], f"{KEY} string")
    want = {"lidas": 6, "sem_chave": 2, "sem_ano": 1, "duplicadas": 1, "publicadas": 2, "orfas": 1}
    assert sinks.publish_audited(df, path, "gold_pib_municipio", dim) == want
    read = lambda: sorted((r[KEY], r.ano, r.pib_total_mil_reais) for r in sinks.read_table(spark, path, "gold_pib_municipio").collect())
    assert read() == [("0000001", 2020, 3.0), ("0000003", 2021, None)]
    again = spark.createDataFrame([("0000009", 2020, 9.0)], df.schema)
    sinks.publish_audited(again, path, "gold_pib_municipio", accept=lambda c: c["publicadas"] > 1)
    assert read() == [("0000001", 2020, 3.0), ("0000003", 2021, None)]
    counts = sinks.publish_audited(df.limit(0), path, "gold_pib_municipio")
    assert counts["lidas"] == 0 and len(read()) == 2


def test_source_is_computed_once_while_publishing(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()
    rows = spark.createDataFrame([("0000001", 2024), ("0000002", 2024)], f"{KEY} string, ano int").coalesce(1)
    sinks.publish_audited(rows.withColumn(KEY, count(KEY)), str(tmp_path / "t"), "gold_pib_municipio")
    assert seen.value == 2


def test_median_of_all_grouping_sets(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, float("nan"), *map(float, range(9))])) for _ in range(500)]
    rows += [("c", 3, float(i % 50) + i / 1e6) for i in range(3000)]
    got = core.exact_median_by(spark.createDataFrame(rows, "g string, h int, v double").repartition(5), ["g", "h"], "v")
    groups = {}
    for g, h, v in rows:
        if v is not None and v == v:
            for mask in range(4):
                groups.setdefault((None if mask & 1 else g, None if mask & 2 else h, mask), []).append(v)
    assert {(r.g, r.h, r._total): r.mediana for r in got.collect()} == {k: statistics.median(v) for k, v in groups.items()}
    assert core.exact_median_by(spark.createDataFrame([], "g string, h int, v double"), ["g", "h"], "v").collect() == []


def test_figures_of_every_choice_equal_the_filtered_ones(spark):
    from civiclake.plans.queries import _marts
    m = _marts(spark, SF)
    got = {(r.uf, r.ano): r for r in marts.filtered_kpis(m["saude"], m["educacao"], m["pib"], m["transferencias"], m["cnes"]).collect()}
    states = [r[0] for r in m["saude"].select("sigla_uf").distinct().collect()]
    assert len(got) > len(states)
    for uf, ano in [("Todos", "Todos"), (states[0], "Todos"), ("Todos", "1998"), (states[0], "1997")]:
        one = {t: core.dashboard_filter(df, uf, ano if ano == "Todos" else int(ano)) for t, df in m.items()}
        want = marts.overview_kpis(one["saude"], one["educacao"], one["pib"], one["transferencias"], one["cnes"]).first()
        r = got[uf, ano]
        for c in ("municipios", "populacao_total", "matriculas", "docentes", "escolas", "estabelecimentos", "leitos", "pib_per_capita_mediano"):
            assert r[c] == want[c], (uf, ano, c)
        assert abs((r.pib_total_mil_reais or 0) - (want.pib_total_mil_reais or 0)) < 1e-3 and abs(r.transferencias_bi - want.transferencias_bi) < 1e-9


def test_gdp_candidates_in_one_parse(spark):
    def item(var, serie):
        return '{"id":"%s","resultados":[{"series":[{"localidade":{"id":"3550308"},"serie":%s}]}]}' % (var, serie)
    def rows(text, years):
        items = payloads.series_from_text(spark.createDataFrame([(text,)], "payload string"))
        df, ano = payloads.gdp_by_preference(items, years)
        return [tuple(r) for r in df.collect()], ano
    total, each = item(37, '{"2021":"5","2019":"1"}'), item(498, '{"2020":"7"}')
    both = f"[{total},{each}]"
    assert rows(both, [2022, 2021, 2023]) == ([("3550308", 2021, 5.0, None)], 2021)
    assert rows(both, [2020, 2021]) == ([("3550308", 2020, None, 7.0)], 2020)
    assert rows(both, [2030]) == ([("3550308", 2030, 5.0, 7.0)], 2030)
    assert rows("[]", [2030]) == ([], 2030)
