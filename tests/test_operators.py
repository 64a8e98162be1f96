"""Edge rows for operators, gold builders, sources and sinks (FIXTURES.md section 2)."""

import json

from pyspark.sql import functions as F

from civiclake import schemas
from civiclake.functions.keys import KEY
from civiclake.operators import core
from civiclake.plans import gold, marts
from civiclake.session import scratch_dir
from civiclake.sinks import tables as sinks
from civiclake.sources import payloads, snapshots


def test_stratified_sample(spark):
    rows = [(f"{i:07d}", f"m{i}", f"U{i % 30}") for i in range(400)] + [("9999999", "x", None)]
    dim = spark.createDataFrame(rows, f"{KEY} string, nome string, sigla_uf string")
    s100 = core.stratified_sample(dim, n=100).collect()
    assert len(s100) == 90 and all(r.sigla_uf is not None for r in s100)   # 3 per state x 30
    s10 = core.stratified_sample(dim, n=10).collect()
    assert len(s10) == 10 and len({r.sigla_uf for r in s10}) == 10         # 1 per state, 10 in all
    small = core.stratified_sample(dim.limit(50), n=100).count()
    assert small == 50                                                     # rows <= n: unchanged


def test_top_n_drops_null_label_after_limit(spark):
    df = spark.createDataFrame([("a", 5.0, "1"), (None, 4.0, "2"), ("c", 3.0, "3"), ("d", 2.0, "4"),
                                ("e", None, "5")], f"nome string, v double, {KEY} string")
    got = core.top_n(df, "v", "nome", n=3).collect()
    assert [(r.nome, r.v) for r in got] == [("a", 5.0), ("c", 3.0)]


def test_dashboard_filter(spark):
    df = spark.createDataFrame([("A", 2020), ("B", 2021)], "sigla_uf string, ano int")
    assert core.dashboard_filter(df).count() == 2
    assert core.dashboard_filter(df, "A", "2020").count() == 1
    assert core.dashboard_filter(df.drop("sigla_uf"), "A").count() == 2


def test_lagged_years():
    assert core.lagged_years(2024) == [2022, 2021, 2023]
    assert core.lagged_years(2020) == [2020]
    assert core.backoff_years(2024) == [2024, 2023]


def test_first_non_empty_and_preferred_year(spark):
    e = spark.createDataFrame([], "a int")
    b = spark.createDataFrame([(1,), (2,)], "a int")
    c = spark.createDataFrame([(3,)], "a int")
    assert sorted(r.a for r in core.first_non_empty([e, b, c]).collect()) == [1, 2]
    df = spark.createDataFrame([(2021, 1), (2023, 2)], "ano int, v int")
    got = core.preferred_year(df, core.lagged_years(2024)).collect()
    assert [(r.ano, r.ano_efetivo) for r in got] == [(2021, 2021)]


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 5, "z")], "k string, o int, v string")
    got = {r.k: r.v for r in core.first_per_key(df, "k", ["o"]).collect()}
    assert got == {"k": "a", "j": "z"}


def test_exact_median(spark):
    import statistics
    vals = [float(x) for x in [5, 1, 9, 3, 3, 7, 8, 2]]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    assert core.exact_median(df, "x").first()[0] == statistics.median(vals)
    # force the narrowing rounds with a tiny distinct budget
    big = spark.range(0, 20001).select((F.col("id") * 3 % 10007).cast("double").alias("x"))
    expect = statistics.median([float(i * 3 % 10007) for i in range(20001)])
    assert core.exact_median(big, "x").first()[0] == expect
    assert core.exact_median(df.where("x is null"), "x").first()[0] is None


def test_health_edges(spark):
    pop = spark.createDataFrame([("0000001", 2024, 10), ("0000001", 2024, 12), ("0000002", 2024, 0),
                                 ("0000003", 2024, None)], f"{KEY} string, ano int, populacao long")
    deaths = spark.createDataFrame([("0000001", 2024), ("0000001", 2024), ("0000009", 2024)],
                                   f"{KEY} string, ano int")
    g = {r[KEY]: r for r in gold.health_indicators(pop, deaths=deaths, ano=2024, stamp=False).collect()}
    assert g["0000001"].populacao == 12 and g["0000001"].total_obitos == 2
    assert g["0000001"].taxa_obitos_100k == 16666.67
    assert g["0000002"].taxa_obitos_100k is None            # zero population (D5)
    assert g["0000003"].populacao is None and g["0000003"].total_obitos == 0
    assert "0000009" not in g                               # only keys with population
    assert g["0000001"].total_internacoes == 0 and g["0000001"].taxa_internacao_100k == 0.0
    nod = gold.health_indicators(pop, ano=2024, stamp=False).first()
    assert nod.total_obitos == 0 and nod.taxa_obitos_100k == 0.0


def test_education_edges(spark):
    edu = spark.createDataFrame([("0000001", 2024, 10), ("0000002", 2024, 5)], f"{KEY} string, ano int, matriculas long")
    pop = spark.createDataFrame([("0000001", 2024, 0)], f"{KEY} string, ano int, populacao long")
    g = {r[KEY]: r for r in gold.education_indicators(edu, pop, stamp=False).collect()}
    assert g["0000001"].taxa_matriculas_por_1000_hab is None   # population 0
    assert g["0000002"].taxa_matriculas_por_1000_hab is None   # population missing
    assert g["0000001"].docentes is None                       # teachers absent


def test_transfers_all_malformed_sum_to_zero(spark):
    recs = spark.createDataFrame([("123456", 2024, "n/d"), ("123456", 2024, "x"), (None, 2024, "5")],
                                 "codigoMunicipio string, anoReferencia int, valor string")
    t = payloads.transfer_rows(recs, ano=2024)
    got = gold.transfer_totals(t, stamp=False).collect()
    assert [(r[KEY], r.total_transferencias_reais) for r in got] == [("0123456", 0.0)]


def test_facilities(spark):
    types = ["05", "Hospital Geral", "5", "UBS Centro", "Unidade Básica", "01"]
    recs = spark.createDataFrame([("1234567", t, "2", "x") for t in types],
                                 "co_municipio string, co_tipo_estabelecimento string, qt_leito string, qt_leito_sus string")
    r = gold.facility_counts(payloads.facility_rows(recs, 2024), stamp=False).first()
    assert (r.total_estabelecimentos, r.hospitais, r.ubs, r.leitos_totais, r.leitos_sus) == (6, 2, 2, 12, 0)


def test_gdp_max_skips_nulls(spark):
    df = spark.createDataFrame([("0000001", 2020, 10.0, None), ("0000001", 2020, 12.0, 3.0)],
                               f"{KEY} string, ano int, pib_total_mil_reais double, pib_per_capita double")
    r = gold.gdp_indicators(df, stamp=False).first()
    assert (r.pib_total_mil_reais, r.pib_per_capita) == (12.0, 3.0)


def test_municipality_flatten(spark):
    objs = [{"id": 3550308, "nome": "Sao Paulo", "microrregiao": {"mesorregiao": {"UF": {"id": 35, "sigla": "SP"}}}},
            {"id": 1100015, "nome": "X"},
            {"id": 1100023, "nome": "Y", "microrregiao": "texto"},
            {"id": 0, "nome": "Z"}, {"id": 1200013, "nome": ""}, {"id": 12, "nome": "curto"}]
    df = spark.createDataFrame([(json.dumps(o),) for o in objs], "p string").select(
        F.from_json("p", schemas.MUNICIPALITY_JSON).alias("m")).select("m.*")
    got = {r[KEY]: (r.sigla_uf, r.cod_uf) for r in payloads.municipality_rows(df).collect()}
    assert got == {"3550308": ("SP", 35), "1100015": ("", None), "1100023": ("", None), "0000012": ("", None)}


def test_gdp_series_pivot(spark):
    def item(var, series):
        return {"id": var, "resultados": [{"series": series}]}

    def ser(loc, val):
        return {"localidade": {"id": loc} if loc is not None else {}, "serie": {"2021": val}}

    payload = [item("37", [ser("1100015", "1.234,5"), ser("12345678", "9"), ser(None, "7")]),
               item("498", [ser("1100023", "10")]),
               item("37", [ser("1100015", "2.000"), ser("1100031", "...")])]
    df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
    got = {r[KEY]: (r.pib_total_mil_reais, r.pib_per_capita)
           for r in payloads.gdp_rows(payloads.series_from_text(df), 2021).collect()}
    assert got == {"1100015": (2000.0, None), "1100023": (None, 10.0), "0000000": (7.0, None)}


def test_map_radius(spark):
    m = spark.createDataFrame([("0000001", "a", "U", 2020, 100), ("0000002", "b", "U", 2020, 0),
                               ("0000003", "c", "U", 2020, None)],
                              f"{KEY} string, nome_municipio string, sigla_uf string, ano int, populacao long")
    c = spark.createDataFrame([(k, -10.0, -40.0) for k in ("0000001", "0000002", "0000003")],
                              f"{KEY} string, latitude double, longitude double")
    got = {r[KEY]: r.raio for r in marts.map_points(m, c, "saude", "populacao").collect()}
    assert got == {"0000001": 22.0, "0000002": 5.0, "0000003": 5.0}
    zero = m.withColumn("populacao", F.lit(0).cast("long"))
    assert {r.raio for r in marts.map_points(zero, c, "saude", "populacao").collect()} == {5.0}


def test_replace_by_year_and_upsert(spark):
    root = scratch_dir(spark, "t-k5")
    sch = f"{KEY} string, ano int, pib_total_mil_reais double, pib_per_capita double"
    a = spark.createDataFrame([("0000001", 2020, 1.0, 1.0), ("0000001", 2021, 2.0, 2.0)], sch)
    b = spark.createDataFrame([("0000001", 2021, 5.0, 5.0)], sch)
    sinks.publish_by_year(a, root, "gold_pib_municipio")
    sinks.publish_by_year(b, root, "gold_pib_municipio")
    sinks.publish_by_year(b, root, "gold_pib_municipio")
    got = sorted((r.ano, r.pib_total_mil_reais) for r in spark.read.parquet(root).collect())
    assert got == [(2020, 1.0), (2021, 5.0)]
    t = scratch_dir(spark, "t-k3")
    d1 = spark.createDataFrame([("0000001", "a", "U", 0)], f"{KEY} string, nome_municipio string, sigla_uf string, s int")
    d2 = spark.createDataFrame([("0000001", "b", "U", 1), ("0000001", "c", "U", 2), ("0000002", "z", "V", 1)],
                               f"{KEY} string, nome_municipio string, sigla_uf string, s int")
    sinks.dimension_upsert(spark, t, d1, "s")
    sinks.dimension_upsert(spark, t, d2, "s")
    cur = {r[KEY]: (r.nome_municipio, r.cod_uf) for r in sinks.read_dimension(spark, t).collect()}
    assert cur == {"0000001": ("c", None), "0000002": ("z", None)}


def test_latest_snapshot_missing(spark):
    assert snapshots.latest_snapshot(spark, scratch_dir(spark, "none") + "/nothing_*") is None


def test_municipality_state_null_vs_absent(spark):
    objs = ['{"id": 1100015, "nome": "A", "microrregiao": {"mesorregiao": {"UF": {"id": 11, "sigla": null}}}}',
            '{"id": 1100023, "nome": "B", "microrregiao": {"mesorregiao": {"UF": {"id": 11}}}}',
            '{"id": 1100031, "nome": "C", "microrregiao": "texto"}',
            '{"id": 1100049, "nome": "D", "microrregiao": {"mesorregiao": {"UF": {"id": 11, "sigla": "RO"}}}}']
    df = spark.createDataFrame([(o,) for o in objs], "payload string")
    got = {r[KEY]: (r.sigla_uf, r.cod_uf) for r in payloads.municipality_rows_from_text(df).collect()}
    assert got == {"1100015": (None, 11), "1100023": ("", 11), "1100031": ("", None), "1100049": ("RO", 11)}
