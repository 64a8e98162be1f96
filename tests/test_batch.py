"""Pipeline: landed files -> bronze -> silver -> gold, run twice: the second run
changes nothing; key uniqueness and orphan checks come back empty."""

from civiclake.functions.keys import KEY
from civiclake.operators import core
from civiclake.plans import batch
from civiclake.plans.landing import land_from_tables
from civiclake.session import scratch_dir

SF = "/root/testdata/sf0.001"


def _snapshot(res):
    return {t: sorted(tuple(r) for r in df.drop("data_carga").collect()) for t, df in res.gold.items()}


def test_batch_idempotent(spark):
    landing = land_from_tables(spark, SF, scratch_dir(spark, "landing"))
    lake = scratch_dir(spark, "lake")
    inc = ("pib", "transferencias", "cnes")
    r1 = batch.run(spark, landing, lake, 1998, sample=100, include=inc)
    s1 = _snapshot(r1)
    assert set(s1) == {"gold_indicadores_saude_municipio", "gold_indicadores_educacao_municipio",
                       "gold_cnes_municipio", "gold_pib_municipio", "gold_transparencia_transferencias"}
    health = r1.gold["gold_indicadores_saude_municipio"]
    assert 0 < health.count() <= 100
    r2 = batch.run(spark, landing, lake, 1998, sample=100, include=inc, check=True)
    assert _snapshot(r2) == s1
    assert set(r2.checks) == set(s1)
    assert all(dup == 0 for dup, _ in r2.checks.values())
    assert r2.checks["gold_indicadores_saude_municipio"][1] == 0
    dim = batch.sinks.read_dimension(spark, f"{lake}/dim_municipio")
    assert core.duplicate_keys(dim, [KEY]).count() == 0
    for t, df in r2.gold.items():
        assert core.duplicate_keys(df).count() == 0, t
    health2 = r2.gold["gold_indicadores_saude_municipio"]   # r1's frames list overwritten files
    assert core.orphan_keys(health2, dim).count() == 0
    # GDP uses the lagged year preference: 1998 is not after 2021, so only 1998
    assert {r.ano for r in r2.gold["gold_pib_municipio"].select("ano").distinct().collect()} == {1998}


def test_batch_all_municipalities(spark):
    landing = land_from_tables(spark, SF, scratch_dir(spark, "landing"))
    lake = scratch_dir(spark, "lake")
    r = batch.run(spark, landing, lake, 1999, all_municipalities=True)
    # no key restriction: every municipality with a population row gets a health row
    n_pop = spark.read.parquet(f"{lake}/silver_ibge_populacao").where("ano = 1999").count()
    assert n_pop > 100
    assert r.gold["gold_indicadores_saude_municipio"].count() == n_pop


def test_batch_whole_file_payloads(spark, tmp_path):
    """API responses landed as-is: one pretty-printed JSON document per file."""
    import json
    root = tmp_path
    (root / "mun").mkdir()
    (root / "mun" / "municipios.json").write_text(json.dumps([
        {"id": 3550308, "nome": "A", "microrregiao": {"mesorregiao": {"UF": {"id": 35, "sigla": "SP"}}}},
        {"id": 3304557, "nome": "B", "microrregiao": {"mesorregiao": {"UF": {"id": 33, "sigla": "RJ"}}}},
    ], indent=2))
    (root / "pop").mkdir()
    series = [{"id": "9324", "resultados": [{"series": [
        {"localidade": {"id": "3550308"}, "serie": {"2023": "11.451.245", "2024": "11.895.578"}},
        {"localidade": {"id": "3304557"}, "serie": {"2022": "6.211.223"}}]}]}]
    (root / "pop" / "p1.json").write_text(json.dumps(series, indent=2))
    (root / "obitos").mkdir()
    spark.createDataFrame([("3550308", 2024), ("3550308", 2024), ("3304557", 2024)],
                          "CODMUNRES string, ano int").write.parquet(str(root / "obitos" / "sp"))
    landing = batch.Landing(municipios=str(root / "mun"), populacao=str(root / "pop"),
                            obitos=str(root / "obitos"), one_payload_per_file=True)
    r = batch.run(spark, landing, scratch_dir(spark, "lake"), 2024, all_municipalities=True)
    got = {x[KEY]: (x.populacao, x.total_obitos)
           for x in r.gold["gold_indicadores_saude_municipio"].collect()}
    assert got == {"3550308": (11895578, 2), "3304557": (6211223, 1)}
