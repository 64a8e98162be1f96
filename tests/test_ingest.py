"""Record-file scans report what they skip; streaming bronze ingestion is
exactly-once across runs."""

from pyspark.sql import functions as F

from civiclake.plans import analogs as A
from civiclake.plans.io_queries import land_event_files
from civiclake.session import scratch_dir
from civiclake.sources import files, inventory
from civiclake.streaming import ingest_landed, read_bronze

SF = "/root/testdata/sf0.001"


def test_event_scan_reports_skipped_files(spark):
    root = land_event_files(spark, SF)
    report = files.ScanReport()
    counts = files.death_counts(spark, root, report=report)
    reasons = {f.rsplit("/", 2)[-2]: why for f, why in report.skipped}
    assert reasons["uf_z"].startswith("unreadable")          # the corrupt file
    assert reasons["uf_d"] == "no key column"                # 'CODMUN' is not a candidate
    assert {f.rsplit("/", 2)[-2] for f in report.used} == {"uf_a", "uf_b", "uf_c"}
    assert counts.where(F.col("ano") >= 2000).count() == 0


def test_streaming_ingest_is_exactly_once(spark):
    root = scratch_dir(spark, "stream-test")
    o = A.table(spark, SF, "orders").select(F.col("o_orderkey"), F.year("o_orderdate").alias("ano"))
    o.where("ano <= 1997").write.parquet(f"{root}/landing/w1")
    args = (spark, f"{root}/landing/*", o.schema, f"{root}/bronze", f"{root}/_ckpt")
    ingest_landed(*args)
    n1 = read_bronze(spark, f"{root}/bronze").count()
    ingest_landed(*args)                                     # nothing new: nothing added
    assert read_bronze(spark, f"{root}/bronze").count() == n1
    o.where("ano > 1997").write.parquet(f"{root}/landing/w2")
    ingest_landed(*args)
    b = read_bronze(spark, f"{root}/bronze")
    assert b.count() == o.count()
    assert b.select("o_orderkey").distinct().count() == o.count()
    assert "_arquivo" in b.columns and "data_carga" in b.columns


def test_microdata_header_probe(spark, tmp_path):
    """BOM and quoted headers; ';' and ',' files; only '*matricula*' files count."""
    d = tmp_path / "censo"
    (d / "dados").mkdir(parents=True)
    (d / "dados" / "MATRICULA_A.csv").write_text('﻿"ID_ALUNO";"CO_MUNICIPIO"\n1;3550308\n2;3550308\n3;355030\n',
                                                 encoding="utf-8")
    (d / "dados" / "matricula_b.csv").write_text("ID_ALUNO,CO_MUNICIPIO\n4,3304557.0\n5,12\n", encoding="utf-8")
    (d / "dados" / "docentes.csv").write_text("ID;CO_MUNICIPIO\n9;3550308\n", encoding="utf-8")
    found = inventory.headers(inventory.landed_files(spark, str(d), ".csv", "matricula"))
    keys = {r.path.rsplit("/", 1)[-1]: (r.l.sep, r.l.at) for r in found.select("path", files.header_layout(F.col("header"), "UTF-8").alias("l")).collect()}
    assert keys == {"MATRICULA_A.csv": (";", 1), "matricula_b.csv": (",", 1)}
    report = files.ScanReport()
    got = {r.cod_mun_ibge_7: r.matriculas for r in files.microdata_counts(spark, str(d), 2024, report=report).collect()}
    assert got == {"3550308": 2, "0355030": 1, "3304557": 1}
    assert len(report.used) == 2


def jobs_of(spark, build):
    """How many Spark jobs ``build`` starts, and its result."""
    import uuid
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "count")
    try:
        out = build()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), out


def land_years(spark, root, states, years):
    rows = [(f"35{i:05d}", u, y) for y in years for u in states for i in range(y % 7 + 1)]
    spark.createDataFrame(rows, "CODMUNRES string, uf string, ano int").write.partitionBy("uf", "ano").parquet(root)
    return rows


def test_folder_years_and_states_are_read_and_pruned(spark, tmp_path):
    root = str(tmp_path / "sim")
    rows = land_years(spark, root, ["SP", "RJ"], [2020, 2021])
    spark.createDataFrame([(3500001, 1999)], "codmunres long, ano int").write.parquet(f"{root}/uf=SP/ano=2020/extra")
    spark.createDataFrame([("3500001", 2021)], "CODMUNRES string, ano int").write.parquet(f"{root}/plain")
    rows += [("3500001", "SP", 2020), ("3500001", None, 2021)]

    def want(keep):
        out = {}
        for k, u, y in rows:
            if keep(u, y):
                out[k, y] = out.get((k, y), 0) + 1
        return out

    def got(**args):
        return {(r.cod_mun_ibge_7, r.ano): r.total_obitos for r in files.death_counts(spark, root, **args).collect()}

    assert got() == want(lambda u, y: True)
    assert got(ano=2020) == want(lambda u, y: y == 2020)
    assert got(states=["RJ"]) == want(lambda u, y: u == "RJ")
    report = files.ScanReport()
    assert got(ano=2021, states=["SP"], report=report) == want(lambda u, y: u == "SP" and y == 2021)
    assert report.used and all("/uf=SP/ano=2021/" in f for f in report.used)    # the rest was not opened
    assert got(states=["AC"]) == {} and got(ano=1990) == {}


def test_number_of_jobs_does_not_follow_the_number_of_files(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    land_years(spark, few, ["SP"], [2020, 2021])
    land_years(spark, many, ["SP", "RJ", "MG", "BA"], range(2010, 2020))
    n_few, _ = jobs_of(spark, lambda: files.death_counts(spark, few).collect())
    n_many, _ = jobs_of(spark, lambda: files.death_counts(spark, many).collect())
    assert n_many <= n_few + 1        # over 32 files Spark lists them in a job of its own
    csv = tmp_path / "censo"
    csv.mkdir()
    for i in range(40):
        (csv / f"matricula_{i}.csv").write_text("ID;CO_MUNICIPIO\n1;3550308\n")
    n_csv, out = jobs_of(spark, lambda: files.microdata_counts(spark, str(csv), 2020))
    assert n_csv <= 4 and out.first().matriculas == 40


def test_sheets_are_profiled_in_one_job(spark, tmp_path):
    shapes = {"a": [("3550308", "x", 5)], "b": [("n/d", "3304557", 7), ("y", "3304557", 1)], "c": [("n/d", "z", 9)]}
    paths = []
    for name, rows in shapes.items():
        spark.createDataFrame(rows, "`cod municipio` string, `municipio id.` string, `matr total` int").write.parquet(str(tmp_path / name))
        paths.append(str(tmp_path / name))
    n, sheets = jobs_of(spark, lambda: files.read_sheets(spark, [*paths, str(tmp_path / "a")]))
    assert n <= 2 and len(sheets) == 4
    n, out = jobs_of(spark, lambda: files.synopsis_sums(sheets, 2020, min_rows=1))
    assert n <= 2
    assert {(r.cod_mun_ibge_7, r.matriculas) for r in out.collect()} == {("3550308", 10.0), ("3304557", 8.0)}
