"""Land source payloads derived from the test tables, in the formats the
pipeline scans: JSON lines (municipalities, series, API pages), per-state
Parquet record files, synopsis sheets and ``;`` CSV microdata.

Used by the pipeline query and tests; every file is a Spark write of a whole
table, all years of it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from civiclake import schemas
from civiclake.functions.keys import zfill7
from civiclake.plans import analogs as A
from civiclake.plans.io_queries import municipality_json, series_payloads
from civiclake.plans.batch import Landing
from civiclake.session import materialize


def _only_vars(payload_col: str, ids: list[str]):
    items = F.from_json(payload_col, schemas.SERIES_JSON)
    return F.to_json(F.filter(items, lambda x: x["id"].isin(*ids)))


def land_from_tables(spark: SparkSession, sf: str, root: str) -> Landing:
    """Every year of every table: a run picks its own."""
    root = root.rstrip("/")
    municipality_json(spark, sf).write.text(f"{root}/municipios")
    series = materialize(series_payloads(spark, sf), "landing-series")     # two sources are cut from it
    series.select(_only_vars("payload", ["9324"]).alias("p")).write.text(f"{root}/populacao")
    series.select(_only_vars("payload", ["37", "498"]).alias("p")).write.text(f"{root}/pib")

    o = A.table(spark, sf, "orders")
    y = F.year("o_orderdate").alias("ano")
    k = F.col("o_custkey")
    deaths = o.where(F.col("o_orderstatus") == "F")
    deaths.where(k % 2 == 0).select(zfill7(k).alias("CODMUNRES"), y).write.parquet(f"{root}/obitos/uf_a")
    deaths.where(k % 2 == 1).select(k.alias("codmunres"), y).write.parquet(f"{root}/obitos/uf_b")
    (o.where(F.col("o_orderstatus") == "O").select(zfill7(k).alias("CODMUNNASC"), y)
     .write.parquet(f"{root}/nascidos/uf_a"))
    (o.where(F.col("o_orderstatus") == "P").select(zfill7(k).alias("CO_MUNICIPIO"), "o_orderkey")
     .write.option("sep", ";").option("header", True).csv(f"{root}/microdados/matricula"))

    li = A.table(spark, sf, "lineitem").withColumn("ano", F.year("l_shipdate"))
    (li.select(zfill7("l_suppkey").alias("CO_MUNICIPIO"), F.col("l_quantity").alias("QT_MAT_BAS"),
               F.col("l_linenumber").alias("QT_DOC"), F.lit(1).alias("QT_ESC"), "ano")
     .write.parquet(f"{root}/sinopse/tabela_1"))
    rec = F.struct(F.col("l_suppkey").cast("string").alias("codigoMunicipio"),
                   F.col("ano").alias("anoReferencia"),
                   F.when(F.col("l_linenumber") == 7, F.lit("n/d"))
                   .otherwise(F.col("l_extendedprice").cast("string")).alias("valor"))
    li.select(F.to_json(F.struct(F.array(rec).alias("data"))).alias("p")).write.text(f"{root}/transferencias")

    fac = A.facility_records(spark, sf)
    fac.select(F.to_json(F.struct(F.array(F.struct(*fac.columns)).alias("estabelecimentos"))).alias("p")) \
        .write.text(f"{root}/cnes")
    return Landing(municipios=f"{root}/municipios", populacao=f"{root}/populacao",
                   obitos=f"{root}/obitos", nascidos=f"{root}/nascidos",
                   sinopse=[f"{root}/sinopse/tabela_1"], microdados=f"{root}/microdados",
                   cnes=f"{root}/cnes", pib=f"{root}/pib", transferencias=f"{root}/transferencias")
