"""Analog inputs derived by Spark from the driver's test tables.

The reference reads Brazilian public sources; the test tables are a TPC-H
style star schema. Each function below re-labels a table as one of those
sources (entity dimension, population, event records, school census, GDP,
transfers, facilities, series payloads, raw codes, centroids). Everything is
derived from whole tables, so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.keys import KEY, zfill7

YEARS = (1995, 2001)     # year span of the order and ship dates
REF_YEAR = 1998          # the "requested year" of single-year queries


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a DataFrame; the scan (file listing, footer schema) is
    set up once per session and path - the tables are read-only inputs."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def in_year(c: str, ano: int | None):
    """A pushable date-range predicate for ``year(c) == ano`` (Parquet cannot
    push a function of the column; a range on the column itself it can)."""
    if ano is None:
        return F.lit(True)
    return (F.col(c) >= F.lit(f"{ano}-01-01").cast("timestamp_ntz")) & \
        (F.col(c) < F.lit(f"{ano + 1}-01-01").cast("timestamp_ntz"))


def v_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality dimension: customer with its nation as state.

    ``nation`` is the fixed 25-row TPC-H table, so broadcasting it is bounded.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
            .select(zfill7("c_custkey").alias(KEY), F.col("c_name").alias("nome_municipio"),
                    F.col("n_name").alias("sigla_uf"), F.col("c_nationkey").alias("cod_uf")))


def v_pop(spark: SparkSession, sf_dir: str, ano: int | None = None) -> DataFrame:
    """Population per entity and year: 0 for key % 50 = 0, null for % 50 = 1
    (only the requested year's rows are generated when one is given)."""
    # The table lies in few row groups: its keys are spread before the years multiply them,
    # so that no task aggregates all entity-years (a given number, which AQE leaves as it is).
    c = table(spark, sf_dir, "customer").select("c_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    lo, hi = (ano, ano) if ano is not None else YEARS
    y = F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("ano")
    k = F.col("c_custkey")
    pop = (F.when(k % 50 == 0, F.lit(0).cast("long"))
           .when(k % 50 == 1, F.lit(None).cast("long"))
           .otherwise(F.lit(1000) + (k * 37) % 9000 + F.col("ano")).cast("long"))
    return c.select(k, y).select(zfill7("c_custkey").alias(KEY), "ano", pop.alias("populacao"))


def event_records(spark: SparkSession, sf_dir: str, status: str, ano: int | None = None) -> DataFrame:
    """Event records (deaths F, births O, admissions P): one order = one event."""
    o = table(spark, sf_dir, "orders").where(in_year("o_orderdate", ano))
    return (o.where(F.col("o_orderstatus") == status)
            .select(zfill7("o_custkey").alias(KEY), F.year("o_orderdate").alias("ano")))


EVENT_STATUS = {"F": "obitos", "P": "internacoes", "O": "nascidos"}


def tagged_events(spark: SparkSession, sf_dir: str, ano: int | None = None) -> DataFrame:
    """All event records in one scan, tagged with their kind (``_kind``, ``_n``)."""
    o = table(spark, sf_dir, "orders").where(in_year("o_orderdate", ano))
    kind = F.create_map(*[x for s, k in EVENT_STATUS.items() for x in (F.lit(s), F.lit(k))])[F.col("o_orderstatus")]
    return (o.select(zfill7("o_custkey").alias(KEY), F.year("o_orderdate").alias("ano"),
                     kind.alias("_kind"), F.lit(1).cast("long").alias("_n"))
            .where(F.col("_kind").isNotNull()))


def deaths(spark, sf_dir, ano=None):
    return event_records(spark, sf_dir, "F", ano)


def births(spark, sf_dir, ano=None):
    return event_records(spark, sf_dir, "O", ano)


def admissions(spark, sf_dir, ano=None):
    return event_records(spark, sf_dir, "P", ano)


def education(spark: SparkSession, sf_dir: str, ano: int | None = None) -> DataFrame:
    """School census rows: lineitem by supplier and ship year."""
    li = table(spark, sf_dir, "lineitem").where(in_year("l_shipdate", ano))
    return li.select(
        zfill7("l_suppkey").alias(KEY), F.year("l_shipdate").alias("ano"),
        F.col("l_quantity").cast("long").alias("matriculas"),
        F.col("l_linenumber").cast("long").alias("docentes"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.lit(1)).cast("long").alias("escolas"))


def gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GDP rows: orders by customer and year."""
    o = table(spark, sf_dir, "orders")
    return o.select(zfill7("o_custkey").alias(KEY), F.year("o_orderdate").alias("ano"),
                    F.col("o_totalprice").alias("pib_total_mil_reais"),
                    (F.col("o_totalprice") / 100).alias("pib_per_capita"))


def transfer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfer API records: lineitem by supplier; ``valor`` is text and
    malformed ('n/d') on line 7."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("codigoMunicipio"),
        F.concat(F.lit("Supplier#"), F.col("l_suppkey").cast("string")).alias("nomeMunicipio"),
        F.col("l_returnflag").alias("siglaUf"),
        F.year("l_shipdate").alias("anoReferencia"),
        F.month("l_shipdate").alias("mesReferencia"),
        F.col("l_linestatus").alias("nomeTipoTransferencia"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/d"))
        .otherwise(F.col("l_extendedprice").cast("string")).alias("valor"))


def facility_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility API records: one part = one facility of the municipality named
    by the brand number; type = part type, beds = size, public beds = half
    the size (malformed 'n/d' when the size is a multiple of 3)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        zfill7(F.regexp_replace("p_brand", "[^0-9]", "")).alias("co_municipio"),
        F.when(F.col("p_size") % 10 == 0, F.lit("N")).otherwise(F.lit("S")).alias("st_ativo"),
        F.col("p_type").alias("co_tipo_estabelecimento"),
        F.col("p_size").cast("string").alias("qt_leito"),
        F.when(F.col("p_size") % 3 == 0, F.lit("n/d"))
        .otherwise((F.col("p_size") / 2).cast("string")).alias("qt_leito_sus"))


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in five spellings chosen by key % 5: the first 6 digits of the
    7-digit key, the 7-digit key, ' 35-ddddd ' with a dash, 5 digits, null."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    seven = zfill7(k)
    spelled = (F.when(k % 5 == 0, F.substring(seven, 1, 6))
               .when(k % 5 == 1, seven)
               .when(k % 5 == 2, F.concat(F.lit(" 35-"), F.lpad((k % 100000).cast("string"), 5, "0"), F.lit(" ")))
               .when(k % 5 == 3, F.lpad((k % 100000).cast("string"), 5, "0")))
    return c.select("c_custkey", "c_name", spelled.alias("codigo_ibge"))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid CSV rows: latitude/longitude from the nation key; null for key % 11
    = 0; a duplicated row (shifted coordinates) for key % 13 = 0."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    base = c.select(
        k.cast("string").alias("codigo_ibge"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_nationkey") - 30.0).alias("latitude"),
        (F.lit(-40.0) - F.col("c_nationkey")).alias("longitude"),
        F.lit(0).alias("_dup"))
    dup = c.where(k % 13 == 0).select(
        k.cast("string").alias("codigo_ibge"),
        (F.col("c_nationkey") - 31.0).alias("latitude"),
        (F.lit(-41.0) - F.col("c_nationkey")).alias("longitude"),
        F.lit(1).alias("_dup"))
    return base.unionByName(dup)
