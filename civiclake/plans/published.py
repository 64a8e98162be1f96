"""Marts and KPIs served from the tables that a batch published.

The gold tables and the dimension are read from the catalog (``spark.table``), never
rebuilt from raw data: a year filter prunes partitions, and a table that a run did
not publish counts as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civiclake.functions.keys import KEY
from civiclake.plans import marts
from civiclake.sinks import tables as sinks

# The gold table behind each theme.
GOLD_TABLES = {
    "saude": "gold_indicadores_saude_municipio", "educacao": "gold_indicadores_educacao_municipio", "pib": "gold_pib_municipio",
    "transferencias": "gold_transparencia_transferencias", "cnes": "gold_cnes_municipio",
}


def gold_table(spark: SparkSession, database: str, theme: str) -> DataFrame:
    return sinks.published(spark, database, GOLD_TABLES[theme])


def mart(spark: SparkSession, database: str, theme: str, ordered: bool = False) -> DataFrame:
    """J3 over published tables, with the facts' load time."""
    return marts.mart(gold_table(spark, database, theme), sinks.published(spark, database, "dim_municipio"), theme, ordered, stamp=True)


def overview(spark: SparkSession, database: str) -> DataFrame:
    """A19 over published tables."""
    return marts.overview_kpis(mart(spark, database, "saude"), *[gold_table(spark, database, t) for t in ("educacao", "pib", "transferencias", "cnes")])


def overview_by_choice(spark: SparkSession, database: str) -> DataFrame:
    """The overview's figures for every choice of the state and year filters."""
    return marts.filtered_kpis(*[mart(spark, database, t) for t in ("saude", "educacao", "pib", "transferencias", "cnes")])


# ---- a layout by key ---------------------------------------------------------------------
BY_KEY = "por_chave"


def publish_by_key(spark: SparkSession, database: str, location: str, table: str, df: DataFrame, buckets: int) -> str:
    """A table of the catalog bucketed and sorted by the municipality key. Tables with
    the same number of buckets join on the key without moving a row; one file per
    bucket, written after one shuffle. For tables that many marts join."""
    name = f"{database}.{table}_{BY_KEY}"
    (df.repartition(buckets, KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY)
     .option("path", f"{location.rstrip('/')}/{table}_{BY_KEY}").saveAsTable(name))
    return name


def mart_by_key(spark: SparkSession, gold_name: str, dim_name: str, theme: str) -> DataFrame:
    """J3 over bucketed tables: a sort-merge join without an exchange."""
    return marts.mart(spark.table(gold_name).hint("merge"), spark.table(dim_name), theme)
