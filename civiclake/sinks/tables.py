"""Table writes: bronze snapshots, upserts, appends, replace-by-year, exports
and table creation.

Layouts (all under a lake root on the shared file system):
  bronze/<name>/<yyyyMMdd_HHmmss>-<id>/   immutable snapshot (Parquet + CSV)
  dim_municipio/prefixo_uf=<2 digits>/     dimension, upserted per state prefix
  <table>/ano=<year>/                      year-partitioned table (replace-by-year,
                                           and upserts whose key includes the year)

The catalog's tables (K11) have the same layout and locations: whatever the batch
writes is registered there and served by ``spark.table``.
"""

from __future__ import annotations

import datetime as _dt
import functools
import logging
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake import schemas
from civiclake.functions.keys import KEY
from civiclake.operators.core import add_missing
from civiclake.sources.snapshots import table_or_empty

log = logging.getLogger("civiclake.sinks")


def _stamp() -> str:
    return _dt.datetime.now().strftime("%Y%m%d_%H%M%S")


def clean_name(name: str) -> str:
    """K1: lower case, spaces to underscores."""
    return name.replace(" ", "_").lower()


# ---- K1/K2/K8: snapshots -------------------------------------------------------------
def write_snapshot(df: DataFrame, root: str, name: str, csv: bool = True) -> str:
    """K1/K2/K8: an immutable, timestamped snapshot as Parquet and ``;`` CSV with
    a header. The plan runs once: the CSV copy is made from the written Parquet
    files (no executor cache to lose). (Spark writes no byte-order mark;
    readers accept files with or without one.)"""
    path = f"{root.rstrip('/')}/{clean_name(name)}/{_stamp()}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(f"{path}/parquet")
    if csv:
        (df.sparkSession.read.parquet(f"{path}/parquet").write.mode("errorifexists")
         .option("sep", ";").option("header", True).csv(f"{path}/csv"))
    return path


def read_snapshot_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The CSV half of a snapshot, as ``write_snapshot`` wrote it: nothing between two
    separators is null, a quoted nothing the empty text (with Spark's default null
    value both would be null)."""
    return (spark.read.schema(schema).option("sep", ";").option("header", True).option("nullValue", "\u0000").option("emptyValue", "")
            .csv(f"{path.rstrip('/')}/csv"))


# ---- K3/K6: upserts by partition ------------------------------------------------------
def last_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row per key by ``order`` (``max_by`` of the row: skew-safe)."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


DIM_PARTITION = schemas.DIM_PARTITION   # the first two digits of the code: the state's code


def dimension_upsert(spark: SparkSession, table_path: str, new: DataFrame, order: str) -> None:
    """K3: municipality dimension upsert (last row per key in the batch wins;
    an absent state code is added as null). The table is partitioned by the
    code's two-digit state prefix, so a batch rewrites only its states."""
    cols = [KEY, "nome_municipio", "sigla_uf", "cod_uf"]
    new = add_missing(new, {"cod_uf": T.IntegerType()})
    batch = last_per_key(new.select(*cols, order), [KEY], order).drop(order)
    batch = batch.select(F.col(KEY), F.col("nome_municipio"), F.col("sigla_uf"),
                         F.col("cod_uf").cast("int"), F.substring(KEY, 1, 2).alias(DIM_PARTITION))
    upsert_partitioned(spark, table_path, batch, [KEY], DIM_PARTITION)


def read_dimension(spark: SparkSession, table_path: str) -> DataFrame:
    """The municipality dimension as written by ``dimension_upsert``."""
    sch = schemas.TABLES["dim_municipio"]
    full = T.StructType(sch.fields + [T.StructField(DIM_PARTITION, T.StringType())])
    return spark.read.schema(full).parquet(table_path).drop(DIM_PARTITION)


def upsert_partitioned(spark: SparkSession, table_path: str, new: DataFrame, keys: Sequence[str],
                       part_col: str, order: str | None = None) -> int:
    """INSERT OR REPLACE by ``keys`` on a table partitioned by ``part_col`` (a
    function of the key), rewriting only the partitions present in the batch.

    The batch is staged once. Rows with a null key or partition value have no row
    to replace: they are rejected, logged and counted in the result. The batch's
    partition values (state prefixes, years; the writer tracks every partition
    it replaces on the driver anyway) prune the current table statically. The
    current rows of those partitions are merged with the batch, staged as a table
    in the checkpoint folder (Spark will not overwrite a path it is reading), then
    swapped in by dynamic partition overwrite; staged tables are deleted. Only a
    missing folder means a new table: any other listing error stops the upsert.
    """
    from civiclake.session import remove, scratch_dir
    path = scratch_dir(spark, "stage-batch")
    (last_per_key(new, keys, order).drop(order) if order else new).write.parquet(path)
    staged = spark.read.parquet(path)
    whole = functools.reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in {*keys, part_col}])
    rejected = staged.where(~whole).count()
    if rejected:
        log.warning("%s: %d rows without a key rejected", table_path, rejected)
    batch = staged.where(whole)
    merged, merge_path = batch, None
    folder = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        values = [r[0] for r in batch.select(part_col).distinct().collect()]
        cur = spark.read.schema(batch.schema).parquet(table_path).where(F.col(part_col).isin(values))
        merge_path = scratch_dir(spark, "stage-upsert")
        cur.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch).write.parquet(merge_path)
        merged = spark.read.parquet(merge_path)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(table_path))
    for p in filter(None, (path, merge_path)):
        remove(spark, p)
    return rejected


def upsert_by_year(spark: SparkSession, table_path: str, new: DataFrame, keys: Sequence[str],
                   table: str, order: str | None = None) -> None:
    """K6 at scale: upsert on keys that include ``ano``; only the batch's year
    partitions are rewritten (columns coerced to the table schema)."""
    sch = schemas.TABLES[table]
    batch = last_per_key(new, keys, order).drop(order) if order else new
    batch = add_missing(batch, {f.name: f.dataType for f in sch.fields})
    batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in sch.fields])
    upsert_partitioned(spark, table_path, batch, keys, "ano")


def education_silver_upsert(spark: SparkSession, table_path: str, edu: DataFrame,
                            order: str | None = None) -> None:
    """K6: education silver upsert on (key, year), stamped with the load time;
    only the batch's year partitions are rewritten."""
    cols = [KEY, "ano", "matriculas", "docentes", "escolas"]
    e = add_missing(edu, {"docentes": T.LongType(), "escolas": T.LongType()})
    e = e.select(*cols, *([order] if order else [])).withColumn("data_carga", F.current_timestamp())
    upsert_by_year(spark, table_path, e, [KEY, "ano"], "silver_inep_educacao", order)


# ---- K4/K7: appends ----------------------------------------------------------------------
def append(df: DataFrame, table_path: str, stamp: bool = True) -> None:
    """K4: append rows with the load timestamp."""
    out = df.withColumn("data_carga", F.current_timestamp()) if stamp else df
    out.write.mode("append").parquet(table_path)


def append_indicators(df: DataFrame, table_path: str) -> None:
    """K7: tall indicator append: optional columns added as null, the default
    indicator is ``raw``."""
    sch = schemas.TABLES["silver_datasus_indicadores"]
    d = add_missing(df, {f.name: f.dataType for f in sch.fields if f.name != "data_carga"})
    d = d.withColumn("indicador", F.coalesce(F.col("indicador"), F.lit("raw")))
    append(d.select(*[F.col(f.name).cast(f.dataType) for f in sch.fields if f.name != "data_carga"]),
           table_path)


# ---- K5: replace by year -----------------------------------------------------------------
def conformed(df: DataFrame, table: str) -> DataFrame:
    """The columns and types of a lake table, stamped with the load time."""
    sch = schemas.TABLES[table]
    d = df if "data_carga" in df.columns else df.withColumn("data_carga", F.current_timestamp())
    d = add_missing(d, {f.name: f.dataType for f in sch.fields})
    return d.select(*[F.col(f.name).cast(f.dataType) for f in sch.fields])


def publish_by_year(df: DataFrame, table_path: str, table: str) -> None:
    """K5: replace the years present in the batch, keep the others.

    Dynamic partition overwrite on ``ano``: only partitions of the batch's
    years are rewritten, in one job. Columns are coerced to the table schema;
    rows with a null year are not published (they have no partition to replace);
    ``publish_audited`` counts them.
    """
    d = conformed(df, table).where(F.col("ano").isNotNull())
    (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ano").parquet(table_path))


AUDIT = ["lidas", "sem_chave", "sem_ano", "duplicadas", "publicadas"]


def publish_audited(df: DataFrame, table_path: str, table: str, dim: DataFrame | None = None,
                    accept: Callable[[dict[str, int]], bool] | None = None) -> dict[str, int]:
    """K5 with Q1/Q2 taken while publishing: one row per (key, year) is published,
    and the job that writes it counts rows read, without a key, without a year
    (neither can be published), repeated, and published.

    The metrics are observed in the staging write, so the source is computed once.
    ``dim`` adds ``orfas``, the published keys that it lacks, from the staged table.
    ``accept`` sees the counts before the staged years replace the table's; False
    leaves the table as it was. Of repeated rows the greatest stays, column by column
    in schema order (a measure before the load stamp).
    """
    from civiclake.session import remove, scratch_dir
    d = conformed(df, table)
    keys = [KEY, "ano"]
    rest = [c for c in d.columns if c not in keys]
    one = d.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    whole = F.col(KEY).isNotNull() & F.col("ano").isNotNull()
    n = F.col("_n")
    audit = Observation(f"audit-{table}-{uuid.uuid4().hex[:8]}")
    counted = one.observe(
        audit, F.sum(n).alias("lidas"), F.sum(F.when(F.col(KEY).isNull(), n)).alias("sem_chave"),
        F.sum(F.when(F.col(KEY).isNotNull() & F.col("ano").isNull(), n)).alias("sem_ano"),
        F.sum(F.when(whole, n - 1)).alias("duplicadas"), F.count_if(whole).alias("publicadas"))
    stage = scratch_dir(df.sparkSession, "stage-audited")
    counted.where(whole).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).write.partitionBy("ano").parquet(stage)
    found = audit.get
    counts = {k: int(found.get(k) or 0) for k in AUDIT}
    staged = read_table(df.sparkSession, stage, table)
    if dim is not None:
        counts["orfas"] = staged.select(KEY).distinct().join(dim.select(KEY), KEY, "left_anti").count()
    for reason in ("sem_chave", "sem_ano", "duplicadas"):
        if counts[reason]:
            log.warning("%s: %d rows %s", table, counts[reason], reason)
    if accept is None or accept(counts):
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ano").parquet(table_path))
    else:
        log.warning("%s: not published: %s", table, counts)
    remove(df.sparkSession, stage)
    return counts


def read_table(spark: SparkSession, table_path: str, table: str) -> DataFrame:
    """A year-partitioned lake table read with its declared schema (an empty
    table reads as an empty frame instead of failing schema inference)."""
    return spark.read.schema(schemas.TABLES[table]).parquet(table_path)


# ---- K9/K10: exports -----------------------------------------------------------------------
def export_csv(df: DataFrame, path: str, sep: str = ";", single_file: bool = False) -> str:
    """CSV export with a header; one file only on request (that funnels
    the whole export through one task, so use it for small extracts)."""
    out = df.repartition(1) if single_file else df
    out.write.mode("errorifexists").option("sep", sep).option("header", True).csv(path)
    return path


# ---- K11: table creation -------------------------------------------------------------------
def _ddl_type(t: T.DataType) -> str:
    return t.simpleString().upper()


def create_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """Create the dimension, silver and gold tables (if absent) as Parquet
    tables under ``location``, in the layout in which the batch writes them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    created = []
    for name, sch in schemas.TABLES.items():
        part = schemas.PARTITIONED_BY[name]
        fields = sch.fields + ([T.StructField(part, T.StringType())] if part and part not in sch.names else [])
        cols = ", ".join(f"{f.name} {_ddl_type(f.dataType)}" for f in fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet"
                  f"{f' PARTITIONED BY ({part})' if part else ''} LOCATION '{location.rstrip('/')}/{name}'")
        created.append(name)
    return created


def register(spark: SparkSession, database: str, table: str) -> None:
    """Make the catalog see what was written below the table's location: its
    partitions (years, state prefixes) and files."""
    if schemas.PARTITIONED_BY[table]:
        spark.catalog.recoverPartitions(f"{database}.{table}")
    spark.catalog.refreshTable(f"{database}.{table}")


def published(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A table of the catalog with its declared columns, empty if absent."""
    sch = schemas.TABLES[table]
    return table_or_empty(spark, f"{database}.{table}", sch).select(*sch.names)


__all__ = ["append", "append_indicators", "create_tables", "dimension_upsert", "education_silver_upsert",
           "read_dimension", "upsert_partitioned",
           "conformed", "export_csv", "last_per_key", "publish_audited", "publish_by_year", "published", "read_table",
           "register", "upsert_by_year", "write_snapshot"]
