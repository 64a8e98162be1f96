"""Snapshot selection (S12/T5) and catalog-tolerant table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.operators.core import union_all


def latest_snapshot(spark: SparkSession, pattern: str, fmt: str = "parquet") -> DataFrame | None:
    """Rows of the newest snapshot among the folders matching ``pattern``.

    Chosen from listed metadata: only folders whose job committed (``_SUCCESS``)
    count, the newest by that marker's time (ties broken by folder name). An empty
    newest snapshot is the answer, not an older one; only its files are read. No
    match -> None (the source returns nothing).
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    marks = fs.globStatus(path(pattern.rstrip("/") + "/_SUCCESS")) or []
    found = [(m.getModificationTime(), m.getPath().getParent().toString()) for m in marks]
    return spark.read.format(fmt).load(max(found)[1]) if found else None


STAMPED = r"^(.*?)(?:_([0-9]{4}))?$"     # fixed value: <kind>[_<year>], the folder of a snapshot


def snapshot_inventory(spark: SparkSession, bronze: str) -> DataFrame:
    """(kind, ano, path, committed) of every committed snapshot below ``bronze``: one
    scan of the data files' metadata over all kinds, a folder's newest file being
    its time. Folders whose job did not commit (no ``_SUCCESS``, which file scans do
    not see) are left out by one listing of the markers."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    marks = hadoop(bronze).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop(f"{bronze.rstrip('/')}/*/*/parquet/_SUCCESS")) or []
    done = spark.createDataFrame([(m.getPath().getParent().toString(),) for m in marks], "path string")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(bronze)
             .groupBy(F.regexp_replace("path", "/[^/]+$", "").alias("path")).agg(F.max("modificationTime").alias("committed")))
    name = F.element_at(F.split("path", "/"), -3)
    return files.join(done, "path", "left_semi").select(
        F.regexp_extract(name, STAMPED, 1).alias("kind"), F.regexp_extract(name, STAMPED, 2).try_cast("int").alias("ano"), "path", "committed")


def latest_by_year(spark: SparkSession, bronze: str, kind: str, ano: int | None = None) -> DataFrame | None:
    """S12 by kind and year: the newest committed snapshot of every year of ``kind``,
    or of one year; newest by commit time, then by folder. None without one.

    The newest per (kind, year) is one aggregate over the inventory; its paths (one
    a year) go to the reader. Rows carry the snapshot's year in ``ano_arquivo``."""
    found = snapshot_inventory(spark, bronze).where(F.col("kind") == kind)
    if ano is not None:
        found = found.where(F.col("ano") == F.lit(int(ano)))
    newest = found.groupBy("kind", "ano").agg(F.max_by("path", F.struct("committed", "path")).alias("path")).collect()
    if not newest:
        return None
    parts = [spark.read.parquet(r["path"]).withColumn("ano_arquivo", F.lit(r["ano"]).cast("int")) for r in sorted(newest, key=lambda r: r["ano"] or 0)]
    return union_all(parts)


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table if it exists in the catalog, else a typed empty frame."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Table names of a database, sorted."""
    return sorted(t.name for t in spark.catalog.listTables(database))
