"""Exact deduplication as a stateful stream (native).

A digest table (digest, identifier, locator of the content, length) is written
once from the documents and consumed as a stream into disk-backed keyed state
(RocksDB), one entry per digest, without watermark or expiry. Locators count from 0
in each run, so a checkpoint serves one run only. The state of every digest
holds the row that stays so far and the number of rows seen. On hits the full
bytes are compared: texts under one digest must be identical, else the group is
taken apart by its texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.session import materialize, scratch_dir

#: fixed values: the characters of [\x20\x09-\x0D]
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # many small stores: no preallocated files, changes instead of whole snapshots
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def squeezed(text: Column) -> Column:
    """The text without white space; null is empty."""
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = squeezed(F.col(text_col))
    return docs.select(F.monotonically_increasing_id().alias("locator"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("n_chars"),
                       F.unhex(F.sha2(norm, 256)).alias("digest"))


def stream_state(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Run the digest files under ``path`` that ``checkpoint`` has not seen yet
    through the keyed state; return the state: (digest, n, best)."""
    order = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        state = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("best"))
        (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).start().awaitTermination())
        kept = spark.read.format("statestore").load(checkpoint)
        names = kept.schema["value"].dataType.names
        return materialize(kept.select("key.digest", F.col(f"value.`{names[0]}`").alias("n"), F.col(f"value.`{names[1]}`").alias("best")), "dedup-state")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def contested(docs: DataFrame, text_col: str, state: DataFrame) -> DataFrame:
    """Digests whose rows differ in their full bytes (normally none).

    Least and greatest text of every digest seen more than once are aggregated on
    the map side first, so a text with a million copies is one row per task."""
    norm = squeezed(F.col(text_col))
    texts = docs.select(norm.alias("norm")).withColumn("digest", F.unhex(F.sha2("norm", 256)))
    hits = texts.join(state.filter("n > 1").select("digest"), "digest", "left_semi")
    return hits.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).filter("lo <> hi").select("digest")


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", checkpoint: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (locator, doc_id, keep_id, group_size, kept,
    digest).

    Texts are equal when identical without white space (null is empty). Of equal
    texts the row with the most code points, then the smallest doc_id (null
    last), then the first row stays; exactly one row per group is ``kept``, also
    when an id repeats. Empty texts form one group. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "dedup-digests")
    digest_rows(docs, id_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    state = stream_state(spark, path, checkpoint or scratch_dir(spark, "dedup-stream"))
    groups = state.select("digest", F.col("n").alias("group_size"), F.col("best.doc_id").alias("keep_id"), F.col("best.locator").alias("keep_at"))
    out = rows.join(groups, "digest", "left").select(
        "locator", "doc_id", "keep_id", "group_size", (F.col("locator") == F.col("keep_at")).alias("kept"), "digest")
    odd = materialize(contested(docs, text_col, state), "dedup-contested")
    if odd.isEmpty():
        return out
    whole = docs.select(F.monotonically_increasing_id().alias("locator"), F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("n_chars"), squeezed(F.col(text_col)).alias("norm"))
    whole = materialize(whole.withColumn("digest", F.unhex(F.sha2("norm", 256))).join(odd, "digest", "left_semi"), "dedup-apart")
    order = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
    apart = whole.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best"))
    again = whole.join(apart, ["digest", "norm"]).select(
        "locator", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("best.locator")).alias("kept"), "digest")
    return out.join(odd, "digest", "left_anti").select(again.columns).unionByName(again)
