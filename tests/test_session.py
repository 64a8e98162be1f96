"""The shared helper that writes intermediate tables."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civiclake.llm import language_id
from civiclake.session import SHUFFLE_CLEANUP, materialize

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shuffle_files(spark):
    jvm = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    dirs = [d.getPath() for d in jvm.localDirs()]
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_materialize_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(10_000).repartition(4, F.col("id") % 17).groupBy((F.col("id") % 5).alias("g")).count()
    table = materialize(df, "test-shuffle-files")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    assert sorted(tuple(r) for r in table.collect()) == [(g, 2000) for g in range(5)]
    assert sorted(tuple(r) for r in df.collect()) == [(g, 2000) for g in range(5)]    # the frame itself can still be used


def test_materialize_keeps_a_setting_of_the_session(spark):
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        materialize(spark.range(3), "test-setting")
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


@pytest.mark.parametrize("step", ["materialize", "predict"])
def test_wide_rows_go_to_python_in_small_batches(spark, step):
    def batch_sizes(parts):
        for p in parts:
            yield pa.RecordBatch.from_arrays([pa.array([p.num_rows]), pa.array([p.nbytes])], names=["n", "size"])

    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"))
    was = spark.conf.get(ARROW_BYTES, None)
    spark.conf.unset(ARROW_BYTES)
    try:
        sizes = docs.mapInArrow(batch_sizes, "n long, size long")
        if step == "materialize":
            sizes = materialize(sizes, "test-batches")
        else:
            language_id.predict(docs, language_id.Model(()))
        got = sizes.collect()
    finally:
        if was is not None:
            spark.conf.set(ARROW_BYTES, was)
        else:
            spark.conf.unset(ARROW_BYTES)
    assert sum(r.n for r in got) == 600
    assert max(r.size for r in got) < 6_000_000 < 600 * 50_000


def test_small_batches_keep_a_bound_of_the_session(spark):
    was = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, "12m")
    try:
        materialize(spark.range(3), "test-bound")
        assert spark.conf.get(ARROW_BYTES) == "12m"
    finally:
        if was is not None:
            spark.conf.set(ARROW_BYTES, was)
        else:
            spark.conf.unset(ARROW_BYTES)
