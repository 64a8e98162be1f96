"""Session helpers: a configured SparkSession and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "civiclake", local_memory: str = "16g") -> SparkSession:
    """Return a session with the settings the library relies on.

    On a cluster the master, memory and partition counts come from the submit
    configuration; ``master`` / ``shuffle_partitions`` / ``local_memory`` are for
    local runs (in local mode every task runs in the driver JVM, so its heap is
    the executors' memory).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", local_memory)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce shuffle partitions to the advisory size (not to the core
        # count): fewer tiny tasks locally, right-sized partitions on a cluster
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a temporary
    folder is created once per process and registered as the context's
    checkpoint directory.
    """
    global _LOCAL_ROOT
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no local context
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if sc is not None and not sc.master.startswith("local") or sc is None:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="civiclake-ckpt-")
        root = _LOCAL_ROOT
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique (not yet existing) path below the shared checkpoint root
    for written tables."""
    root = checkpoint_root(spark)
    return f"{root}/civiclake/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def dropped(df) -> None:
    """Delete a materialized table that nothing reads any more."""
    for folder in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        remove(df.sparkSession, folder)


#: bytes of rows that a Python function gets at a time. A task holds such a batch several
#: times: as vectors and as a stream outside the heap, and in the Python worker
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Send rows to the session's Python functions in batches of 4 MB (a longer row: alone)
    instead of 64 MB, unless the session has a bound of its own. For frames that their
    caller writes; ``materialize`` does it by itself."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


#: a query's shuffle files go when it ends, not when the driver collects garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as a Parquet table under the shared
    checkpoint folder and reading it back (a reliable checkpoint that computes
    the input once; ``Dataset.checkpoint`` runs it twice unless cached). The
    shuffle files of the write are deleted with it: what follows reads the table."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    small_batches(spark)
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)
    return spark.read.parquet(path)
