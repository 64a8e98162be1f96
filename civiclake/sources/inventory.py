"""What was landed, as data: files with their folder values, layouts and headers.

One Spark job lists the files of a folder and looks at a few bytes of each (a
Parquet footer, a first line) in tasks; decisions per file are then columns of a
frame, and the driver receives one row per layout.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_BYTES = 1 << 20     # a header line longer than this is cut
# Stores that Arrow opens in tasks. Files of others (a mount table, say)
# are looked at through Hadoop's file system from the driver, file by file.
ARROW_STORES = ["file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"]
PROBE_THREADS = 16


def folder_value(path: Column | str, name: str) -> Column:
    """The value of the folder ``name=value`` in a file path, null without one."""
    p = F.col(path) if isinstance(path, str) else path
    v = F.url_decode(F.regexp_extract(p, rf"/{name}=([^/]*)/", 1))
    return F.when(~v.isin("", "__HIVE_DEFAULT_PARTITION__"), v)


def landed_files(spark: SparkSession, path: str | Sequence[str], suffix: str, fragment: str | None = None, states: Sequence[str] | None = None,
                 ano: int | None = None) -> DataFrame:
    """(path, length, uf, ano) of the files below ``path`` that end in ``suffix`` and,
    without regard to case, hold ``fragment`` in their path below it (folders included).

    ``uf`` and ``ano`` are the values of folders ``uf=``/``ano=``. With ``states`` only
    files under one of these states' folders are listed, with ``ano`` none under
    another year's folder: pruned folders are not read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    glob = "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(paths)
    year = folder_value("path", "ano").try_cast("int")
    files = raw.select("path", "length", folder_value("path", "uf").alias("uf"), year.alias("ano"))
    if fragment:
        roots = [p.rstrip("/").split("://")[-1].lstrip("/").lower() for p in paths]
        below = F.lower("path")
        for r in roots:
            below = F.when(F.locate(r, below) > 0, F.substring_index(below, r, -1)).otherwise(below)
        files = files.where(F.contains(below, F.lit(fragment.lower())))
    if states is not None:
        files = files.where(F.col("uf").isin(*states))
    if ano is not None:
        files = files.where(F.col("ano").isNull() | (F.col("ano") == F.lit(int(ano))))
    return files


def _opened(path: str):
    """An open file of any store that Arrow reads."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _footer(path: str) -> str:
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    def kind(t: pa.DataType) -> str:
        try:
            return from_arrow_type(t).simpleString()
        except Exception:  # noqa: BLE001 - a type that Spark has not: the column is no key
            return "unknown"
    with _opened(path) as f:
        return json.dumps([[c.name, kind(c.type)] for c in pq.read_schema(f)])


def _first_line(path: str) -> str:
    with _opened(path) as f:
        return f.read(HEADER_BYTES).split(b"\n", 1)[0].rstrip(b"\r").decode("latin-1")


LOOKED_AT = "path string, uf string, ano int, found string, error string"


def _safely(look: Callable[[str], str], path: str) -> tuple[str | None, str | None]:
    try:
        return look(path), None
    except Exception as e:  # noqa: BLE001 - kept as data, reported by the caller
        return None, type(e).__name__


def _looked_at(files: DataFrame, look: Callable[[str], str], from_driver: Callable[[str], str]) -> DataFrame:
    schema = pa.schema([("path", pa.string()), ("uf", pa.string()), ("ano", pa.int32()), ("found", pa.string()), ("error", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            got = [_safely(look, p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array([g[k] for g in got], pa.string()) for k in (0, 1)]], schema=schema)

    files = files.select("path", "uf", "ano")
    known = F.substring_index("path", ":", 1).isin(*ARROW_STORES)
    seen = files.where(known).mapInArrow(run, LOOKED_AT)
    if not files.inputFiles() or files.inputFiles()[0].split(":", 1)[0] in ARROW_STORES:
        return seen
    rest = files.where(~known).collect()
    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        got = list(pool.map(lambda r: (*r, *_safely(from_driver, r["path"])), rest))
    return seen.unionByName(files.sparkSession.createDataFrame(got, LOOKED_AT))


def footers(files: DataFrame) -> DataFrame:
    """(path, uf, ano, columns, error): names and Spark types of a Parquet file's
    columns, or why its footer cannot be read. Tasks read the footers, by Arrow's
    file systems (local, HDFS, S3, GCS)."""
    spark = files.sparkSession
    seen = _looked_at(files, _footer, lambda p: json.dumps([[f.name, f.dataType.simpleString()] for f in spark.read.parquet(p).schema.fields]))
    pairs = F.from_json("found", "array<array<string>>")
    return seen.select("path", "uf", "ano", F.transform(pairs, lambda p: F.struct(p[0].alias("name"), p[1].alias("type"))).alias("columns"), "error")


def headers(files: DataFrame) -> DataFrame:
    """(path, uf, ano, header, error): the first line's bytes as latin-1 text."""
    jvm, conf = files.sparkSession._jvm, files.sparkSession._jsc.hadoopConfiguration()

    def through_hadoop(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "ISO-8859-1")).readLine() or ""
        finally:
            stream.close()

    return _looked_at(files, _first_line, through_hadoop).withColumnRenamed("found", "header")


def first_present(columns: Column | str, candidates: Sequence[str]) -> Column:
    """P5 as data: the first of ``candidates`` among the names in ``columns``."""
    names = F.transform(F.col(columns) if isinstance(columns, str) else columns, lambda c: c["name"])
    return F.coalesce(*[F.when(F.array_contains(names, c), F.lit(c)) for c in candidates])


def type_of(columns: Column | str, name: Column | str) -> Column:
    cols = F.col(columns) if isinstance(columns, str) else columns
    name = F.lit(name) if isinstance(name, str) else name
    return F.get(F.filter(cols, lambda c: c["name"] == name), F.lit(0))["type"]


def layouts(rows: DataFrame, by: Sequence[str]) -> list:
    """One row per layout (the values of ``by``) with its files in order: what a scan
    is given. Spark's file index holds the same paths on the driver."""
    return sorted(rows.groupBy(*by).agg(F.sort_array(F.collect_list("path")).alias("paths")).collect(), key=str)
