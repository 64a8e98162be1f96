"""A corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of documents. Decisions are joined back
by document id and digest or size, or by a row key, so ids may repeat or be null.
Extra columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from civiclake.llm.queries import tokenizer
from civiclake.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear. Null and letterless texts and texts for
    which two languages' dictionaries compress equally well go; a null ``lang``
    becomes the prediction."""
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    kept = language_id.predict(docs, model, keep={f"c{i}": F.col(c) for i, c in enumerate(docs.columns)}).filter(~F.col("rejected"))
    named = [F.coalesce(F.col(f"c{i}"), F.col("lang_pred")).alias(c) if c == "lang" else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return kept.select(*named)


def wrapped(docs: DataFrame) -> DataFrame:
    """All columns in one struct, so that no name of theirs meets a stage's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal without white space, the longest text's,
    then the least id's (null last). Null, empty and blank texts are one group;
    an empty table stays empty."""
    found = materialize(exact_dedup.dedup(docs.select("doc_id", "text")), "pipeline-exact")
    gone = found.filter(~F.col("kept"))
    keyed = wrapped(docs).withColumn("digest", F.unhex(F.sha2(exact_dedup.squeezed(F.col("doc.text")), 256)))
    lost = gone.select(F.col("doc_id").alias("id"), F.col("digest").alias("lost")).distinct()
    left = keyed.join(lost, (F.col("digest") == F.col("lost")) & F.col("doc.doc_id").eqNullSafe(F.col("id")), "left_anti").select("doc")
    # an id that repeats with the text that stays: all its rows went, one comes back
    again = lost.join(found.filter("kept").select("doc_id", "digest"), (F.col("lost") == F.col("digest")) & F.col("id").eqNullSafe(F.col("doc_id"))).select("id", "lost")
    again = materialize(again, "pipeline-again")
    if not again.isEmpty():
        back = keyed.join(again, (F.col("digest") == F.col("lost")) & F.col("doc.doc_id").eqNullSafe(F.col("id")), "left_semi")
        longest = back.groupBy("digest").agg(F.max(F.struct(F.length("doc.text").alias("n"), "doc")).alias("r"))
        left = left.unionByName(longest.select("r.doc"))
    return left.select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least id (null last), of each group linked by 5-word
    shingle sets of Jaccard 0.8 or more. Rows are told apart by a key of their own,
    so ids may repeat or be null; texts without words are in no group."""
    keyed = materialize(wrapped(docs).withColumn("row", F.monotonically_increasing_id()), "pipeline-keyed")
    found = jaccard_join.join(keyed.select("row", F.col("doc.text").alias("text")), id_col="row", words=5, num=80, den=100)
    ids = keyed.select(F.col("row").alias("key"), F.col("doc.doc_id").alias("id"))
    rows = found.select(F.col("doc_id").alias("key"), "component_id").join(ids, "key")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    stay = rows.groupBy("component_id").agg(F.min(order).alias("best")).select(F.col("best.key").alias("row"))
    return keyed.join(materialize(stay, "pipeline-near"), "row", "left_semi").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at target weights: a document comes once for each whole time it is
    taken, and cut to its first words where a block ends inside it (one document
    per shard). Documents without words are taken 0 times; an empty table stays
    empty; a column ``n_chars`` is set to the new length."""
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias("id"), "size").agg(F.max("taken").alias("taken"))
    taken = materialize(taken.filter("taken > 0"), "pipeline-mix")
    size = F.coalesce(F.regexp_count("doc.text", F.lit(mixing.WORD)), F.lit(0)).cast("long")
    rows = wrapped(docs).withColumn("own", size).join(taken, F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("size")))
    whole = F.array_repeat(F.col("size"), F.floor(F.col("taken") / F.col("size")).cast("int"))
    rest = F.col("taken") % F.col("size")
    rows = rows.select("doc", "size", F.explode(F.concat(whole, F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))).alias("n"))
    words = F.regexp_extract_all("doc.text", F.lit(f"({mixing.WORD})"))
    cut = F.when(F.col("n") == F.col("size"), F.col("doc.text")).otherwise(F.array_join(F.slice(words, 1, F.col("n").cast("int")), " "))
    rows = rows.select(F.col("doc").withField("text", cut).alias("doc"))
    if "n_chars" in docs.columns:
        rows = rows.select(F.col("doc").withField("n_chars", F.length("doc.text").cast(docs.schema["n_chars"].dataType)).alias("doc"))
    return rows.select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 2048 tokens. Null and empty texts
    are the end id alone; an empty table gives no piece."""
    return packing.pack(docs, tokenizer(), capacity=2048, keep={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: SQL cannot express the first and the last stage; tests hold the pipeline
#: against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
