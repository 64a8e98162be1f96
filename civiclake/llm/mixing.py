"""Mixing sources to target weights by Sainte-Lague apportionment (native).

The mix is cut into blocks of equal token count. Blocks are given to the sources
by the highest quotients ``votes / (2 * seats + 1)``, and each source's blocks
to its shards the same way, so every shard has an integer quota. A shard lays its
documents end to end in a seeded order and takes its quota of blocks from that
stream, starting over when the stream ends.

Everything is DataFrame work: one scan that counts words, aggregates per source
and per shard, and one running sum inside each shard (about ``shard_docs`` rows,
so a source holding a third of all rows is spread over many shards).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def capped_targets(sources: DataFrame, weights: Sequence[float], total_ratio: float, cap: float) -> DataFrame:
    """Add ``target`` to rows (source, source_size).

    Sources in code point order (null last) take ``weights`` in turn. They share
    ``total_ratio`` of all sizes by weight; a target stops at ``cap`` times its
    source's size and the excess is shared again by weight. With sources sorted
    by size per weight the capped ones are a prefix, and the level
    ``(total - caps before) / (weights from here on)`` is largest where the
    prefix ends, so one running sum finds the final level. Rows: one per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = sources.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", w[F.pmod(F.col("rank") - 1, F.lit(len(weights)))])
    limit = F.col("source_size") * cap
    before = F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * total_ratio
    level = ranked.withColumn("level", (total - before) / after)
    return level.withColumn("target", F.least(limit, F.col("weight") * F.max("level").over(everything))).drop("level")


def sainte_lague(parties: DataFrame, group: Sequence[str], order: Sequence[str], votes: str, seats: str) -> DataFrame:
    """Add ``quota``: the ``seats`` of each group (a column, equal within the
    group) given to its parties by highest quotients; ties go to the first party
    by ``order`` (unique within the group).

    Rounding ``seats * votes / all votes`` is off from the sum by ``off``; with P
    parties no party is then more than ``(off + P) * share + 1`` seats away, so
    only that many quotients per party (3.5 P rows in all) are ranked.
    """
    g = Window.partitionBy(*group)
    share = F.col(votes) / F.col("_all")
    base = (parties.withColumn("_all", F.sum(votes).over(g))
            .withColumn("_n", F.count(F.lit(1)).over(g))
            .withColumn("_seats", F.when(F.col("_all") > 0, F.floor(F.col(seats) * share + 0.5)).otherwise(F.lit(0)))
            .withColumn("_off", F.when(F.col("_all") > 0, F.col(seats) - F.sum("_seats").over(g)).otherwise(F.lit(0))))
    reach = F.ceil((F.abs("_off") + F.col("_n")) * share) + 1
    reach = F.when(F.col("_off") > 0, reach).otherwise(F.least(reach, F.col("_seats")))
    some = base.filter((F.col("_off") != 0) & (F.col(votes) > 0) & (reach > 0)).withColumn(
        "_j", F.explode(F.sequence(F.lit(1), reach.cast("int"))))
    seat = F.when(F.col("_off") > 0, F.col("_seats") + F.col("_j")).otherwise(F.col("_seats") - F.col("_j") + 1)
    some = some.withColumn("_q", F.col(votes) / (2 * seat - 1)).withColumn("_key", F.when(F.col("_off") > 0, -F.col("_q")).otherwise(F.col("_q")))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("_key"), *_tie(order)))
    moved = (some.withColumn("_place", place).filter(F.col("_place") <= F.abs("_off"))
             .groupBy(*group, *order).agg(F.sum(F.signum("_off")).alias("_moved")))
    moved = moved.select(*[F.col(c).alias(f"_m_{c}") for c in (*group, *order)], "_moved")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in (*group, *order)])
    quota = (F.col("_seats") + F.coalesce(F.col("_moved"), F.lit(0))).cast("long").alias("quota")
    return base.join(moved, same, "left").select(*parties.columns, quota)


def _tie(order: Sequence[str]) -> list[Column]:
    # first party wins a seat at a tie, and keeps it: when seats are taken back
    # (off < 0) the last party by order gives first
    out: list[Column] = []
    for c in order:
        out += [F.when(F.col("_off") > 0, F.col(c)).asc_nulls_last(), F.when(F.col("_off") < 0, F.col(c)).desc_nulls_first()]
    return out


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (3, 1, 2), total_ratio: float = 1.5, cap: float = 2.0,
        block_words: int = 64, shard_docs: int = 20_000, seed: str = "mix") -> DataFrame:
    """How many words of each document the mix takes.

    Returns (doc_id, source, size, source_size, target, taken), one row per row
    of ``docs``. ``taken`` may reach ``cap`` (at most 2) times ``size``: each pass
    over a shard takes its documents once. A source's taken words are its integer
    number of blocks, so within one block of its target.

    Null text has size 0; a null source is a source of its own, last in order;
    null ids are allowed. Sources of size 0 have target 0; repeated rows are
    separate documents. An empty table gives an empty result. Columns other than
    the three named are ignored.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    base = materialize(base.withColumn("key", key), "mix-sizes")

    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = capped_targets(sources, weights, total_ratio, cap)
    targets = targets.withColumn("blocks", F.floor(F.sum("target").over(Window.partitionBy()) / block_words + 0.5).cast("long"))
    targets = targets.withColumn("all", F.lit(0))
    quotas = sainte_lague(targets, ["all"], ["rank"], "target", "blocks")
    quotas = quotas.select("source", "source_size", "target", F.col("quota").alias("source_quota"),
                           F.ceil(F.col("n_docs") / shard_docs).cast("long").alias("n_shards"))
    quotas = materialize(quotas, "mix-quotas")

    q = quotas.withColumnRenamed("source", "_source")
    shard = F.pmod(F.conv(F.substring("key", 1, 12), 16, 10).cast("long"), F.col("n_shards"))
    rows = base.join(q, base["source"].eqNullSafe(q["_source"]), "left").drop("_source").withColumn("shard", shard)
    rows = materialize(rows, "mix-shards")

    shards = rows.groupBy("source", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    shards = sainte_lague(shards, ["source"], ["shard"], "shard_size", "source_quota")
    words = F.least(F.col("quota") * block_words, (F.col("shard_size") * cap).cast("long"))
    s = shards.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_size", words.alias("quota_words"))
    rows = rows.join(s, rows["source"].eqNullSafe(s["_source"]) & (rows["shard"] == s["_shard"]), "left")

    # the identical columns of the order make ties interchangeable rows
    stream = Window.partitionBy("source", "shard").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(stream), F.lit(0))
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("quota_words") / F.col("shard_size"))).otherwise(F.lit(0))
    rest = F.col("quota_words") - F.col("passes") * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return (rows.withColumn("start", start).withColumn("passes", passes)
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("passes") * F.col("size") + part).cast("long").alias("taken")))
