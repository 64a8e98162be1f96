"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    out = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # edges run from the larger to the smaller node here
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    joined = edges.join(least, F.col("a") == F.col("u"))
    out = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Whether every edge (a, b) leads from a node with this one edge to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.count_if(F.col("out") == 0).alias("into"))
    return seen.filter("out > 1 or (out = 1 and into > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns); the root is
    the least node of the component and is not listed under itself.

    Each round is two aggregations with map-side combining and two joins on the
    node, whose skewed side (a hub) is split by the adaptive join; the number of
    rounds grows with the logarithm of the longest path. Self loops, repeated
    edges and empty input are allowed.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    e = materialize(e, "components")
    while not _is_forest(e):
        e = materialize(_small_star(materialize(_large_star(e), "components")), "components")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def extended(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` of the edges behind ``roots`` and of ``edges`` together: only
    the components that ``edges`` join are gone through again."""
    a, b = edges.columns
    ra = roots.select(F.col("node").alias(a), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias(b), F.col("root").alias("rb"))
    tops = edges.join(ra, a, "left").join(rb, b, "left").select(F.coalesce("ra", a).alias("x"), F.coalesce("rb", b).alias("y"))
    # the ends are roots or in no component yet, so none is a node of ``roots``
    joined = components(tops)
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return materialize(moved.select("node", F.coalesce("top", "root").alias("root")).union(joined), "components")
