"""Near-duplicate embeddings by int8 tile products with rigorous bounds.

Vectors are scaled to unit length and rounded to int8 with a scale of their own;
the exact length of what rounding lost is kept. Blocks of vectors meet in tiles
(every unordered pair of blocks once), where the int8 products give each cosine
up to a bound from the two rounding errors. Only pairs that the bound cannot rule
out are computed again in double precision. A tile returns link counts and one
star per linked group, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.llm.components import components
from civiclake.session import materialize

BLOCK = "ids binary, mult binary, full binary, q binary, scale binary, lost binary"


def quantise(full: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, their int8 codes, scales and the lengths of what was lost."""
    unit = full / np.abs(full).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1)) + 1e-12
    return unit, q, scale, lost


def tile_links(a: dict, b: dict, same: bool, threshold: float, step: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a, into b) with cosine >= threshold; i < j if same."""
    got: list[tuple[np.ndarray, np.ndarray]] = []
    qb = b["q"].astype(np.float32).T
    for at in range(0, len(a["q"]), step):
        part = slice(at, at + step)
        # products of int8 codes are whole numbers below 2**24 for up to 1040
        # dimensions, so single precision holds them exactly; beyond, use double
        qa = a["q"][part].astype(np.float32 if qb.shape[0] <= 1040 else np.float64)
        approx = (qa @ qb) * a["scale"][part, None].astype(np.float32)
        ea, eb = a["lost"][part], b["lost"]
        # |x.y - x'.y'| <= (1 + ea) eb + (1 + eb) ea + ea eb, with slack for rounding
        floor = (threshold - ((1 + ea.max()) * eb + (1 + eb) * ea.max() + ea.max() * eb) - 1e-5) / b["scale"]
        i, j = np.nonzero(approx >= floor.astype(np.float32)[None, :] * np.float32(1 - 1e-6))
        if same:
            i, j = i[j > i + at], j[j > i + at]
        for k in range(0, len(i), 65_536):
            x, y = i[k:k + 65_536] + at, j[k:k + 65_536]
            near = (a["unit"][x] * b["unit"][y]).sum(axis=1) >= threshold
            got.append((x[near], y[near]))
    if not got:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])


def stars(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node it reaches over the pairs (x, y)."""
    root = np.arange(n)
    while len(x):
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def block_of(pdf: pd.DataFrame) -> pd.DataFrame:
    full = np.array(pdf["v"].tolist(), dtype=np.float64)
    _, q, scale, lost = quantise(full)
    exact32 = full.astype(np.float32)
    kept = exact32 if (exact32 == full).all() else full
    return pd.DataFrame({"dim": [full.shape[1]], "block": [pdf["block"].iloc[0]], "ids": [pdf["node"].to_numpy(np.int64).tobytes()],
                         "mult": [pdf["mult"].to_numpy(np.int64).tobytes()], "full": [kept.tobytes()], "q": [q.tobytes()],
                         "scale": [scale.tobytes()], "lost": [lost.tobytes()]})


def opened(row: pd.Series, dim: int) -> dict:
    n = len(row["ids"]) // 8
    kind = np.float32 if len(row["full"]) == 4 * n * dim else np.float64
    full = np.frombuffer(row["full"], dtype=kind).reshape(n, dim).astype(np.float64)
    return {"ids": np.frombuffer(row["ids"], np.int64), "mult": np.frombuffer(row["mult"], np.int64), "unit": quantise(full)[0],
            "q": np.frombuffer(row["q"], np.int8).reshape(n, dim), "scale": np.frombuffer(row["scale"]), "lost": np.frombuffer(row["lost"])}


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    block_rows: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Two rows link when the cosine of their vectors, in double precision, is at
    least ``threshold`` (over 0). Vectors that are null, empty, zero or hold null
    or non-finite components, and vectors of another dimension, link with
    nothing. ``n_links`` counts the other rows linked directly, equal vectors
    included; ``component_id`` is the least id reachable (ids: null last), and
    ``kept`` is true for one row of each component that has it. Equal vectors are
    compared once. An empty table gives an empty result; other columns are
    ignored. All vectors are compared with all: the work is quadratic in the
    number of distinct vectors, in tiles of ``block_rows`` squared.
    """
    v = F.col(vector_col)
    sound = F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(sound, F.lit(False)), v).alias("v"))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "embeddings")
    distinct = rows.filter("v is not null").groupBy("v").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("mult"))
    distinct = materialize(distinct, "embedding-nodes")

    sizes = distinct.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("n_blocks"))
    nodes = distinct.withColumn("dim", F.size("v")).join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")))
    blocks = nodes.select("dim", "block", "v", "node", "mult").groupBy("dim", "block").applyInPandas(block_of, f"dim int, block long, {BLOCK}")
    blocks = materialize(blocks, "embedding-blocks")
    # every unordered pair of blocks once, each block in as many tiles as any
    # other: block i meets i, i + 1, ... half way around
    n = F.col("n_blocks")
    half = F.floor(n / 2).cast("long")
    ring = blocks.join(sizes, "dim").withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), half)))
    halfway = (F.col("step") == half) & (n % 2 == 0) & (n > 1)
    payload = ["ids", "mult", "full", "q", "scale", "lost"]

    def side(i: Column, j: Column, suffix: str) -> DataFrame:
        keys = [F.col("dim").alias(f"dim{suffix}"), i.alias(f"i{suffix}"), j.alias(f"j{suffix}")]
        return ring.filter(~halfway | (i < half)).select(*keys, *[F.col(c).alias(c) for c in payload]).groupBy(
            f"dim{suffix}", f"i{suffix}", f"j{suffix}")

    own, other = F.col("block"), F.pmod(F.col("block") + F.col("step"), n)
    left, right = side(own, other, ""), side(F.pmod(own - F.col("step"), n), own, "_b")

    def tile(a_rows: pd.DataFrame, b_rows: pd.DataFrame) -> pd.DataFrame:
        dim, same = int(a_rows["dim"].iloc[0]), a_rows["i"].iloc[0] == a_rows["j"].iloc[0]
        a = opened(a_rows.iloc[0], dim)
        b = a if same else opened(b_rows.iloc[0], dim)
        x, y = tile_links(a, b, same, threshold)
        ids = a["ids"] if same else np.concatenate([a["ids"], b["ids"]])
        y_at = y if same else y + len(a["ids"])
        links = np.bincount(x, weights=b["mult"][y], minlength=len(ids)) + np.bincount(y_at, weights=a["mult"][x], minlength=len(ids))
        root = stars(len(ids), x, y_at)
        some = np.flatnonzero(links)
        return pd.DataFrame({"node": ids[some], "links": links[some].astype(np.int64), "root": ids[root[some]]})

    found = left.cogroup(right).applyInPandas(tile, "node long, links long, root long")
    found = materialize(found, "embedding-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select("node", "root"))
    known = distinct.join(links, "node", "left").join(roots, "node", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    out = rows.join(known, "v", "left").withColumn("root", F.coalesce("root", "row"))
    out = materialize(out.select("row", "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root"), "embedding-rows")
    least = out.groupBy("root").agg(F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "row")).alias("first"))
    return out.join(least, "root").select("vec_id", "n_links", F.col("first.vec_id").alias("component_id"),
                                          (F.col("row") == F.col("first.row")).alias("kept"))
