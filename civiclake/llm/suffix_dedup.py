"""Repeated passages by sparse suffix arrays.

Of every document only the suffixes at minimiser positions are kept: in each run
of ``least`` words, the position whose gram of ``gram`` words has the smallest
hash. Equal passages of ``least`` words or more hold the same positions, so a
passage that repeats has retained suffixes that sort next to each other. Sorting
and comparing neighbours by their gram leaves the suffixes that may match. Their
matches are extended to the left and right by comparing, around each suffix, all
runs of ``least`` words of which it is the minimiser, again sorted next to their
equals; runs that repeat and overlap are joined to the longest passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm import bloom, shingles
from civiclake.llm.arrow_rows import table_batch, text_slices, utf8_parts
from civiclake.llm.key_runs import MASK, PASS, SPEC, Combiner, batches, repeated
from civiclake.session import materialize

STEP = np.uint64(0x9FB21C651E98DF25)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes (mod 2**64) of the runs of n words, by doubling."""
    if n == 1:
        return h
    half = gram_hashes(h, n // 2)
    two = half[:len(h) - n + n % 2 + 1] * power(n // 2) + half[n // 2:][:len(h) - n + n % 2 + 1]
    return two[:len(h) - n + 1] * STEP + h[n - 1:] if n % 2 else two


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(STEP), n, 1 << 64))


def minimisers(h: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes, the position each run of ``least`` words keeps, and the runs'
    hashes; the runs are named by their first word."""
    with np.errstate(over="ignore"):
        g = shingles.mixed(gram_hashes(h, gram))
        kept = sliding_window_view(g, least - gram + 1).argmin(axis=1) + np.arange(len(h) - least + 1)
        runs = shingles.mixed(gram_hashes(h, least) ^ np.uint64(least))
    return g, kept, runs


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def node_of(h: np.ndarray) -> int:
    """Hash of a whole text's words in order, as a signed number."""
    place = np.arange(len(h), dtype=np.uint64) * STEP
    total = np.add.reduce(shingles.mixed(h + place), dtype=np.uint64) + np.uint64(len(h))
    return int(shingles.mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def repeated_grams(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """Retained suffixes whose gram occurs at several places, as (k: gram, a:
    node, b: position), and a passed-through row per document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combine = Combiner(pairs=True)
        for b in text_slices(parts, "text", 1 << 18):
            h, _, _, at = shingles.words(*utf8_parts(b.column(1)), lower=False)
            info = np.empty((3, len(b)), dtype=np.int64)
            for i, doc in enumerate(b.column(0).to_pylist()):
                w = h[at[i]:at[i + 1]]
                node = node_of(w)
                info[:, i] = (len(w) << 3 | (doc is None) << 2 | PASS, node, 0 if doc is None else doc)
                if len(w) >= least:
                    g, kept, _ = minimisers(w, least, gram)
                    kept = np.unique(kept)
                    if combine.add(g[kept].view(np.int64), np.full(len(kept), node), kept):
                        yield from combine.rows()
            yield from batches(*info)
        yield from combine.rows()

    return repeated(docs.mapInArrow(run, SPEC), pairs=True)


def repeated_runs(docs: DataFrame, grams: DataFrame, least: int, gram: int, bits: int) -> DataFrame:
    """Runs of ``least`` words that occur at several places: (k, a: node, b: first
    word). Only runs whose minimiser repeats are looked at."""
    words = bloom.build(grams, bits)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combine = Combiner(pairs=True)
        for b in text_slices(parts, "text", 1 << 18):
            h, _, _, at = shingles.words(*utf8_parts(b.column(1)), lower=False)
            for i in range(len(b)):
                w = h[at[i]:at[i + 1]]
                if len(w) < least:
                    continue
                g, kept, runs = minimisers(w, least, gram)
                hit = np.flatnonzero(bloom.passes(words, g.view(np.int64) & MASK)[kept])
                if len(hit) and combine.add(runs[hit].view(np.int64), np.full(len(hit), node_of(w)), hit):
                    yield from combine.rows()
        yield from combine.rows()

    return repeated(docs.mapInArrow(run, SPEC), pairs=True)


def joined(runs: DataFrame, least: int) -> DataFrame:
    """(node, start_word, end_word): overlapping or touching runs as one passage."""
    schema = pa.schema([("node", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int] | None = None  # the passage that may go on
        for p in parts:
            node, at = np.asarray(p.column(0)), np.asarray(p.column(1))
            if not len(node):
                continue
            new = np.concatenate([[True], (node[1:] != node[:-1]) | (at[1:] - at[:-1] > least)])
            first = np.flatnonzero(new)
            end = at[np.concatenate([first[1:], [len(at)]]) - 1] + least
            spans = list(zip(node[first].tolist(), at[first].tolist(), end.tolist(), strict=True))
            if last:
                if spans[0][0] == last[0] and spans[0][1] <= last[2]:
                    spans[0] = (last[0], last[1], max(last[2], spans[0][2]))
                else:
                    spans.insert(0, last)
            last = spans.pop()
            if spans:
                yield table_batch(schema, [list(x) for x in zip(*spans, strict=True)])
        if last:
            yield table_batch(schema, [[x] for x in last])

    rows = runs.select(F.col("a").alias("node"), F.col("b").alias("at")).repartition("node").sortWithinPartitions("node", "at")
    return rows.mapInArrow(run, "node long, start_word long, end_word long")


def passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 50, gram: int = 25, filter_bits: int = 1 << 24) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, whole): the passages of at least
    ``least`` words that occur at another place too, in another document or the
    same one, each as long as it is covered by repeated runs of ``least`` words.

    Words are runs of characters other than white space, compared exactly; they
    are counted from 0 and the end is exclusive. ``whole`` marks documents whose
    every word is in the passage. Texts with equal words are one node; if it has
    several documents, each of ``least`` words or more is a passage as a whole.
    Null, empty and shorter texts have no passages. Null ids are kept; repeated
    rows are documents of their own; an empty table gives an empty result; other
    columns are ignored. Words and runs are compared by 64-bit hashes.
    """
    rows = texts(docs, id_col, text_col)
    found = materialize(repeated_grams(rows, least, gram), "suffix-grams")
    flag = F.col("k").bitwiseAND(F.lit(3))
    info = found.filter(flag == PASS).select(F.when(F.col("k").bitwiseAND(F.lit(4)) == 0, F.col("b")).alias("doc_id"),
                                             F.col("a").alias("node"), F.shiftright("k", 3).alias("size"))
    grams = found.filter(flag == 0).select("k").distinct()
    spans = materialize(joined(repeated_runs(rows, grams, least, gram, filter_bits), least), "suffix-passages")
    copies = info.groupBy("node", "size").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & (F.col("size") >= least))
    whole = copies.select("node", F.lit(0).cast("long").alias("start_word"), F.col("size").alias("end_word"))
    spans = spans.join(whole, "node", "left_anti").unionByName(whole)
    out = info.join(spans, "node")
    return out.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                      ((F.col("start_word") == 0) & (F.col("end_word") == F.col("size"))).alias("whole"))
