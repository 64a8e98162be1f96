"""The prefix trie of all conversations, with totals of every node.

A conversation is its path, one 128-bit id (of role and text) per turn. Paths are
range-partitioned and sorted, so what shares its first turns lies together, and
also a group of equal conversations is spread over many tasks (the conversation id
is the last sort key). A task takes its rows in batches of bounded size:

1. The turn ids of a batch become dense numbers in a padded matrix, rows by
   ``numpy.lexsort``, short rows before what continues them.
2. A row starts a node of depth d where any of its first d columns differs from
   the row before: column change masks, accumulated by OR.
3. ``reduceat`` between node starts gives the totals of all nodes of a depth.

Nodes inside a batch are finished there. Only the nodes that hold a batch's first
or last row can go on in another batch or task: they leave partial totals under a
key of their own, which are added up afterwards. Where two neighbouring batches
share nodes, these count twice; their common path gives what is to be taken off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.session import materialize

ID_BYTES = 16
NODE, PART, EDGE, ENDS = range(4)
SPEC = ("kind int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, task long, batch long, ends string, path binary, words array<int>")
SCHEMA = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                    ("ends_sha256", pa.string()), ("task", pa.int64()), ("batch", pa.int64()), ("ends", pa.string()), ("path", pa.binary()),
                    ("words", pa.list_(pa.int32()))])
TOTALS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NO_ENDS = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, words), one row per conversation: 16 bytes and the number of
    words per turn, by turn (null first). Turns at the same place go by role and
    text (its first 32 characters, then its digest); texts are not shuffled."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), F.left(text, F.lit(32)).alias("head"),
                    F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text)).alias("id"),
                    F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"))
    rows = turns.filter(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return rows.select("conv_id", F.unhex(F.array_join("t.id", "")).alias("path"), F.col("t.words").alias("words"))


def node_key(path: bytes, depth: int) -> bytes:
    return hashlib.md5(path[:ID_BYTES * depth]).digest()


def shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // ID_BYTES
    x = np.frombuffer(a, np.uint64, 2 * n) != np.frombuffer(b, np.uint64, 2 * n)
    return int(x.argmax()) // 2 if x.any() else n


def empty_rows() -> dict[str, list]:
    return {f.name: [] for f in SCHEMA}


def add_row(rows: dict[str, list], **values) -> None:
    for name, column in rows.items():
        column.append(values.get(name))


def overlap(rows: dict[str, list], before: bytes, after: bytes, words: list[int]) -> None:
    """What neighbouring batches counted twice: the nodes of the path that the last
    row of one and the first row of the next share, and the leaf at the end of
    ``before`` if ``after`` goes on from it or repeats it."""
    top = shared_turns(before, after)
    again = np.cumsum(np.array(words[:top][::-1], dtype=np.int64))[::-1].tolist()
    leaf = -1 if len(before) == ID_BYTES * top else 0
    for d in range(top + 1):
        add_row(rows, kind=PART, key=node_key(before, d), parent_key=node_key(before, d - 1) if d else None, depth=d, n_convs=0, n_children=-1 if d < top else 0,
                n_leaves=leaf, saved_tokens=again[max(d, 1) - 1] if top else 0)


class Matrix:
    """A batch of conversations as a padded matrix of turn numbers, sorted."""

    def __init__(self, paths: list[bytes], words: list[list[int]], convs: np.ndarray) -> None:
        lens = np.array([len(p) // ID_BYTES for p in paths], dtype=np.int64)
        n, width = len(paths), int(lens.max(initial=0))
        ids = np.frombuffer(b"".join(paths), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        order = np.lexsort((ids[:, 1], ids[:, 0]))
        by_id = ids[order]
        number = np.empty(len(ids), dtype=np.int32)
        number[order] = np.cumsum(np.concatenate([[0], (by_id[1:] != by_id[:-1]).any(axis=1)])[:len(ids)])
        row = np.repeat(np.arange(n), lens)
        col = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
        m = np.full((n, width), -1, dtype=np.int32)
        m[row, col] = number
        w = np.zeros((n, width), dtype=np.int64)
        w[row, col] = np.concatenate([np.asarray(x, dtype=np.int64) for x in words]) if len(row) else 0
        order = np.lexsort((convs, *m.T[::-1]))
        m, self.words, self.convs, self.lens = m[order], w[order], convs[order], lens[order]
        self.first, self.last = paths[order[0]], paths[order[-1]]
        self.first_words, self.last_words = words[order[0]], words[order[-1]]
        self.n, self.width = n, width
        self.change = np.ones((n, width), dtype=bool)
        np.logical_or.accumulate(m[1:] != m[:-1], axis=1, out=self.change[1:])
        # the last row of a leaf: the next row neither repeats nor continues it
        self.leaf = np.ones(n, dtype=np.int64)
        if n > 1:
            at = np.maximum(self.lens[:-1] - 1, 0)
            self.leaf[:-1] = self.change[np.arange(1, n), at] & (self.lens[:-1] > 0) if width else 0

    def totals(self) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray], np.ndarray]]:
        """Per depth: the depth, the first rows of its nodes, their totals, and how
        many conversations end in each (they are a node's first rows)."""
        has = np.arange(self.width) < self.lens[:, None]
        starts = self.change & has
        per_row = np.cumsum(self.words[:, ::-1], axis=1)[:, ::-1]
        per_node = np.cumsum((self.words * starts)[:, ::-1], axis=1)[:, ::-1]
        for d in range(self.width + 1):
            bounds = np.flatnonzero(self.change[:, d - 1]) if d else np.array([0])
            add = lambda x: np.add.reduceat(x, bounds)  # noqa: B023, E731
            from_ = max(d, 1) - 1
            saved = add(per_row[:, from_] - per_node[:, from_]) if self.width else np.zeros(1, np.int64)
            got = {"conv_id": np.minimum.reduceat(self.convs, bounds), "n_convs": np.diff(np.append(bounds, self.n)),
                   "n_children": add(starts[:, d].astype(np.int64)) if d < self.width else np.zeros(len(bounds), np.int64),
                   "n_leaves": add(self.leaf), "saved_tokens": saved}
            node = self.lens[bounds] >= d
            yield d, bounds[node], {k: v[node] for k, v in got.items()}, add((self.lens == d).astype(np.int64))[node]


def batch_rows(m: Matrix, task: int, number: int) -> pa.RecordBatch:
    """Finished nodes, partial totals of the nodes at the batch's ends, and the
    conversations that end in these."""
    rows = empty_rows()
    above: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    columns: list[pa.RecordBatch] = []
    for d, at, got, n_ends in m.totals():
        if not len(at):
            break
        side = (at == 0) | (at + got["n_convs"] == m.n)
        parent = np.searchsorted(above[0], at, side="right") - 1 if above else None
        for i in np.flatnonzero(side):
            path = m.first if at[i] == 0 else m.last
            key = node_key(path, d)
            add_row(rows, kind=PART, key=key, parent_key=node_key(path, d - 1) if d else None, depth=d, conv_id=int(got["conv_id"][i]),
                    **{k: int(got[k][i]) for k in TOTALS})
            if n_ends[i]:
                add_row(rows, kind=ENDS, key=key, task=task, batch=number, ends=",".join(map(str, m.convs[at[i]:at[i] + n_ends[i]].tolist())))
        own = np.flatnonzero(~side)
        if len(own):
            p = parent[own]
            open_ = above[2][p]
            keys = {0: node_key(m.first, d - 1), 1: node_key(m.last, d - 1)}
            # of two open parents one holds the first row, the other the last
            parent_key = [keys[int(above[0][q] != 0)] if o else None for q, o in zip(p, open_, strict=True)]
            shas = [hashlib.sha256(",".join(map(str, m.convs[a:a + c].tolist())).encode()).hexdigest() if c else NO_ENDS
                    for a, c in zip(at[own].tolist(), n_ends[own].tolist(), strict=True)]
            given = {"kind": np.full(len(own), NODE, np.int32), "parent_key": parent_key, "depth": np.full(len(own), d), "ends_sha256": shas,
                     "parent_conv_id": pa.array(above[1][p], mask=open_)} | {k: v[own] for k, v in got.items()}
            columns.append(pa.RecordBatch.from_arrays([x if isinstance(x := given.get(f.name), pa.Array) else pa.array(x, type=f.type) if x is not None
                                                       else pa.nulls(len(own), f.type) for f in SCHEMA], schema=SCHEMA))
        above = (at, got["conv_id"], side)
    yield from columns
    yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)


def prefix_trie(seqs: DataFrame, *, batch_cells: int = 1 << 20) -> DataFrame:
    """All nodes of the trie of (conv_id, path, words): (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    A node is named by its least member (``conv_id``) and its depth; the root has
    depth 0 and no parent. ``saved_tokens`` sums (n_convs - 1) times the words of
    its last turn over the subtree; ``ends_sha256`` is the digest of the ids of the
    conversations that end in the node, ascending, joined by commas.

    Empty paths end in the root; equal paths are members of the same nodes; a
    conversation id that occurs in several rows counts as often. An empty table
    gives no node. A batch holds about ``batch_cells`` turns with padding; one
    conversation is held whole.
    """
    spark = seqs.sparkSession
    seqs = materialize(seqs.select("conv_id", "path", "words"), "trie-paths")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        first = last = None
        number = 0
        for paths, words, convs in bounded(parts, batch_cells):
            m = Matrix(paths, words, convs)
            rows = empty_rows()
            if last is None:
                first = (m.first, m.first_words)
            else:
                overlap(rows, last[0], m.first, m.first_words)
            yield from batch_rows(m, task, number)
            yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)
            last = (m.last, m.last_words)
            number += 1
        if last is not None:
            rows = empty_rows()
            for side, (path, words) in enumerate((first, last)):
                add_row(rows, kind=EDGE, task=task, batch=side, path=path, words=words)
            yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)

    found = materialize(seqs.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(run, SPEC), "trie-nodes")

    # neighbouring tasks: one row per task
    edges = found.filter(F.col("kind") == EDGE).groupBy("task").agg(
        F.max(F.when(F.col("batch") == 1, F.col("path"))).alias("last"), F.max(F.when(F.col("batch") == 0, F.col("path"))).alias("first"),
        F.first(F.when(F.col("batch") == 0, F.col("words")), ignorenulls=True).alias("words"))
    order = Window.orderBy("task")
    pairs = edges.select("last", F.lead("first").over(order).alias("after"), F.lead("words").over(order).alias("words")).filter("after is not null")

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            rows = empty_rows()
            for x in b.to_pylist():
                overlap(rows, x["last"], x["after"], x["words"])
            yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)

    sums = [F.sum(c).alias(c) for c in TOTALS]
    parts = found.filter(F.col("kind") == PART).unionByName(pairs.mapInArrow(pair, SPEC))
    parts = parts.groupBy("key").agg(F.first("parent_key", ignorenulls=True).alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums)
    ends = found.filter(F.col("kind") == ENDS).select("key", "task", "batch", "ends")
    ends = ends.repartition("key").sortWithinPartitions("key", "task", "batch").mapInArrow(digests, "key binary, ends_sha256 string")
    shared = materialize(parts.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "trie-shared")

    names = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    cols = ["conv_id", "depth", "parent_conv_id", *TOTALS, "ends_sha256"]
    inner = found.filter(F.col("kind") == NODE)
    below = inner.filter("parent_key is not null").drop("parent_conv_id").join(names, "parent_key").withColumnRenamed("above", "parent_conv_id")
    shared = shared.join(names, "parent_key", "left").withColumnRenamed("above", "parent_conv_id")
    return inner.filter("parent_key is null").select(*cols).unionByName(below.select(*cols)).unionByName(shared.select(*cols))


def bounded(parts: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[list[bytes], list[list[int]], np.ndarray]]:
    """Rows in batches whose padded matrix has at most ``cells`` cells (or one row)."""
    paths: list[bytes] = []
    words: list[list[int]] = []
    convs: list[int] = []
    width = 1
    for part in parts:
        for conv, path, count in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
            wider = max(width, len(path) // ID_BYTES)
            if paths and wider * (len(paths) + 1) > cells:
                yield paths, words, np.array(convs, dtype=np.int64)
                paths, words, convs, wider = [], [], [], max(1, len(path) // ID_BYTES)
            paths.append(path)
            words.append(count)
            convs.append(conv)
            width = wider
    if paths:
        yield paths, words, np.array(convs, dtype=np.int64)


def digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces in order, joined by commas; one piece is held."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    key, state = None, hashlib.sha256()
    for part in parts:
        done: list[list] = [[], []]
        for k, ends in zip(part.column(0).to_pylist(), part.column(3).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    done[0].append(key)
                    done[1].append(state.hexdigest())
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, done, strict=True)), schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [state.hexdigest()]}, schema=schema)
