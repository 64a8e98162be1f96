"""Finding keys that occur at two or more places, safely for very frequent keys.

Map tasks emit (key, place) pairs. Each task first joins what it has itself: of a
key it has seen several times only one row goes to the key's partition, and the
rest, already known to repeat, are spread evenly. So a key that a third of all
rows carry sends one row per map task to the task that owns it.

A row is three longs: ``k`` (the key with its two lowest bits as a flag), ``a``
and ``b``. Flags: 0 the only place in this task, 1 the first of several, 2 a
further one (``b`` then has the first one's ``a`` if ``b`` is free), 3 a row
that is only passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = pa.schema([("k", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
SPEC = "k long, a long, b long"
ONE, FIRST, MORE, PASS = range(4)
MASK = np.int64(~3)


def batch(k: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (k, a, b)], schema=ROW)


def batches(k: np.ndarray, a: np.ndarray, b: np.ndarray, rows: int = 65_536) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(k), rows):
        yield batch(k[at:at + rows], a[at:at + rows], b[at:at + rows])


class Combiner:
    """Collects (key, a, b) arrays of a task; gives rows when ``limit`` is reached.

    With ``pairs`` a place is (a, b), else it is ``a`` alone and further rows get
    the first one's ``a`` as ``b``."""

    def __init__(self, pairs: bool, limit: int = 1 << 20) -> None:
        self.pairs, self.limit = pairs, limit
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
        self.parts.append((k, a, b))
        self.size += len(k)
        return self.size >= self.limit

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        k, a, b = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        k = k & MASK
        order = np.argsort(k, kind="stable")
        k, a, b = k[order], a[order], b[order]
        same = np.concatenate([[False], k[1:] == k[:-1]])
        if same.any():
            many = same | np.concatenate([same[1:], [False]])
            i = np.flatnonzero(many)
            i = i[np.lexsort((b[i], a[i], k[i]))]
            again = np.concatenate([[False], (k[i][1:] == k[i][:-1]) & (a[i][1:] == a[i][:-1]) & (b[i][1:] == b[i][:-1])])
            i = i[~again]
            kk, aa, bb = k[i], a[i], b[i]
            first = np.concatenate([[True], kk[1:] != kk[:-1]])
            count = np.diff(np.concatenate([np.flatnonzero(first), [len(kk)]]))
            flag = np.where(first, np.where(np.repeat(count, count) > 1, FIRST, ONE), MORE)
            if not self.pairs:
                bb = np.where(flag == MORE, np.repeat(aa[first], count), bb)
            one = ~many
            k, a, b = np.concatenate([k[one], kk | flag]), np.concatenate([a[one], aa]), np.concatenate([b[one], bb])
        yield from batches(k, a, b)


def repeated(rows: DataFrame, pairs: bool) -> DataFrame:
    """Rows (k, a, b) of the keys at two or more places, ``k`` without its flag,
    and the passed-through rows with theirs. Without ``pairs``, ``b`` is an ``a``
    of the same key, the same for most of its rows: the key's centre."""
    home = F.when(F.col("k").bitwiseAND(F.lit(3)) >= MORE, F.xxhash64("k", "a", "b")).otherwise(F.col("k").bitwiseAND(F.lit(-4)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for part in chain_none(parts):
            if part is not None:
                k, a, b = (np.asarray(c) for c in part.columns)
                flag = k & 3
                out = flag >= MORE
                if out.any():
                    yield batch(np.where(flag[out] == MORE, k[out] & MASK, k[out]), a[out], b[out])
                held = [np.concatenate([h, x[~out]]) for h, x in zip(held, (k, a, b), strict=True)]
            k, a, b = held
            if not len(k):
                continue
            key = k & MASK
            # the last key may go on in the next batch
            stop = int(np.searchsorted(key, key[-1])) if part is not None else len(key)
            held = [x[stop:] for x in held]
            key, a, b, many = key[:stop], a[:stop], b[:stop], (k[:stop] & 3) == FIRST
            if not stop:
                continue
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.concatenate([begin, [stop]]))
            low, high = np.minimum.reduceat(a, begin), np.maximum.reduceat(a, begin)
            keep = (low < high) | np.logical_or.reduceat(many, begin)
            if pairs:
                keep |= np.minimum.reduceat(b, begin) < np.maximum.reduceat(b, begin)
            rows_kept = np.repeat(keep, count)
            if rows_kept.any():
                centre = np.repeat(low, count)
                yield batch(key[rows_kept], a[rows_kept], (b if pairs else centre)[rows_kept])

    return rows.repartition(home).sortWithinPartitions("k").mapInArrow(run, SPEC)


def chain_none(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from parts
    yield None
