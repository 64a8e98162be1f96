"""Periodic runs of words: stretches that repeat themselves, found exactly.

A run is a stretch of consecutive words with smallest period q, of at least
``max(min_words, 2 * q)`` words, that no neighbouring word extends keeping period
q. Texts stay where they are read; each task takes its texts in batches and works
with arrays over all words of a batch:

1. The suffix array, by prefix doubling of the suffixes that are still tied. Words
   of different texts differ and every text ends in a mark of its own, so no two
   texts share a suffix group. The ranks of every doubling are kept: two equal
   ranks of level k are two equal stretches of ``2**k`` words.
2. LCP values of neighbours, from those ranks.
3. Every LCP boundary of value d parts its LCP interval in two (the child left of
   it, the children right of it). The suffixes i of the smaller part look whether
   the suffix ``i + d`` or ``i - d`` lies in the other part, by its place in the
   inverse suffix array: if so, their common prefix is exactly d words and a
   branching square of period d starts at the earlier one. No tree is built.
4. A square is rotated to the left as far as the period holds, which gives a run;
   squares whose period is a multiple give the same stretch and are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.arrow_rows import text_slices

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
SPEC = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def doubled_ranks(s: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes of ``s`` by their first 1, 2, 4, ... symbols, up to the
    level where all differ (the inverse suffix array). The rank of a tied group is
    its first place in the suffix array. Every stretch that occurs twice must be
    followed by a symbol (the marks at the texts' ends see to it)."""
    count = np.bincount(s)
    rank = (np.cumsum(count) - count)[s].astype(np.int32)
    levels, width = [rank], 1
    tied = np.flatnonzero(count[s] > 1)
    while len(tied):
        old = rank[tied]
        key = old.astype(np.int64) << 32 | rank[tied + width]
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        old = (key >> 32).astype(np.int32)
        at = np.arange(len(tied), dtype=np.int32)
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(fresh, at, 0))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        rank = rank.copy()
        rank[tied] = old + start - group
        levels.append(rank)
        alone = fresh & np.concatenate([fresh[1:], [True]])
        tied = tied[~alone]
        width *= 2
    return levels


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes a and b (pairwise, a != b)."""
    out = np.zeros(len(a), dtype=np.int32)
    for k in range(len(levels) - 1, -1, -1):
        r = levels[k]
        out += (r[a + out] == r[b + out]).astype(np.int32) << k
    return out


def common_suffix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols before a equal those before b (pairwise, a < b)."""
    out = np.zeros(len(a), dtype=np.int32)
    for k in range(len(levels) - 1, -1, -1):
        r, x, y = levels[k], a - out - (1 << k), b - out - (1 << k)
        same = x >= 0
        same[same] = r[x[same]] == r[y[same]]
        out += same.astype(np.int32) << k
    return out


class Minima:
    """Nearest smaller values, by minima over stretches of 1, 2, 4, ... places."""

    def __init__(self, v: np.ndarray) -> None:
        self.v, self.tables = v, [v]

    def table(self, k: int) -> np.ndarray:
        while len(self.tables) <= k:
            t, w = self.tables[-1], 1 << (len(self.tables) - 1)
            t2 = t.copy()
            t2[:-w] = np.minimum(t[:-w], t[w:])
            t2[len(t2) - w:] = -1  # past the end: smaller than all
            self.tables.append(t2)
        return self.tables[k]

    def next_below(self, at: np.ndarray) -> np.ndarray:
        """Per place k the next one whose value is under v[k]."""
        return self._next(at, self.v[at])

    def _next(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        out, live, k, pos = at + 1, np.arange(len(at)), 0, at + 1
        # gallop while whole stretches hold no smaller value, then descend
        levels = []
        while len(live):
            ok = self.table(k)[pos] >= least[live]
            out[live[~ok]] = pos[~ok]
            levels.append(live[~ok])
            live, pos = live[ok], pos[ok] + (1 << k)
            k += 1
        for j in range(len(levels) - 1, 0, -1):
            # those that stopped at level j have less than 2**j places to go
            rest = np.concatenate(levels[j:]) if j < len(levels) - 1 else levels[j]
            t = self.table(j - 1)
            ok = t[out[rest]] >= least[rest]
            out[rest[ok]] += 1 << (j - 1)
        return out


def squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all branching squares: two equal stretches of ``period``
    symbols side by side that the following symbol does not continue."""
    isa = levels[-1]
    n = len(isa)
    sa = np.empty(n, dtype=np.int32)
    sa[isa] = np.arange(n, dtype=np.int32)
    lcp = np.zeros(n + 1, dtype=np.int32)
    near = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    lcp[near] = common_prefix(levels[:-1], sa[near - 1], sa[near])
    k = near
    d = lcp[k]
    high = Minima(lcp).next_below(k)
    # mirrored: the previous place whose value is at most v[k]
    back = Minima(lcp[::-1].copy())
    low = n - back._next(n - k, d + 1)
    left = k - low <= high - k
    begin, size = np.where(left, low, k), np.where(left, k - low, high - k)
    far_low, far_high = np.where(left, k, low), np.where(left, high, k)
    found = []
    ends = np.cumsum(size)
    at = 0
    while at < len(k):  # in portions of bounded size
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
        each = np.repeat(np.arange(at, to), size[at:to])
        first = ends[at:to] - size[at:to]
        place = np.arange(len(each)) + (ends[at - 1] if at else 0)
        i = sa[begin[each] + place - first[each - at]].astype(np.int64)
        step = d[each]
        there = isa[i + step]
        hit = (there >= far_low[each]) & (there < far_high[each])
        found.append((i[hit], step[hit]))
        back_i = i - step
        ok = back_i >= 0
        there = isa[np.where(ok, back_i, 0)]
        hit = ok & (there >= far_low[each]) & (there < far_high[each])
        found.append((back_i[hit], step[hit]))
        at = to
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]).astype(np.int64)


def runs_of(s: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in ``s``, by start, then period."""
    none = (np.empty(0, np.int64),) * 3
    if not len(s):
        return none
    levels = doubled_ranks(s)
    if len(levels) == 1:
        return none
    i, period = squares(levels)
    start = i - common_suffix(levels[:-1], i, i + period)
    end = i + 2 * period
    long = end - start >= min_words
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    same = np.concatenate([[False], (start[1:] == start[:-1]) & (end[1:] == end[:-1])])[:len(start)]
    start, end, period = start[~same], end[~same], period[~same]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def symbols(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of several texts end to end, each text with its own
    numbers and a closing mark, and the texts' offsets."""
    out, offsets, used = [], [0], 0
    for words in texts:
        number = {w: used + i for i, w in enumerate(dict.fromkeys(words))}
        out += map(number.__getitem__, words)
        used += len(number)
        out.append(used)
        used += 1
        offsets.append(len(out))
    return np.array(out, dtype=np.int64), np.array(offsets, dtype=np.int64)


def batch_of(ids: list, texts: list[list[bytes]], min_words: int) -> pa.RecordBatch:
    s, offsets = symbols(texts)
    start, end, period = runs_of(s, min_words)
    ends = np.searchsorted(start, offsets[1:])
    begins = np.concatenate([[0], ends[:-1]])
    own = start - np.repeat(offsets[:-1], ends - begins)
    length = end - start
    collapsed = []
    for j, words in enumerate(texts):
        a, b = begins[j], ends[j]
        if a < b:
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(gone, own[a:b] + period[a:b], 1)
            np.add.at(gone, own[a:b] + length[a:b], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
        collapsed.append(b" ".join(words))
    runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(own), pa.array(length), pa.array(period)], fields=list(RUN)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), runs,
                                       pa.array(collapsed, pa.binary()).cast(pa.string())], schema=OUT)


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 12, batch_words: int = 1 << 17) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    ``runs`` is an array of (start, length, period) in words, by start, then
    period; ``collapsed`` are the words that stay when of every run only its first
    period is kept, joined by one space. Words are runs of characters other than
    space and \\t-\\r.

    Null and empty texts, and texts of white space, have no words, no runs and an
    empty collapsed text. Ids may repeat or be null: rows are worked on one by one.
    A text is held whole, with about 4 bytes a word for each doubling of its
    longest repeated passage; shorter ones share batches of ``batch_words``. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(parts, "text", 8 * batch_words):
            texts = [(t or b"").split() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield batch_of(b.column(0).to_pylist(), texts, min_words)

    return rows.mapInArrow(run, SPEC)
