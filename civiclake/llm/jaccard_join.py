"""Exact n-gram Jaccard join by regions, pivots, windows and recursion.

Two linked sets A and B differ in at most ``(den - num) / (den + num)`` of their
sizes' sum. Sampled pivots do not divide a whole corpus by the Jaccard distance:
unrelated documents are at distance 1 from every pivot. Regions are therefore cut
first by coordinates that linked documents must share, and pivots work inside them:

1. A document's shingles are dealt over m buckets by hash, m depending only on
   its size class. Linked documents differ in at most ``m - 1 - slack`` shingles,
   so some bucket holds the same shingles in both. Class, bucket and contents are
   a region; documents at a class border are replicated into the next one. A document
   that shares fewer buckets than a link takes is linked with nothing.
2. The pivot of a region is the document that shares most of its buckets: among
   copies of one text that is the text itself. Every document meets the pivots of
   its regions; each comparison gives a link or not, and the size of the difference.
3. The documents that meet a pivot are its cell; linked documents share one. Cells that
   still hold several groups go on. With pivot h, a = |A^h| and
   b = |B^h| (^ for the symmetric difference), |A^B| = a + b - 2 |A^h & B^h|: the
   triangle inequality, made sharper by what the last term can be at most: shingles that
   A or B has alone among the undecided are not in it, and of the rest no more than the
   two differences have in common when counted in ``PARTS`` parts by hash. Documents that this window and the
   sizes part from all of a cell leave it; the rest of the smaller groups become
   pivots, a bounded number a round, and meet their window. A pivot that has met its
   cell leaves it, so this ends with every cell decided.
4. Of the pairs that windows leave, all but the first of a document meet as sketches
   before they meet as sets: a set's shingles are counted in about as many parts as it
   has shingles, and one bit a part says whether the count is odd. Every bit in which
   two sketches differ is a shingle of the difference, so pairs with too many of them
   are parted. The sets of the others are sent in rounds, none of which sends much more
   than the sets themselves take.

Equal shingle sets are one node from the start, and pairs already in one
component are not compared: only components are asked for. Sets are compared by
64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm import bloom, shingles
from civiclake.llm.arrow_rows import table_batch, text_slices, utf8_parts
from civiclake.llm.components import components, extended
from civiclake.llm.key_runs import MASK, PASS, SPEC, Combiner, batches, repeated
from civiclake.session import dropped, materialize

#: further pivots of a cell in the first round; four times as many in each next one
PIVOTS = 512
#: documents that are sent to one copy of a pivot
MEMBERS = 256
#: parts of a difference that are counted
PARTS = 128
BITS = 28
#: bytes of sets that a round of comparisons may send even if all sets together are smaller
SENT = 1 << 26


class Regions:
    """Region keys of a shingle set for Jaccard >= num / den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.low = [1, 2]  # least size of each class

    def _grow(self, size: int) -> None:
        while self.low[-1] <= size * self.den // self.num + 1:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * 3 // 2))

    def classes(self, n: int) -> list[int]:
        """The class of n, and the class below if a linked smaller set can be in it."""
        self._grow(n)
        c = int(np.searchsorted(self.low, n, side="right")) - 1
        below = c > 0 and self.den * (self.low[c] - 1) >= self.num * n
        return [c - 1, c] if below else [c]

    def shape(self, c: int) -> tuple[int, int]:
        """(buckets, slack). Sets linked with one of at most ``high`` shingles as
        the smaller differ in at most ``differ`` shingles; ``slack`` more buckets
        than needed allow for that many empty ones: as many as the class's smallest
        sets have, by three deviations, else the sets keep their empty buckets
        as regions, and unrelated sets of the class share those."""
        high = self.low[c + 1] - 1
        differ = (self.den - self.num) * (high + self.den * high // self.num) // (self.den + self.num)
        slack = math.ceil(0.03 * differ + 2 * math.sqrt(0.03 * differ)) + 1 if differ else 0
        while differ and slack < differ:
            m = differ + 1 + slack
            share = math.exp(-self.low[c] / m)
            if slack >= m * share + 3 * math.sqrt(m * share * (1 - (1 + self.low[c] / m) * share)):
                break
            slack += 1
        return differ + 1 + slack, slack

    def keys(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """Region keys, and how many of them a linked set has too at least."""
        out, need = [], []
        for c in self.classes(len(s)):
            m, slack = self.shape(c)
            at = ((s >> np.uint64(40)) % np.uint64(m)).astype(np.int64)
            count = np.bincount(at, minlength=m)
            # sums of 26-bit parts are exact in double precision
            one = np.bincount(at, weights=s & np.uint64((1 << 26) - 1), minlength=m).astype(np.uint64)
            two = np.bincount(at, weights=(s >> np.uint64(26)) & np.uint64((1 << 26) - 1), minlength=m).astype(np.uint64)
            where = np.arange(m, dtype=np.uint64) + np.uint64(c << 40)
            k = shingles.mixed(shingles.mixed(one + two * np.uint64(0x9E3779B97F4A7C15)) + shingles.mixed(where) + count.astype(np.uint64))
            filled = count > 0
            # with more empty buckets than the slack, an empty one may be all that two sets share
            empty = m - int(filled.sum())
            out.append(k if empty > slack else k[filled])
            need.append(1 if empty > slack else 1 + slack - empty)
        return np.concatenate(out).view(np.int64), min(need)


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> tuple[bool, int]:
    """Whether two sets are linked, and the size of their difference."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return den * both >= num * union, union - both


def parted(a: np.ndarray, b: np.ndarray) -> list[int] | None:
    """How many shingles of the difference of two sets lie in each part; None if a
    part is too large to be counted."""
    counts = np.bincount((np.setxor1d(a, b, assume_unique=True) >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64), minlength=PARTS)
    return counts.tolist() if counts.max() < 1 << 15 else None


def scan(docs: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int) -> DataFrame:
    """Regions with two or more nodes, as (k, a: node, b), and two passed-through
    rows per document: its node, with doc id or text hash; ``k`` has the set's size
    or the numbers of its regions and of those that a link takes."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a smaller limit than elsewhere: sorting a full one takes several times its size
        regions, combine = Regions(num, den), Combiner(pairs=False, limit=1 << 18)
        for b in text_slices(parts, "text", 1 << 18):
            raw, offsets = utf8_parts(b.column(1))
            h, _, _, at = shingles.words(raw, offsets, lower=True)
            info = np.empty((3, 2 * len(b)), dtype=np.int64)
            ids = b.column(0).to_pylist()
            for i, text_hash in enumerate(b.column(2).to_pylist()):
                s = shingles.shingle_set(h[at[i]:at[i + 1]], n)
                node = shingles.set_hash(s, n)
                doc = ids[i]
                # pass-through rows: size, is-null bit, which-row bit, flag
                info[:, 2 * i] = (len(s) << 4 | (doc is None) << 3 | PASS, node, 0 if doc is None else doc)
                info[:, 2 * i + 1] = (4 | PASS, node, text_hash)
                if len(s):
                    k, need = regions.keys(s)
                    info[0, 2 * i + 1] |= (len(k) << BITS | need) << 4
                    if combine.add(k, np.full(len(k), node), np.zeros(len(k), np.int64)):
                        yield from combine.rows()
            yield from batches(*info)
        yield from combine.rows()

    return repeated(rows.mapInArrow(run, SPEC), pairs=False)


def sets_of(docs: DataFrame, text_col: str, n: int, wanted: DataFrame, bits: int) -> DataFrame:
    """(node, shingles) of the texts whose hash is in ``wanted``, and of a few
    others that the filter lets through."""
    words = bloom.build(wanted, bits)
    rows = docs.select(F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for part in parts:
            some = part.filter(pa.array(bloom.passes(words, np.asarray(part.column(1)))))
            for b in text_slices(iter([some]), "text", 1 << 18) if len(some) else ():
                h, _, _, at = shingles.words(*utf8_parts(b.column(0)), lower=True)
                nodes, sets = [], []
                for i in range(len(b)):
                    s = shingles.shingle_set(h[at[i]:at[i + 1]], n)
                    node = shingles.set_hash(s, n)
                    if len(s) and node not in sent:
                        nodes.append(node)
                        sets.append(s.tobytes())
                        if len(sent) < 1 << 20:
                            sent.add(node)
                yield table_batch(schema, [nodes, sets])

    return rows.mapInArrow(run, "node long, shingles binary").groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def sketch(s: np.ndarray) -> np.ndarray:
    """The size of a set, and a bit for each of its parts (a power of two, no fewer than
    its shingles): whether the part has an odd number of shingles."""
    m = max(64, 1 << (len(s) - 1).bit_length())
    odd = np.bincount(((s >> np.uint64(20)) & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.concatenate([np.array([len(s)], np.uint64), np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)])


def may_meet(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sketches leave room for a link: each bit in which they differ is a
    shingle of the difference. The finer one is folded to the parts of the other."""
    size = int(x[0]) + int(y[0])
    x, y = sorted((x[1:], y[1:]), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return (den + num) * int(np.bitwise_count(x ^ y).sum()) <= (den - num) * size


def sketches_of(sets: DataFrame) -> DataFrame:
    """(node, sketch) of (node, shingles)."""
    schema = pa.schema([("node", pa.int64()), ("sketch", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts:
            yield table_batch(schema, [p.column(0), [sketch(np.frombuffer(s.as_buffer(), np.uint64)).tobytes() for s in p.column(1)]])

    return sets.select("node", "shingles").mapInArrow(run, "node long, sketch binary")


def dealt(pairs: DataFrame) -> DataFrame:
    """(a, b, copy) of the node pairs (a, b), b being the pivot: no copy of it has
    many more than ``MEMBERS`` of its a."""
    total = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("copies"))
    # written, so that a join sees how small it is before it moves the sets
    return materialize(pairs.join(total, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("copies")).alias("copy")), "jaccard-dealt")


def met(some: DataFrame, values: DataFrame) -> DataFrame:
    """(b, copy, a, value) of dealt pairs and of (node, value): each copy of a pivot in
    one task, first its own value (a null), then those of its a."""
    node, value = values.columns
    members = some.join(values.withColumnRenamed(node, "a"), "a").select("b", "copy", "a", value)
    tops = some.select("b", "copy").distinct().join(values.withColumnRenamed(node, "b"), "b")
    rows = members.unionByName(tops.select("b", "copy", F.lit(None).cast("long").alias("a"), value))
    return rows.repartition("b", "copy").sortWithinPartitions("b", "copy", F.col("a").asc_nulls_first())


def in_rounds(some: DataFrame, sizes: DataFrame, unit: float, most: int) -> list[DataFrame]:
    """Dealt pairs in parts of which each sends about ``most`` bytes of values, which
    have ``unit`` bytes a shingle."""
    sent = some.join(sizes, F.col("a") == F.col("node")).agg(F.sum("n")).first()[0] or 0
    rounds = max(1, math.ceil(sent * unit / most))
    return [some.filter(F.pmod(F.xxhash64("b", "copy"), F.lit(rounds)) == i) for i in range(rounds)]


def sifted(pairs: DataFrame, sketches: DataFrame, sizes: DataFrame, num: int, den: int, most: int) -> DataFrame:
    """(a, b, near) of the node pairs (a, b): whether their sketches leave room for a link."""
    some = dealt(pairs)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.empty(0, np.uint64)
        for p in parts:
            out: list[list] = [[], [], []]
            for b, a, s in zip(p.column(0).to_pylist(), p.column(2).to_pylist(), p.column(3), strict=True):
                x = np.frombuffer(s.as_buffer(), np.uint64)
                if a is None:
                    top = x.copy()
                    continue
                for column, v in zip(out, (a, b, may_meet(x, top, num, den)), strict=True):
                    column.append(v)
            yield table_batch(schema, out)

    found = [materialize(met(r, sketches).mapInArrow(run, "a long, b long, near boolean"), "jaccard-sifted") for r in in_rounds(some, sizes, 0.25, most)]
    dropped(some)
    return reduce(DataFrame.unionByName, found)


def compare(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, num: int, den: int, most: int) -> DataFrame:
    """(a, b, linked, delta, parts) of the node pairs (a, b), b being the pivot: its
    set is sent once for every ``MEMBERS`` of its a."""
    some = dealt(pairs)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("delta", pa.int64()), ("parts", pa.list_(pa.int16()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.empty(0, np.uint64)
        for p in parts:
            out: list[list] = [[], [], [], [], []]
            for b, a, s in zip(p.column(0).to_pylist(), p.column(2).to_pylist(), p.column(3), strict=True):
                x = np.frombuffer(s.as_buffer(), np.uint64)
                if a is None:
                    top = x.copy()
                    continue
                for column, v in zip(out, (a, b, *linked(x, top, num, den), parted(x, top)), strict=True):
                    column.append(v)
            yield table_batch(schema, out)

    found = [materialize(met(r, sets).mapInArrow(run, "a long, b long, linked boolean, delta long, parts array<smallint>"), "jaccard-compared")
             for r in in_rounds(some, sizes, 8, most)]
    dropped(some)
    return reduce(DataFrame.unionByName, found)


def compare_near(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, sizes: DataFrame, num: int, den: int, most: int) -> DataFrame:
    """``compare`` of the pairs whose sketches leave room for a link; of the others it
    is told that they are not linked, and no difference."""
    seen = sifted(pairs, sketches, sizes, num, den, most)
    new = compare(seen.filter("near").select("a", "b"), sets, sizes, num, den, most)
    far = seen.filter(~F.col("near")).select("a", "b", F.lit(False).alias("linked"), F.lit(None).cast("long").alias("delta"),
                                             F.lit(None).cast("array<smallint>").alias("parts"))
    return new.unionByName(far)


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, num: int = 85, den: int = 100,
         filter_bits: int = 1 << 24) -> DataFrame:
    """(doc_id, n_shingles, node, component_id), one row per row of ``docs``.

    Documents link when ``den * |intersection| >= num * |union|`` of their sets of
    distinct ``words``-word shingles (A-Z lower-cased; a shorter text is one
    shingle as a whole). ``component_id`` is the least doc id reachable over
    links, itself included (null ids: last). Null texts and texts without words
    have no shingles and link with nothing. Repeated rows have equal sets and
    link; an empty table gives an empty result; other columns are ignored.
    """
    found = materialize(scan(docs, id_col, text_col, words, num, den), "jaccard-regions")
    flag = F.col("k").bitwiseAND(F.lit(3))
    info = found.filter(flag == PASS)
    second = F.col("k").bitwiseAND(F.lit(4)) != 0
    rows = info.filter(~second).select(F.when(F.col("k").bitwiseAND(F.lit(8)) == 0, F.col("b")).alias("doc_id"),
                                       F.shiftright("k", 4).alias("n_shingles"), F.col("a").alias("node"))
    known = info.filter(second).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("h"), F.max(F.shiftright("k", 4)).alias("k"))
    sizes = rows.groupBy("node").agg(F.max("n_shingles").alias("n"))
    regions = found.filter(flag == 0).select(F.col("k").alias("region"), F.col("a").alias("node"))
    members = placed(regions, known, sizes)

    near = den * F.least("n", "pivot_n") >= num * F.greatest("n", "pivot_n")
    stars = members.filter("node <> pivot").filter(near).groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    stars = materialize(stars, "jaccard-stars")
    texts = known.join(members.select("node").distinct(), "node", "left_semi").select("h")
    sets = materialize(sets_of(docs, text_col, words, texts, filter_bits), "jaccard-sets")
    sketches = materialize(sketches_of(sets), "jaccard-sketches")
    sizes = materialize(sizes.join(sketches.select("node"), "node", "left_semi"), "jaccard-sizes")
    most = max(SENT, 8 * (sizes.agg(F.sum("n")).first()[0] or 0))

    # the pivot a node shares most regions with first, then those still apart
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    tried = compare(materialize(best, "jaccard-best"), sets, sizes, num, den, most)
    homes = tried.select(F.col("a").alias("node"), F.col("b").alias("home"), F.col("delta").alias("home_delta"), F.col("parts").alias("home_parts"))
    roots = components(tried.filter("linked").select("a", "b"))
    done = tried.select("a", "b").union(tried.select("b", "a"))
    rest = within(apart(stars.select("a", "b").join(done, ["a", "b"], "left_anti"), roots), homes, sizes, num, den)
    more = compare_near(materialize(rest, "jaccard-rest"), sets, sketches, sizes, num, den, most)
    if not more.filter("linked").isEmpty():
        roots = extended(roots, more.filter("linked").select("a", "b"))
    tried = tried.unionByName(more)

    pivots = PIVOTS
    live = divided(members.select("pivot", "node").distinct(), roots)
    while not live.isEmpty():
        seen = live.select("node").union(live.select("pivot")).distinct()
        own = lonely(sets.join(seen, "node", "left_semi"))
        told = tried.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "delta", "parts")
        facts = live.join(own, "node", "left").join(told, ["node", "pivot"], "left").join(homes, "node", "left").join(sizes, "node").select(
            "node", "pivot", "root", "n", F.coalesce("own", F.lit(0)).alias("own"),
            F.when(F.col("node") == F.col("pivot"), F.lit(0)).otherwise(F.col("delta")).alias("delta"), "parts",
            "home", "home_delta", "home_parts")
        open_ = materialize(undecided(materialize(facts, "jaccard-facts"), num, den), "jaccard-open")
        turns = materialize(outsiders(open_), "jaccard-pivots")
        further = turns.filter(F.col("turn") <= pivots)
        todo = materialize(spokes(open_, further, tried, num, den), "jaccard-spokes")
        new = compare_near(todo, sets, sketches, sizes, num, den, most)
        if not new.filter("linked").isEmpty():
            roots = extended(roots, new.filter("linked").select("a", "b"))
        tried = tried.unionByName(new)
        # a pivot has met its whole cell and leaves it; a cell without further ones is decided
        more_to_come = turns.filter(F.col("turn") > pivots).select("pivot").distinct()
        if more_to_come.isEmpty():
            break
        left = open_.join(more_to_come, "pivot", "left_semi").join(further.select("pivot", "node"), ["pivot", "node"], "left_anti")
        live = divided(left.select("pivot", "node"), roots)
        pivots *= 4
    for table in (members, stars, sets, sketches, sizes):
        dropped(table)

    out = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = out.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    alone = F.col("n_shingles") == 0
    return out.join(least, "root", "left").select("doc_id", "n_shingles", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    both = pairs.join(ra, "a", "left").join(rb, "b", "left")
    return both.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def placed(regions: DataFrame, known: DataFrame, sizes: DataFrame) -> DataFrame:
    """(region, node, n, pivot, pivot_n) of the nodes that share as many regions as a
    link takes, in regions with two of them or more. Where a link takes t regions, the
    rarest region that two linked nodes share is not among the t - 1 most frequent ones
    of either, which it leaves. The pivot of a region is the node with the largest part
    of its own regions shared."""
    regions = regions.distinct()  # copies come from several tasks
    shared = regions.groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    all_, need = F.shiftright("k", BITS), F.col("k").bitwiseAND(F.lit((1 << BITS) - 1))
    able = shared.join(known, "node").filter(F.col("shared") >= need).join(sizes, "node").select("node", "n", need.alias("need"), (F.col("shared") / all_).alias("part"))
    rows = materialize(regions.join(able, "node"), "jaccard-rows")
    count = rows.groupBy("region").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    often = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("c"), "region"))
    rare = rows.join(count, "region").withColumn("often", often).filter(F.col("often") >= F.col("need")).drop("c", "often", "need")
    rare = materialize(rare, "jaccard-rare")
    dropped(rows)
    top = rare.groupBy("region").agg(F.max(F.struct("part", "node", "n")).alias("top"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    out = rare.join(top, "region").select("region", "node", "n", F.col("top.node").alias("pivot"), F.col("top.n").alias("pivot_n"))
    out = materialize(out, "jaccard-members")
    dropped(rare)
    return out


def divided(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """(pivot, node, root) of the cells with several components."""
    rows = materialize(cells.join(roots, "node", "left").select("pivot", "node", F.coalesce("root", "node").alias("root")), "jaccard-rows")
    open_ = rows.groupBy("pivot").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("pivot")
    return materialize(rows.join(open_, "pivot"), "jaccard-live")


def undecided(facts: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``facts`` that may have a link inside their cell.

    Whatever the partner B, |A^B| is at least A's own shingles, and with the pivot's
    differences at least ``a - max(b - 2 * own_B)`` over the cell."""
    per = facts.groupBy("pivot").agg(F.max("n").alias("n_max"), F.max(F.col("delta") - 2 * F.col("own")).alias("slack"),
                                     (F.count("delta") == F.count(F.lit(1))).alias("all_told"))
    largest = F.least(F.col("n_max"), F.floor(F.col("n") * den / num))
    limit = (den - num) * (F.col("n") + largest)
    room = (den + num) * F.col("own") <= limit
    window = ~F.col("all_told") | ((den + num) * (F.col("delta") - F.col("slack")) <= limit)
    return facts.join(per, "pivot").filter(room & window).select(*facts.columns)


def outsiders(open_: DataFrame) -> DataFrame:
    """(*open_, turn): the nodes of each cell that are not in its largest component,
    those with the fewest own shingles first."""
    count = open_.groupBy("pivot", "root").agg(F.count(F.lit(1)).alias("c"))
    main = count.groupBy("pivot").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    out = open_.join(main, "pivot").filter("root <> main").select(*open_.columns)
    return out.withColumn("turn", F.row_number().over(Window.partitionBy("pivot").orderBy(F.col("own") / F.col("n"), F.xxhash64("node"))))


def lonely(sets: DataFrame) -> DataFrame:
    """(node, own): how many shingles of a node are in no other node's set."""
    schema = pa.schema([("shingle", pa.int64()), ("node", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts:
            for node, s in zip(p.column(0).to_pylist(), p.column(1), strict=True):
                x = np.frombuffer(s.as_buffer(), np.int64)
                yield table_batch(schema, [x, np.full(len(x), node)])

    count = sets.select("node", "shingles").mapInArrow(run, "shingle long, node long").groupBy("shingle").agg(
        F.count(F.lit(1)).alias("c"), F.min("node").alias("node"))
    return count.filter("c = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def may_link(delta: str, parts: str, limit: Column, num: int, den: int, other: str = "p_") -> Column:
    """Whether two differences from one pivot can have enough in common for a link;
    true if they are unknown."""
    common = F.aggregate(F.zip_with(parts, other + parts, lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return F.coalesce((den + num) * (F.col(delta) + F.col(other + delta) - 2 * common) <= limit, F.lit(True))


def within(pairs: DataFrame, homes: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that the pivot which both met first does not part."""
    facts = sizes.join(homes, "node", "left")
    left = facts.withColumnRenamed("node", "a")
    right = facts.select(F.col("node").alias("b"), *[F.col(c).alias(f"p_{c}") for c in facts.columns if c != "node"])
    limit = (den - num) * (F.col("n") + F.col("p_n"))
    at_home = F.when(F.col("home") == F.col("p_home"), may_link("home_delta", "home_parts", limit, num, den)).otherwise(F.lit(True))
    return pairs.join(left, "a").join(right, "b").filter(at_home).select("a", "b")


def spokes(open_: DataFrame, further: DataFrame, tried: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of a node and a further pivot of its cell that are in different
    components, have not been compared, and may be linked: their sizes, their own
    shingles and their differences from the cell's pivot, or from a pivot that both
    have met first (``home``), leave room."""
    p = further.select("pivot", *[F.col(c).alias(f"p_{c}") for c in ("node", "root", "n", "own", "delta", "parts", "home", "home_delta", "home_parts")])
    limit = (den - num) * (F.col("n") + F.col("p_n"))
    room = (den + num) * (F.col("own") + F.col("p_own")) <= limit
    near = den * F.least("n", "p_n") >= num * F.greatest("n", "p_n")

    both = F.col("delta") + F.col("p_delta")
    window = F.coalesce((den + num) * (both - 2 * F.least(F.col("delta") - F.col("own"), F.col("p_delta") - F.col("p_own"))) <= limit, F.lit(True))
    at_home = F.when(F.col("home") == F.col("p_home"), may_link("home_delta", "home_parts", limit, num, den)).otherwise(F.lit(True))
    rows = open_.join(p, "pivot").filter("root <> p_root").filter(near & room & window & may_link("delta", "parts", limit, num, den) & at_home)
    pairs = rows.select(F.col("node").alias("a"), F.col("p_node").alias("b")).distinct()
    # two pivots may have found each other
    one = pairs.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.max(F.struct("a", "b")).alias("ab")).select("ab.*")
    done = tried.select("a", "b").union(tried.select("b", "a"))
    return one.join(done, ["a", "b"], "left_anti")
