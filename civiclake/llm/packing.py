"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents are tokenised where they are read; texts are never shuffled. Documents
longer than a sequence are cut, and their full pieces are sequences already. The
rest, a row of a few numbers each, is dealt at random over shards of a bounded
number of pieces, and every shard packs its pieces one by one: a piece goes into
the open sequence (or a new one) that makes the sum of squared counts of open
sequences per residual gap smallest, the smallest gap at a tie. A shard first
places its larger pieces by size and then the smallest fifth in random order,
which fill what is left.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.llm.arrow_rows import table_batch, text_slices
from civiclake.session import materialize

END_OF_TEXT = "<|endoftext|>"
LONG_BLANK = re.compile(r"\s{50000}")
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to uint32 ids. A ``.tiktoken`` file is read as byte-level BPE ranks
    (several times faster than, and equal to, the same vocabulary's ``.json``);
    any other file by the tokenizers library. Texts that the ranks' pattern cannot
    split (it runs out of stack on very long runs of white space) go by the ``.json``."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})

        slow: list[Callable[[str], np.ndarray]] = []

        def by_ranks(text: str) -> np.ndarray:
            if not LONG_BLANK.search(text):
                try:
                    if END_OF_TEXT in text:
                        return np.asarray(enc.encode(text, allowed_special="all"), dtype="<u4")
                    return np.asarray(enc.encode_ordinary(text), dtype="<u4")
                except BaseException as e:  # noqa: BLE001 - a panic of the library is no Exception
                    if type(e).__name__ != "PanicException":
                        raise
            if not slow:
                slow.append(by_library(path.removesuffix(".tiktoken") + ".json"))
            return slow[0](text)

        return by_ranks
    return by_library(path)


def by_library(path: str) -> Callable[[str], np.ndarray]:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return lambda text: np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of ``capacity`` but the first."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")
        for b in text_slices(batches, "text"):
            rows: list[list] = [[], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.concatenate([encode(text or ""), end])
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for out, v in zip(rows, (doc, k, start, length, ids[start:start + length].tobytes()), strict=True):
                        out.append(v)
            yield table_batch(PIECES, rows)

    spec = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, spec)


class SumOfSquares:
    """Open sequences of one shard. ``counts[g]``: open sequences with gap g."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """Sequence number and offset for a piece of ``size`` tokens."""
        cap, n = self.capacity, self.counts
        gaps = n[size:cap]
        best, at = 1 + 2 * int(n[cap - size]) if size < cap else 0, -1
        if len(gaps):
            change = 2 * (n[:cap - size] - gaps) + 2
            change[0] = 1 - 2 * gaps[0]
            change[gaps == 0] = np.iinfo(np.int64).max
            j = int(change.argmin())
            if change[j] <= best:
                at = j + size
        if at < 0:
            at, bin_id = cap, self.made
            self.made += 1
        else:
            n[at] -= 1
            bin_id = self.open[at].pop()
        left = at - size
        if left:
            n[left] += 1
            self.open[left].append(bin_id)
        return bin_id, cap - at


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         keep: dict[str, Column] | None = None, shard_pieces: int = 32_768) -> DataFrame:
    """Pack all documents; one row per piece: (doc_id, piece, start, length,
    *keep, sequence_id, offset).

    A document is its token ids and then ``end_id``. ``keep`` names columns to
    derive from a piece's ``ids`` (little-endian unsigned 32-bit); by default the
    ids themselves, so a sequence is its pieces' ids in offset order. A shard
    holds about ``shard_pieces`` pieces; one shard leaves some tens of sequences
    unfilled, whatever the input's size.

    Null or empty text is the end id alone. Null and repeated ids are allowed:
    rows are packed one by one. Very long texts are cut, never shortened. An
    empty table gives an empty result; other columns are ignored.
    """
    keep = {"ids": F.col("ids")} if keep is None else keep
    pieces = tokenised_pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    named = [c.alias(k) for k, c in keep.items()]
    pieces = materialize(pieces.select(F.monotonically_increasing_id().alias("row"), "doc_id", "piece", "start", "length", *named), "pack-pieces")

    full = F.col("length") == capacity
    stats = pieces.filter(~full).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("length", 0.2).alias("small")).first()
    shards = max(1, -(-stats["n"] // shard_pieces))
    small = stats["small"] or 0
    mixed = F.xxhash64("row")
    rest = pieces.filter(~full).select("row", "length", F.pmod(mixed, F.lit(shards)).alias("shard"),
                                       F.when(F.col("length") > small, -F.col("length")).otherwise(F.abs(F.shiftright(mixed, 1))).alias("turn"))
    out = pa.schema([("row", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bins = -1, SumOfSquares(capacity)
        for b in batches:
            seq, off = [], []
            for size, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if s != shard:
                    shard, bins = s, SumOfSquares(capacity)
                bin_id, at = bins.place(size)
                seq.append((shard << 32) + bin_id)
                off.append(at)
            yield table_batch(out, [b.column(0), seq, off])

    placed = (rest.repartition(shards, "shard").sortWithinPartitions("shard", "turn", "row")
              .mapInArrow(run, "row long, sequence_id long, offset long"))
    cols = ["doc_id", "piece", "start", "length", *keep]
    alone = pieces.filter(full).select(*cols, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    joined = pieces.filter(~full).join(placed, "row").select(*cols, "sequence_id", "offset")
    return alone.unionByName(joined)
