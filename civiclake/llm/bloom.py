"""A Bloom filter over 64-bit hashes with a fixed number of bits, built by Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: which bits of a hash name its places (the two lowest may be in use as flags)
SHIFTS = (2, 21, 40)


def build(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter's 64-bit words of a column of hashes. ``bits`` (a power of two,
    at most 2**24 places per shift) bounds what the driver receives and tasks are
    sent, whatever the number of values; a full filter lets everything through,
    which costs time and loses nothing."""
    c = F.col(hashes.columns[0])
    spots = [F.shiftrightunsigned(c, s).bitwiseAND(F.lit(bits - 1)) for s in SHIFTS]
    rows = hashes.select(F.explode(F.array(*spots)).alias("spot")).select(
        F.shiftright("spot", 6).alias("word"), F.expr("shiftleft(1L, cast(spot % 64 as int))").alias("bit"))
    words = np.zeros(max(1, bits // 64), dtype=np.int64)
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words[np.asarray(found["word"])] = np.asarray(found["bit"])
    return words


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(words) * 64
    ok = np.ones(len(hashes), dtype=bool)
    for s in SHIFTS:
        spot = (hashes.view(np.uint64) >> np.uint64(s)).astype(np.int64) & (bits - 1)
        ok &= (words[spot >> 6] >> (spot & 63)) & 1 == 1
    return ok
