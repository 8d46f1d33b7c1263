"""A set of 64-bit hashes in a bitmap of bounded size, made in Spark and broadcast.

It says of each hash in the set that it is there, and of few others. What it lets through is decided exactly by a join;
what it stops needs none. So its size, at most 2**MOST bits, bounds memory and never changes a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each hash, and the most and fewest bits (as powers of 2): 16 MB and 128 bytes.
SPARE, MOST, FEWEST = 16, 27, 10


def of(hashes: DataFrame, column: str) -> np.ndarray:
    """The bitmap of a column of uniform hashes (long). At most 2**(MOST - 6) words come to the driver."""
    n = hashes.count()
    bits = min(MOST, max(FEWEST, (SPARE * n).bit_length()))
    word = F.shiftrightunsigned(column, 64 - (bits - 6)).alias("word")
    rows = hashes.select(word, F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def within(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (64 bits) may be in the set."""
    h = hashes.view(np.uint64)
    shift = np.uint64(64 - (len(bitmap).bit_length() - 1))
    return (bitmap[(h >> shift).astype(np.int64)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool)
