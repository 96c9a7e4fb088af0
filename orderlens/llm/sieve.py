"""A bitmap of hashes with a fixed most size, sent to the executors.

It says of a hash "not there" or "may be there", so it saves work and never
decides: what passes is settled by a join or a comparison. Spark sets the bits;
the driver sees at most ``MAX_BITS`` of them, whatever the number of hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 32 MB.
MAX_BITS = 1 << 28
#: 4 MB: a text brings thousands of hashes, so few false positives each add up.
MIN_BITS = 1 << 25
#: Bits per hash while the bitmap is below its most size.
BITS_EACH = 64


class Sieve:
    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    @staticmethod
    def share(hashes: DataFrame, column: str):
        """The broadcast sieve of a column of well-mixed 64-bit hashes."""
        n = hashes.count()
        bits = MIN_BITS
        while bits < min(MAX_BITS, BITS_EACH * n):
            bits *= 2
        one = F.col(column).bitwiseAND(bits - 1)
        two = F.shiftrightunsigned(column, 32).bitwiseAND(bits - 1)
        ones = (hashes.select(F.explode(F.array(one, two)).alias("bit"))
                .groupBy(F.shiftright("bit", 6).alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("ones")).toArrow())
        words = np.zeros(bits // 64, dtype=np.uint64)
        words[ones.column("word").to_numpy()] = ones.column("ones").to_numpy().view(np.uint64)
        return hashes.sparkSession.sparkContext.broadcast(Sieve(words))

    def _set(self, bit: np.ndarray) -> np.ndarray:
        return ((self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)

    def passes(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be there."""
        at = np.flatnonzero(self._set(h & self.mask))
        return at[self._set((h[at] >> np.uint64(32)) & self.mask)]
