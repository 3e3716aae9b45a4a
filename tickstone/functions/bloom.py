"""Bloom filters of 64-bit hashes, for tasks that should hand on little of what they read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28  # 32 MB a task
FEW = 1 << 16  # hashes that the driver sets itself


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread unsigned 64-bit numbers, of which the high bits are good and the low ones are not."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    return h


class Bloom:
    """Two bits a hash, 16 bits of room for each up to ``MOST_BITS`` in all; one without bits has nothing, or all hashes.

    What is in the filter is always found.  A full filter finds more that is not, so it must stand before an exact test.
    """

    def __init__(self, words: np.ndarray | None = None, everything: bool = False):
        self.words, self.everything = words, everything

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.words is None:
            return np.full(hashes.size, self.everything)
        mask = np.uint64(self.words.size * 64 - 1)
        hit = self._bit(hashes & mask)
        some = np.flatnonzero(hit)
        hit[some] = self._bit((hashes[some] >> np.uint64(32)) & mask)
        return hit

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)

    @classmethod
    def of(cls, hashes: DataFrame, column: str, n: int | None = None, most_bits: int = MOST_BITS) -> Bloom:
        """Of a BIGINT column with ``n`` rows (counted, if not given); beyond ``FEW`` only the filter's words pass through the driver."""
        n = hashes.count() if n is None else n
        if not n:
            return cls()
        bits = min(most_bits, 1 << max(16, (16 * n - 1).bit_length()))
        words = np.zeros(bits // 64, dtype=np.uint64)
        if n <= FEW:
            found = hashes.select(column).toArrow()[column].to_numpy().view(np.uint64)
            for at in (found & np.uint64(bits - 1), (found >> np.uint64(32)) & np.uint64(bits - 1)):
                np.bitwise_or.at(words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            return cls(words)
        places = [F.col(column).bitwiseAND(bits - 1), F.shiftright(column, 32).bitwiseAND(bits - 1)]
        rows = hashes.select(F.explode(F.array(*places)).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
        rows = rows.agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).toArrow()
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(words)
