"""Word shingles of whole texts as 64-bit numbers, computed on Arrow buffers.

A word is a run without space, tab and line ends, with A-Z lower-cased.  Its number is a polynomial of its bytes; a
shingle's number is a mixed polynomial of its words' numbers.  Two shingles with one number are taken as equal: for
random numbers the chance of a mistake among all pairs of a million different shingles is 3e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BYTE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_WORD = np.uint64(0xD1B54A32D192ED03)
_INVERSE = np.uint64(pow(int(_BYTE), -1, 1 << 64))
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A one-to-one scattering of 64-bit numbers."""
    x = x ^ np.uint64((salt * 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_known: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n - 1), remembered for the usual sizes."""
    known = _known.get(int(base))
    if known is None or known.size < n:
        steps = np.full(max(n, 1 << 16) * 5 // 4, base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 8 << 20:
            _known[int(base)] = known
    return known[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL has no bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words, index of each text's first word (one more at the end), and the words' byte ranges."""
    data, offsets = text_bytes(column)
    n = data.size
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = _INSIDE[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < n)]  # a text's last word ends with it
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * _powers(_BYTE, n), out=sums[1:])
    values = mixed((sums[last] - sums[first]) * _powers(_INVERSE, n + 1)[first])
    return values, np.searchsorted(first, offsets), first, last


def combined(values: np.ndarray, k: int) -> np.ndarray:
    """Number of the shingle that begins at each word, over text ends too."""
    joined = np.zeros(max(values.size - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        joined = joined * _WORD + values[i : i + joined.size]
    return mixed(joined, k)


def shingles(column: pa.Array, k: int, short: bool = True) -> Iterator[np.ndarray]:
    """Shingle numbers of each text in order, with repeats.  ``short``: fewer than ``k`` words make one shingle."""
    values, starts, _, _ = words(column)
    joined = combined(values, k)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a >= k:
            yield joined[a : b - k + 1]
        elif b > a and short:
            yield combined(values[a:b], int(b - a))
        else:
            yield joined[:0]


def set_number(values: np.ndarray) -> int:
    """A signed 64-bit number of a set of shingles (distinct, in any order); 0 for the empty set."""
    if not values.size:
        return 0
    both = mixed(np.array([np.bitwise_xor.reduce(mixed(values, 4)), values.sum(dtype=np.uint64)], dtype=np.uint64), values.size)
    return int((both[:1] * _WORD + both[1:]).view(np.int64)[0])
