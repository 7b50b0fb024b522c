"""Words and word shingles of Arrow string columns as 64-bit hashes, whole columns at a time.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, with A-Z lower-cased. Hashes depend on the bytes of the words alone, so
they agree between tasks, runs and machines.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SHINGLE = 5
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(folded: bool) -> np.ndarray:
    letters = np.arange(256, dtype=np.uint64)
    if folded:
        letters[65:91] += np.uint64(32)
    return mix(letters + np.uint64(1))


_VALUES = _byte_values(folded=True)
#: Values that tell A-Z from a-z.
EXACT_VALUES = _byte_values(folded=False)
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


@lru_cache(maxsize=1)
def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(1 << log2, base, dtype=np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def row_chunks(column: pa.Array, size: int = _CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: first row, the bytes, and the rows' offsets in them.

    Nulls are empty. A text longer than ``size`` is a run of its own, never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        stop = min(max(stop, first + 1), len(column))
        yield first, data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, values: np.ndarray = _VALUES
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a run of rows, in order, and the number of words before each row.

    ``space`` marks the bytes that separate words; ``values`` has a number for every byte. A long run is
    worked through in parts that end between words, so the memory it takes beside its words is bounded.
    """
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    if len(data) > 2 * _CHUNK:
        found, begins = [], []
        for start, stop in _parts(data, space):
            own = np.unique(np.clip(offsets, start, stop)) - start
            hashes, first = _part_hashes(data[start:stop], np.union1d(own, [0, stop - start]), space, values)
            found.append(hashes)
            begins.append(first + start)
        return np.concatenate(found), np.searchsorted(np.concatenate(begins), offsets)
    hashes, begins = _part_hashes(data, offsets, space, values)
    return hashes, np.searchsorted(begins, offsets)


def _parts(data: np.ndarray, space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of ``_CHUNK`` bytes, each lengthened to the end of its last word."""
    start = 0
    while start < len(data):
        stop = min(start + _CHUNK, len(data))
        while stop < len(data) and not (after := space[data[stop : stop + _CHUNK]]).any():
            stop = min(stop + _CHUNK, len(data))
        if stop < len(data):
            stop += int(after.argmax())
        yield start, stop
        start = stop


def _part_hashes(data: np.ndarray, offsets: np.ndarray, space: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and where they begin; ``offsets`` end words as spaces do."""
    inside = ~space[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    begins = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    powers, inverse = _powers(max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[begins]) * inverse[begins]
    return mix(hashes + (ends - begins).astype(np.uint64) * _STEP), begins


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a row, and the number of shingles before each row.

    A row with fewer words is one shingle of all its words; a row without words has none.
    """
    counts = np.diff(starts)
    rows = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - starts[:-1][rows] if len(words) else np.zeros(0, dtype=np.int64)
    length = np.minimum(counts, size)[rows] if len(words) else place
    keep = place + length <= counts[rows] if len(words) else np.zeros(0, dtype=bool)
    keep &= (length == size) | (place == 0)
    at, length = np.flatnonzero(keep), length[keep]
    value = length.astype(np.uint64) * _STEP
    for i in range(size):
        inside = i < length
        step = words[np.minimum(at + i, len(words) - 1)] if len(words) else value
        value = np.where(inside, mix(value ^ step) * np.uint64(_BASE) + step, value)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix(value), np.concatenate(([0], np.cumsum(made)))


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and the sorted distinct shingle hashes of every row, in row order."""
    for first, data, offsets in row_chunks(column):
        hashes, starts = shingle_hashes(*word_hashes(data, offsets), size)
        for i in range(len(offsets) - 1):
            yield first + i, np.unique(hashes[starts[i] : starts[i + 1]])
