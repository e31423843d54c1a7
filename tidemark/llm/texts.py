"""Numpy views of Arrow string columns: bounded chunks of bytes, and 64-bit hashes of their words.

Everything here works on a whole Arrow batch at a time, in chunks of at most ``CHUNK_BYTES`` of text, so a
task's memory follows the chunk (or its single longest document), not the batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, int64 offsets) of a string column; null rows have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat, starts


def byte_chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, bytes, offsets) so that a chunk holds ``limit`` bytes or a single longer text."""
    if not len(column):
        return
    flat, starts = _bytes_of(column)
    low, rows = 0, len(column)
    while low < rows:
        high = int(np.searchsorted(starts, starts[low] + limit, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, flat[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
        low = high


def string_chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, list of str) in the same chunks; null rows are empty strings."""
    for low, _, offsets in byte_chunks(column, limit):
        yield low, [text or "" for text in column.slice(low, len(offsets) - 1).to_pylist()]


@lru_cache(maxsize=None)
def _byte_values() -> np.ndarray:
    """A 64-bit value per byte; white space is 0, A-Z are like a-z."""
    values = np.array([mix_int(byte + 1) for byte in range(256)], dtype=np.uint64)
    values[65:91] = values[97:123]
    values[[32, 9, 10, 11, 12, 13]] = 0
    return values


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes that ``Words`` gives to these words."""
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return Words(data, np.array([0, len(data)])).hashes


@lru_cache(maxsize=None)
def space_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


_powers = np.ones(1, dtype=np.uint64)


def powers(size: int) -> np.ndarray:
    global _powers
    if len(_powers) < size:
        grown = np.full(max(size, 256), _MULTIPLIER, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def mix_int(value: int) -> int:
    value ^= value >> 33
    value = value * 0xFF51AFD7ED558CCD & _MASK
    value ^= value >> 33
    value = value * 0xC4CEB9FE1A85EC53 & _MASK
    return value ^ value >> 33


class Words:
    """The words of a chunk: ``hashes``, ``rows`` (row of each word) and ``bounds`` (first word of each row).

    Words are runs of bytes other than white space, or of those that ``inside`` marks; A-Z count as a-z.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        blank = inside is None
        if blank:
            inside = ~space_table()[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = inside[begins]
        self.starts = np.flatnonzero(first)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))
        self._values = _byte_values()[data]
        if not blank:
            self._values = np.where(inside, self._values, np.uint64(0))
        if len(self.starts):
            number = np.cumsum(first, dtype=np.int32) - 1
            self.position = np.arange(len(data), dtype=np.int64) - self.starts[number]
            self.position[: self.starts[0]] = 0
            self._values *= powers(int(self.position.max()) + 1)[self.position]
            self.hashes = mix(np.add.reduceat(self._values, self.starts))
        else:
            self.position = np.zeros(len(data), dtype=np.int64)
            self.hashes = np.zeros(0, dtype=np.uint64)

    def prefixes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of each word (of all of it, if it is shorter)."""
        if not len(self.starts):
            return self.hashes
        part = np.where(self.position < size, self._values, np.uint64(0))
        return mix(np.add.reduceat(part, self.starts) + np.uint64(size))


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words (runs that cross rows included: callers cut by ``bounds``)."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for place in range(size):
        total += hashes[place : place + count] * np.uint64(mix_int(place + 1) | 1)
    return mix(total)
