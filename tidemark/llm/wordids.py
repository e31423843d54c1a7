"""Words of a chunk of texts as exact numbers: equal words, and only they, have equal numbers."""

from __future__ import annotations

import numpy as np


def rows_of(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    edges = offsets.tolist()
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(edges, edges[1:])]


def number_words(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """(number of each word, first word of each row and the end, words of each row); words end at white space."""
    known: dict[bytes, int] = {}
    words = [row.split() for row in rows]  # of bytes: splits at \x20 and \x09-\x0D only
    bounds = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum([len(row) for row in words], out=bounds[1:])
    ids = np.fromiter((known.setdefault(word, len(known)) for row in words for word in row), np.int64, int(bounds[-1]))
    return ids, bounds, words


def separated(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers with one of its own after each row, so that nothing repeats across rows; and the new bounds."""
    count = len(bounds) - 1
    moved = bounds + np.arange(count + 1)
    joined = np.empty(len(ids) + count, dtype=np.int64)
    ends = moved[1:] - 1
    inside = np.ones(len(joined), dtype=bool)
    inside[ends] = False
    joined[inside] = ids
    joined[ends] = -1 - np.arange(count)
    return joined, moved
