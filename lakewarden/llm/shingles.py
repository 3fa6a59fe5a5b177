"""Sets of hashed word shingles of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lakewarden.llm.common import SLICE_BYTES, mix, utf8, words_of

WIDTH = 5
_KEYS = np.random.default_rng(5).integers(1, 2**64, 64, np.uint64, endpoint=False) | np.uint64(1)
#: ASCII capitals become small letters; nothing else changes.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def whole_rows(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row ends) of consecutive whole texts, a line end after each.

    Slices are bounded unless a single text is longer.
    """
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1)
        stops = offsets[first + 1 : end + 1] - offsets[first]
        yield first, end, np.insert(data[offsets[first] : offsets[end]], stops, 10), stops + np.arange(1, end - first + 1)
        first = end


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, counts per text) for consecutive texts: each text's distinct shingles, ascending.

    A shingle is ``width`` consecutive words after lower-casing A-Z, as a 64-bit hash. A text with
    fewer words has its whole sequence as its only shingle; one without words has none.
    """
    for first, end, raw, stops in whole_rows(*utf8(texts)):
        starts, _, words = words_of(LOWER[raw])
        rows = np.searchsorted(stops, starts, side="right")
        number = np.bincount(rows, minlength=end - first)
        count = max(len(words) - width + 1, 0)
        hashes = np.zeros(count, np.uint64)
        for j in range(width):
            hashes += words[j : j + count] * _KEYS[j]
        inside = rows[:count] == rows[width - 1 : width - 1 + count]
        hashes, owner = mix(hashes[inside]), rows[:count][inside]
        short = np.flatnonzero((number > 0) & (number < width))
        if len(short):
            begins = np.cumsum(number) - number
            whole = [(words[b : b + n] * _KEYS[16 : 16 + n]).sum(dtype=np.uint64) for b, n in zip(begins[short], number[short], strict=True)]
            hashes = np.append(hashes, mix(np.array(whole, np.uint64)))
            owner = np.append(owner, short)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        fresh = np.append(True, (np.diff(owner) != 0) | (hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, bool)
        yield hashes[fresh], np.bincount(owner[fresh], minlength=end - first)
