"""Super-k-mers of words: runs of consecutive windows that share a minimiser."""

from __future__ import annotations

import numpy as np

from lakewarden.llm.common import mix, words_of

#: Words of the short sequence whose hash is minimised.
MER = 5
_KEYS = np.random.default_rng(35).integers(1, 2**64, MER, np.uint64, endpoint=False) | np.uint64(1)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the first smallest of the next ``width`` values is."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left = best[:-step] <= best[step:]
        best, at = np.where(left, best[:-step], best[step:]), np.where(left, at[:-step], at[step:])
        have += step
    return at


def split(raw: np.ndarray, stops: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Words and super-k-mers of texts that end at ``stops``.

    Returns word starts, word ends, the row of each word, and per super-k-mer its first word, its
    number of windows and its minimiser. Windows lie within one text.
    """
    starts, ends, hashes = words_of(raw)
    rows = np.searchsorted(stops, starts, side="right")
    count = len(hashes) - window + 1
    if count < 1:
        none = np.zeros(0, np.int64)
        return starts, ends, rows, none, none, np.zeros(0, np.uint64)
    mers = np.zeros(len(hashes) - MER + 1, np.uint64)
    for j in range(MER):
        mers += hashes[j : j + len(mers)] * _KEYS[j]
    mers = mix(mers)
    at = leftmost_minima(mers, window - MER + 1)[:count]
    inside = rows[:count] == rows[window - 1 :]
    first = np.flatnonzero(inside)
    if not len(first):
        none = np.zeros(0, np.int64)
        return starts, ends, rows, none, none, np.zeros(0, np.uint64)
    new = np.append(True, (np.diff(first) > 1) | (np.diff(at[first]) != 0) | (np.diff(rows[first]) != 0))
    begin = np.flatnonzero(new)
    return starts, ends, rows, first[begin], np.diff(np.append(begin, len(first))), mers[at[first[begin]]]


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers 0 to ``count`` - 1, modulo 2**64."""
    out = np.ones(max(count, 1), np.uint64)
    have, step = 1, np.uint64(base)
    while have < count:
        more = min(have, count - have)
        out[have : have + more] = out[:more] * step
        have, step = have + more, step * step
    return out


def content_hashes(raw: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` words from word ``first``."""
    with np.errstate(over="ignore"):
        _, _, hashes = words_of(raw)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64)])
        moved = (sums[first + length] - sums[first]) * _powers(_BACK, len(hashes) + 1)[first]
        return mix(moved + length.astype(np.uint64))
