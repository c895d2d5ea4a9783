"""Hashes of all words of many texts at once, by array operations."""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(7_919)
_LETTER = _random.integers(0, 1 << 64, size=256, dtype=np.uint64)
_STEP = np.uint64(0x5851F42D4C957F2B)  # odd, so that no factor of a place loses all its bits
_place = np.ones(1, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def _places(most: int) -> np.ndarray:
    global _place
    if len(_place) < most:
        _place = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * most, _STEP, np.uint64)]), dtype=np.uint64)
    return _place


def spans(data: np.ndarray, ends: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not in `ends`; data must end with such a byte."""
    inside = np.concatenate([[False], ~ends[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(texts: list[bytes | None], ends: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of all texts, and for each text the number of words before it (one more at the end).

    Words are runs of bytes that are not in `ends`.
    """
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"\x20".join(t or b"" for t in texts) + b"\x20", np.uint8)
    starts, stops = spans(data, ends)
    before = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    if not len(starts):
        return np.empty(0, np.uint64), before
    sizes = stops - starts
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    letters = _LETTER[data[~ends[data]]] * _places(int(sizes.max()))[place]
    return mixed(np.add.reduceat(letters, first) + sizes.astype(np.uint64)), before
