"""Hashes of words and word shingles of whole texts, for a batch of texts at a time in numpy.

Words are maximal runs of bytes other than space and 0x09 to 0x0D; A-Z count as a-z unless `case`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_RANDOM = np.random.default_rng(20240611)
_BYTES = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CASED = np.where(_SPACE, np.uint64(0), _BYTES)
_FOLDED = _CASED.copy()
_FOLDED[65:91] = _CASED[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ORDER = _RANDOM.integers(1, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, step: np.uint64 = _STEP) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Powers that are kept; words may be longer.
FAR = 1 << 20
_POWERS = [_powers(4096)]


def word_hashes(texts: Sequence[bytes], case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, one text after the other, and each text's number of words."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1 if len(data) else np.zeros(0, np.int64)
    if len(data) and not space[0]:
        starts = np.concatenate([[0], starts])
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    spans = np.diff(np.append(starts, len(data)))
    at = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    # White space adds 0, but may stand far from its word's start.
    longest = int(spans.max())
    if longest > len(_POWERS[0]):
        _POWERS[0] = _powers(min(longest, FAR))
    parts = (_CASED if case else _FOLDED)[data[starts[0] :]] * _POWERS[0][at % FAR if longest > FAR else at]
    if longest > FAR:  # a power of a far place is that of its mebibyte times that within it
        stride = np.uint64(pow(int(_STEP), FAR, 1 << 64))
        parts *= _powers(longest // FAR + 1, stride)[at // FAR]
    return mixed(np.add.reduceat(parts, starts - starts[0])), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of `width` words, and each text's number of them.

    A text with fewer words has one, its whole sequence; one without words has none.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    if not len(words):
        return np.zeros(0, np.uint64), sizes
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        total += words[j : j + len(total)] * _ORDER[j]
    out_ends = np.cumsum(sizes)
    at = np.repeat(begins - (out_ends - sizes), sizes) + np.arange(int(out_ends[-1]))
    out = total[np.minimum(at, len(total) - 1)] if len(total) else np.zeros(len(at), np.uint64)
    for i in np.flatnonzero((counts < width) & (counts > 0)):
        own = words[begins[i] : ends[i]]
        last = slice(out_ends[i] - 1, out_ends[i])
        out[last] = (own * _ORDER[: len(own)]).sum(keepdims=True) + _ORDER[15:] * np.uint64(len(own))
    return mixed(out), sizes


def distinct_sets(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and distinct, one text after the other, and how many."""
    own = [np.unique(x) for x in np.split(hashes, np.cumsum(sizes)[:-1])] if len(sizes) else []
    lengths = np.array([len(x) for x in own], np.int64)
    return (np.concatenate(own) if own else np.zeros(0, np.uint64)), lengths
