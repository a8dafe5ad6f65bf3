"""64-bit hashes of words and of word shingles, for many texts at once.

Words are runs of bytes other than ASCII white space (``\\x20`` and ``\\x09`` to
``\\x0D``). A text of one to four words has one shingle, all its words; a text
without words has none.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (changes ``x``)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0 … base**(n-1) and their inverses, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range; ranges ascend by start and by end."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = max(int(np.searchsorted(ends, low + _CHUNK, "right")), at + 1)
        part = data[low : int(ends[stop - 1])]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * up[:-1], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = stop
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the n + 1 offsets of the texts in them."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A word that runs over the border of two texts is two words.
    inner = np.unique(offsets[1:-1])
    cut = inner[(inner > 0) & (inner < len(data))]
    cut = cut[inside[cut].astype(bool) & inside[cut + 1].astype(bool)] if len(cut) else cut
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return range_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts (repeats kept), and the n + 1 offsets of the texts in them."""
    hashes, bounds = words(data, offsets)
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.empty(int(made.sum()), np.uint64)
    where = np.concatenate([[0], np.cumsum(made)])
    if len(hashes) >= size:
        n = len(hashes) - size + 1
        rolled = hashes[:n].copy()
        for k in range(1, size):
            rolled *= _STEP
            rolled += hashes[k : k + n]
        mix(rolled)
        # All starts but the last size - 1 of each text.
        keep = np.ones(len(hashes), bool)
        for k in range(1, size):
            late = bounds[1:] - k
            keep[late[late >= bounds[:-1]]] = False
        full = np.repeat(counts >= size, made)
        out[full] = rolled[np.flatnonzero(keep[:n])]
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for w in hashes[bounds[t] : bounds[t + 1]]:
                h = h * _STEP + w + np.uint64(1)
        out[where[t]] = mix(np.array([h]))[0]
    return out, where
