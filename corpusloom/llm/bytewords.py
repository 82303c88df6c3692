"""Words of UTF-8 texts as numpy arrays: bounds and 64-bit hashes for a whole Arrow batch at once.

Separators are ASCII, so splitting bytes and splitting characters agree. A word's hash is a polynomial over a
random table of byte values modulo 2^64 followed by a mixing step, taken from prefix sums: no Python loop over words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from corpusloom.llm.common import string_offsets

_RADIX = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240607).integers(1 << 40, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

#: The separators of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but digits and letters, lower-cased first.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:128] = [not chr(c).isalnum() for c in range(128)]

#: Lower-cases A-Z, nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the radix (up) or of its inverse modulo 2^64 (down)."""
    have = _powers[kind]
    if len(have) < n:
        base = np.uint64(_RADIX if kind == "up" else pow(_RADIX, -1, 1 << 64))
        steps = np.full(max(n, (1 << 20) + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 << 20:
            _powers[kind] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of `n` texts in order. `first[i]:first[i+1]` are the words of text i."""

    data: np.ndarray  # lower-cased bytes of all texts
    offsets: np.ndarray  # text bounds in data, from 0
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def prefix_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_sums"):
            n = len(self.data)
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUES[self.data] * _power("up", n), out=self._sums[1:], dtype=np.uint64)
        return mixed((self._sums[ends] - self._sums[starts]) * _power("down", len(self.data) + 1)[starts])

    def hashes(self) -> np.ndarray:
        return self.prefix_hash(self.starts, self.ends)


def raw_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string array without nulls."""
    offsets = string_offsets(arr)
    buf = arr.buffers()[2] if len(arr) else None
    data = np.frombuffer(buf, np.uint8)[offsets[0] : offsets[-1]] if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split(arr: pa.Array, separators: np.ndarray) -> Words:
    raw, offsets = raw_bytes(arr)
    data = LOWER[raw]
    inside = ~separators[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def shingle_hashes(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and their bounds per text; a text of fewer words, but not none, has one."""
    counts = w.counts
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], n) + np.repeat(w.first[:-1], n)
    out = np.zeros(len(at), np.uint64)
    short = np.repeat(counts < k, n)
    full = at[~short]
    acc = np.full(len(full), np.uint64(k), np.uint64)
    for j in range(k):
        acc = mixed(acc * np.uint64(0x9FB21C651E98DF25) + h[full + j])
    out[~short] = acc
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        acc1 = np.array([counts[i]], np.uint64)
        for j in range(w.first[i], w.first[i + 1]):
            acc1 = mixed(acc1 * np.uint64(0x9FB21C651E98DF25) + h[j : j + 1])
        out[first[i]] = acc1[0]
    return out, first
