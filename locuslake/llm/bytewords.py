"""Words of a batch of texts as numpy arrays over their joined UTF-8 bytes, without a Python loop over words.

A word is a maximal run of letters, digits, underscores and non-ASCII characters of the lower-case text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True
_P = 0x9E3779B97F4A7C15 | 1
_POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full((1 << 12) - 1, _P, np.uint64)]))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first n powers; those of words longer than the fixed table are made anew and not kept."""
    if n <= len(_POWERS):
        return _POWERS[:n]
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _P, np.uint64)]))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, each followed by a zero byte
    is_word: np.ndarray
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    doc: np.ndarray  # index of each word's text
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]

    def sums(self) -> np.ndarray:
        """For each word, the sum of its bytes plus one, each by the power of its place."""
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint64)
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), length)
        return np.add.reduceat((self.data[self.is_word].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[place], first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        return mix(self.sums() + (self.end - self.start).astype(np.uint64))


def words(texts: list[str | None]) -> Words:
    parts = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    is_word = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], is_word, [False]]).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum([len(p) + 1 for p in parts])
    bounds = np.concatenate([[0], np.searchsorted(start, ends)])
    doc = np.repeat(np.arange(len(parts)), np.diff(bounds))
    return Words(data, is_word, start, end, doc, bounds)


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text index, 64-bit hash) of every run of `size` words; of texts with fewer words, one of all their words."""
    h = w.hashes()
    n = np.diff(w.bounds)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    odd = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) | 1) for k in range(size)]
    value = np.zeros(len(h), dtype=np.uint64)
    for k in range(size):
        m = len(h) - k
        if m > 0:
            # in a short text the run stops at its last word
            inside = (w.doc[k:] == w.doc[:m]) if k else slice(None)
            part = h[k:] * odd[k]
            value[:m] += part if k == 0 else np.where(inside, part, np.uint64(0))
    place = np.arange(len(h)) - w.bounds[w.doc]
    keep = (place <= n[w.doc] - size) | ((place == 0) & (n[w.doc] < size))
    return w.doc[keep], mix(value[keep])
