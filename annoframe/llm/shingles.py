"""Weighted word shingles of whole texts as numpy arrays, for use inside tasks."""

from __future__ import annotations

from zlib import crc32

import numpy as np

WORDS = 5
#: Odd 64-bit multipliers of the hash (fixed, so that every task agrees).
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the runs of five words, and how often each occurs. Fewer words are one shingle."""
    words = (text or "").encode().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = mixed(np.fromiter(map(crc32, words), np.uint64, n) + MIX[0])
    if n < WORDS:
        w = np.concatenate([w, np.zeros(WORDS - n, np.uint64)])
    m = len(w) - WORDS + 1
    h = w[:m] * MIX[0]
    for i in range(1, WORDS):
        h = mixed(h + w[i : i + m])
    h.sort()
    first = np.empty(m, bool)
    first[0] = True
    np.not_equal(h[1:], h[:-1], out=first[1:])
    at = np.flatnonzero(first)
    return h[at], np.diff(np.append(at, m))


class Weights:
    """tf-idf: occurrences times rarity; ``common`` holds the document counts of the shingles that are not rare."""

    def __init__(self, common: dict[int, int], docs: int, rare: float, plain: bool = False):
        self.plain = plain
        order = sorted(common)
        self.keys = np.array(order, dtype=np.uint64)
        share = np.array([common[k] for k in order], dtype=float) / max(docs, 1)
        with np.errstate(divide="ignore"):
            rarity = np.clip(np.log(np.maximum(share, 1e-300)) / np.log(rare), 0, 1)
        self.idf = 0.5 + 0.5 * rarity

    def of(self, h: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = tf.astype(float)
        if len(self.keys) and len(h):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            w *= np.where(self.keys[at] == h, self.idf[at], 1.0)
        return w

    def each(self, h: np.ndarray, tf: np.ndarray) -> list[np.ndarray]:
        """The tf-idf weights and, if ``plain`` and where they differ, the plain counts."""
        w, counts = self.of(h, tf), tf.astype(float)
        return [w, counts] if self.plain and (w != counts).any() else [w]

    def nearest(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
        """The tf-idf similarity of two (hashes, counts); if ``plain``, the larger of it and that of the counts."""
        wa, wb = self.each(*a), self.each(*b)
        near = similarity((a[0], wa[0]), (b[0], wb[0]))
        return near if len(wa) == len(wb) == 1 else max(near, similarity((a[0], wa[-1]), (b[0], wb[-1])))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (sorted hashes, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - low
    return float(low / total) if total else 0.0
