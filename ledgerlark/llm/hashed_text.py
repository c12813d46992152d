"""Hashed text features: byte n-grams of whole texts, vectorised.

A text is the mean over all its n-gram positions of the weights of their
buckets, so a linear model needs one table lookup a byte. The n-grams of a
text lie within it; ASCII letters are lower-cased."""

from __future__ import annotations

import numpy as np

DIM = 1 << 16
CHUNK = 1 << 20
#: n-gram lengths and their multipliers (odd, fixed).
GRAMS = ((2, 0x9E3779B1), (4, 0x85EBCA6B))

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def buckets(text: bytes, dim: int = DIM):
    """Arrays of buckets of a text's n-grams, a bounded piece at a time; a text
    shorter than the n-gram is one n-gram."""
    data = np.frombuffer(text, np.uint8)
    for n, mult in GRAMS:
        for at in range(0, max(1, len(data) - n + 1), CHUNK):
            part = _LOWER[data[at:at + CHUNK + n - 1]]
            if not len(part):
                continue
            m = max(1, len(part) - n + 1)
            h = np.full(m, n, np.uint32)
            for k in range(min(n, len(part))):
                h = h * np.uint32(257) + part[k:k + m]
            h *= np.uint32(mult)
            yield (h ^ (h >> np.uint32(15))) & np.uint32(dim - 1)


def frequencies(text: bytes, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their relative frequencies."""
    got = list(buckets(text, dim))
    if not got:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    found, n = np.unique(np.concatenate(got), return_counts=True)
    return found.astype(np.int32), (n / n.sum()).astype(np.float32)


def scores(text: bytes, weights: np.ndarray) -> np.ndarray:
    """Mean weight row (weights: dim x outputs) over the n-gram positions of a
    text; zeros for an empty one."""
    total, n = np.zeros(weights.shape[1]), 0
    for b in buckets(text, len(weights)):
        # by occurrence counts: the sum has the same order for any text
        total += weights[b].sum(axis=0, dtype=np.float64)
        n += len(b)
    return total / max(1, n)
