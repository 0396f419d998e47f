"""Hashed character n-grams of a text's letters."""
from __future__ import annotations

import numpy as np

from trafficwatch.llm.pretokens import LETTER, _classes

_STEP = np.uint64(0x9E3779B97F4A7C15)


def letter_points(text: str) -> np.ndarray:
    """Lower-cased code points with every run of other characters as one blank, a blank
    at both ends; empty if the text has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _classes()[points] == LETTER
    if not letter.any():
        return np.zeros(0, np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter is the blank
    kept = np.where(letter, points, np.uint32(32))[keep]
    tail = [] if kept[-1] == 32 else [32]
    return np.concatenate([[32], kept, tail]).astype(np.uint32)


def gram_buckets(points: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket of each n-gram of ``points``; ``buckets`` is a power of two."""
    count = len(points) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        value = np.full(count, np.uint64(n))
        for i in range(n):
            value = (value ^ points[i:i + count]) * _STEP
            value ^= value >> np.uint64(29)
    return (value & np.uint64(buckets - 1)).astype(np.int64)
