"""Word shingles as 64-bit hashes.

Words are runs of characters other than ASCII white space, A-Z in lower case. A text's set holds each run of five words; a text of fewer words has the
whole sequence as one shingle; without words the set is empty.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: a bijection whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's shingles in order, with repeats."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < WIDTH:
        return mixed((h * _ODD[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - WIDTH + 1
    total = h[:n] * _ODD[0]
    for i in range(1, WIDTH):
        total += h[i : i + n] * _ODD[i]
    return mixed(total + np.uint64(WIDTH))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes."""
    h = shingle_hashes(text)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h
