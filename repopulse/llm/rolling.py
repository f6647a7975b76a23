"""Hashes of windows of words, vectorised over a text."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes one task remembers before it starts anew.
REMEMBERED = 500_000
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hash of each word; forgets all words once there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each pair, sensitive to its order."""
    x = a * _K1
    x += b
    x ^= x >> np.uint64(32)
    x *= _K2
    x ^= x >> np.uint64(29)
    x *= _K3
    x ^= x >> np.uint64(32)
    return x


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of `length` consecutive entries, built by doubling."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    found, have, power, size = None, 0, hashes, 1
    while True:
        if length & size:
            if found is None:
                found = power
            else:
                n = len(hashes) - have - size + 1
                found = _joined(found[:n], power[have : have + n])
            have += size
        if have == length:
            return found
        power = _joined(power[:-size], power[size:])
        size *= 2
