"""Words of a text as bytes, and 64-bit hashes of their runs, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

KEEP = 400_000
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hashes of words; the words of recent texts are kept."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KEEP:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), "uint64", len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(_ODD[2])
    return x ^ (x >> np.uint64(29))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; the order within a run counts."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, "uint64")
    out = np.full(size, n, "uint64")
    for i in range(n):
        out = mix(out * np.uint64(_ODD[0]) + hashes[i : i + size] * np.uint64(_ODD[1]))
    return out


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct runs of ``n`` words; fewer words count as one run, none give none."""
    return np.unique(runs(hashes, min(n, len(hashes)))) if len(hashes) else np.zeros(0, "uint64")


def digest(values: np.ndarray) -> int:
    """Signed 64-bit digest of an array."""
    return int(np.array(xxhash.xxh64_intdigest(values.tobytes(), seed=1), "uint64").view("int64"))
