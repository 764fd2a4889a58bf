"""Word hashes and 64-bit mixing on numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

_MOST = 400_000  # some 80 MB a worker


class WordHashes(dict):
    """Hash of each word met; forgets everything when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
