"""Words of UTF-8 texts as hashes, and hashes of their runs."""

from __future__ import annotations

import numpy as np
import xxhash

from tessera.llm.common import Kept, kept_by_worker

#: Bytes of words whose hashes a worker keeps; beyond that it starts anew.
KEPT_BYTES = 64_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near numbers fall apart."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, kept as long as there is room."""

    def __init__(self, kept_bytes: int = KEPT_BYTES):
        kept_by_worker("hashes")
        self._known = Kept(kept_bytes)

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        try:
            return np.fromiter([known[w] for w in words], np.uint64, len(words))
        except KeyError:
            known.tidy()
            for w in words:
                if w not in known:
                    known.add(w, xxhash.xxh3_64_intdigest(w))
            return np.fromiter([known[w] for w in words], np.uint64, len(words))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` words: a polynomial in the words' hashes, mixed."""
    n = len(words) - length + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    base, weight = 0x9E3779B97F4A7C15, 1
    for j in range(length):
        total += words[j : j + n] * np.uint64(weight)
        weight = weight * base % 2**64
    return mixed(total + np.uint64(length))


def stretch_hashes(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, salt: int = 0) -> np.ndarray:
    """The hash of the words from each start to each stop, from sums over all words before; other for another ``salt``.

    Stretches of different lengths, or of different words, have different hashes but for chance.
    """
    base = np.uint64((0xD6E8FEB86659FD93 + 2 * salt * 0x2545F4914F6CDD1D) % 2**64 | 1)
    back = np.uint64(pow(int(base), -1, 2**64))
    own = mixed(words ^ np.uint64(mixed(np.array([salt + 1], dtype=np.uint64))[0]))
    powers, roots = np.ones(len(words) + 1, dtype=np.uint64), np.ones(len(words) + 1, dtype=np.uint64)
    np.cumprod(np.full(len(words), base), out=powers[1:])
    np.cumprod(np.full(len(words), back), out=roots[1:])
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(own * powers[:-1], dtype=np.uint64)])
    return mixed((sums[stops] - sums[starts]) * roots[starts] + (stops - starts).astype(np.uint64) * _M1)
