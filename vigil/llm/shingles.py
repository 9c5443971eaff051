"""Word shingles of whole texts as sorted 64-bit numbers, and their MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from vigil.llm.memory import remembers

_KEEP = 1_000_000
_words: dict[bytes, int] = {}
remembers("shingles", _words.clear)
_U64 = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> _U64(31))) * _U64(0x7FB5D329728EA185)
    x = (x ^ (x >> _U64(27))) * _U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U64(33))


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text in UTF-8 with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """The distinct shingles of `size` words, sorted; with fewer words the whole sequence as one; none
    without words. Two different shingles share a number with probability 2**-64."""
    found = words(text)
    if not found:
        return np.empty(0, _U64)
    if len(_words) > _KEEP:
        _words.clear()
    new = set(found).difference(_words)
    _words.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
    hashes = np.fromiter(map(_words.__getitem__, found), _U64, len(found))
    n = min(size, len(hashes))
    rolled = np.full(len(hashes) - n + 1, n, _U64)
    for i in range(n):
        rolled = _mixed(rolled + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(rolled)


class MinHash:
    """Signatures of `symbols` values of 16 bits, four in a signed 64-bit number."""

    def __init__(self, symbols: int, seed: int = 1):
        if symbols % 4:
            raise ValueError("symbols are packed by four")
        draw = np.random.default_rng(seed)
        self.xors = draw.integers(0, 1 << 63, symbols, _U64) * _U64(2) + _U64(1)
        self.factors = draw.integers(0, 1 << 63, symbols, _U64) * _U64(2) + _U64(1)

    def __call__(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of packed numbers for each set; the sets are not empty."""
        if not sets:
            return np.empty((0, len(self.xors) // 4), np.int64)
        flat = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        least = np.stack([np.minimum.reduceat((flat ^ x) * f, starts) for x, f in zip(self.xors, self.factors)], 1)
        four = (_mixed(least) >> _U64(48)).reshape(len(sets), -1, 4)
        return (four[..., 0] | four[..., 1] << _U64(16) | four[..., 2] << _U64(32)
                | four[..., 3] << _U64(48)).view(np.int64)
