"""Words of many texts at once: where they lie in the bytes, and a 64-bit hash of each, without a Python step per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Fixed value: the bytes between words.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finalizer of a public hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums from which range_hash takes the hash of any range of values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end]; equal ranges have equal hashes wherever they lie."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


@dataclass
class Words:
    buffer: bytes
    start: np.ndarray  # byte offsets of all words of all texts
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text, and one more at the end
    hash: np.ndarray

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(texts: list[bytes]) -> Words:
    """Words are runs of bytes other than ASCII white space."""
    buffer = b" " + b" ".join(texts) + b" "
    data = np.frombuffer(buffer, np.uint8)
    space = SPACE[data]
    edge = space[1:] != space[:-1]
    at = np.flatnonzero(edge) + 1
    start, end = at[::2], at[1::2]
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    sums = prefix_sums(BYTE_VALUES[data])
    return Words(buffer, start, end, np.searchsorted(start, begins), range_hash(sums, start, end))
