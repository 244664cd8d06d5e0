"""Small numpy helpers over one text: words, their hashes, and hashes of runs of them."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_RUN = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64, grown as longer inputs come."""

    def __init__(self, base: np.uint64 = _BASE) -> None:
        self.base, self.table = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            full = np.full(max(n, 2 * len(self.table)), self.base, dtype=np.uint64)
            full[0] = 1
            self.table = np.cumprod(full, dtype=np.uint64)
        return self.table[:n]


class Multipliers:
    """A random odd number for each place, grown as longer inputs come; no word can be built to meet another."""

    def __init__(self) -> None:
        self.table = np.zeros(0, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            place = np.arange(max(n, 2 * len(self.table)), dtype=np.uint64)
            self.table = mix(mix((place + np.uint64(1)) * _BASE) + _RUN[0]) | np.uint64(1)
        return self.table[:n]


_PLACES = Multipliers()


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 ``data`` -> (byte array, starts, ends) of its words ``[^\\x20\\x09-\\x0D]+``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    return raw, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; equal words have equal hashes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    longest = int(place.max()) + 1
    terms = _BYTE[raw[starts[0]:]] * _PLACES.upto(longest)[place]
    return mix(np.add.reduceat(terms, starts - starts[0]) + (ends - starts).astype(np.uint64))


def run_hashes(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` consecutive entries."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, (salt * int(_BASE) + length) % 2**64, dtype=np.uint64)
    for j in range(length):
        total += hashes[j:j + n] * _RUN[(j + 13 * salt) % 64]
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` entries, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out
