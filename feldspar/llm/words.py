"""64-bit hashes of the words of a text, computed over its bytes at once."""

from __future__ import annotations

import re

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTERS = np.random.default_rng(20).integers(0, 2**64, 256, np.uint64)
_EXACT = _LETTERS.copy()
_LETTERS[65:91] = _LETTERS[97:123]
_BASE = 0x9E3779B97F4A7C15
_GAP = re.compile(rb"[\x09-\x0d\x20]")
#: Texts are hashed in parts of about this many bytes, cut at white space.
PART_BYTES = 1 << 19
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[i] = np.multiply.accumulate(out)
    return _powers


def word_hashes(octets: bytes, exact: bool = False) -> np.ndarray:
    """One hash per word (runs of bytes other than ASCII white space) in order; A-Z count as a-z unless ``exact``."""
    letters = _EXACT if exact else _LETTERS
    if len(octets) > 2 * PART_BYTES:
        parts, at = [], 0
        while at < len(octets):
            gap = _GAP.search(octets, at + PART_BYTES)
            end = gap.start() if gap else len(octets)
            parts.append(_hashes(octets[at:end], letters))
            at = end
        return np.concatenate(parts)
    return _hashes(octets, letters)


def _hashes(octets: bytes, letters: np.ndarray) -> np.ndarray:
    b = np.frombuffer(octets, np.uint8)
    n = len(b)
    if not n:
        return np.empty(0, np.uint64)
    power, inverse = _table(n)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[b] * power[:n], out=sums[1:])
    return mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
