"""64-bit hashes of the words of a text, for all words at once.

A word's hash is the sum of a random number for each byte times a power of an odd base, modulo 2**64: a difference of two prefix sums, so no word is touched one by one. Texts go through in pieces of PIECE bytes, cut at white space."""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64)


_BYTE = _random(11, 256)
_BASE = 0x9E3779B97F4A7C15
_LENGTH = _U(0xC2B2AE3D27D4EB4F)
_powers: dict = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and fold, twice."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 15, 1 << (n - 1).bit_length())
        steps = np.full(size, base & (2**64 - 1), np.uint64)
        steps[0] = 1
        _powers[base] = have = np.multiply.accumulate(steps)
    return have[:n]


_INVERSE = pow(_BASE, -1, 2**64)


def spans(data: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that aren't space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~space[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: bytes, places: list | None = None) -> np.ndarray:
    """A hash for each run of characters other than ASCII white space; places, if given, gets the arrays of their first bytes."""
    found, at = [], 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        piece = np.frombuffer(data, np.uint8, min(end, len(data)) - at, at)
        starts, ends = spans(piece)
        if places is not None:
            places.append(starts + at)
        at = end
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * _power(_BASE, len(piece)), out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * _power(_INVERSE, len(piece))[starts] + (ends - starts).astype(np.uint64) * _LENGTH))
    return found[0] if len(found) == 1 else np.concatenate(found) if found else np.empty(0, np.uint64)
