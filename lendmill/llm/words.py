"""Words and word windows of texts as arrays of hashes.

Ranges are hashed as polynomials modulo the prime 2**61 - 1 at a drawn base: two different
ranges of n values agree with a probability of n / 2**61 over the draw, whatever they hold.
(Sums modulo a power of two have pairs of long ranges that agree at every base.)
"""

from __future__ import annotations

import hashlib

import numpy as np

PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
BASE = 0x13C6EF372FE94F82 % PRIME
#: Powers that a worker keeps, for texts worked on a mebibyte at a time; longer texts have their own.
KEPT_POWERS = (1 << 20) + 2
#: Bytes of a range whose sums stay below 2**64; a longer word is hashed by itself.
LONGEST_WORD = 1 << 22
_POWERS: dict[str, np.ndarray] = {}


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it."""
    a_high, a_low, b_high, b_low = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = a_high * b_low + a_low * b_high
    return reduced(a_high * b_high * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + a_low * b_low)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by doubling."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, PRIME))):
            found = np.ones(1, np.uint64)
            while len(found) < max(n, KEPT_POWERS):
                found = np.concatenate([found, times(found, np.uint64(pow(base, len(found), PRIME)))])
            _POWERS[name] = found[:KEPT_POWERS].copy() if n <= KEPT_POWERS else found
        # For bytes the two parts of a power are multiplied by themselves.
        _POWERS["high"], _POWERS["low"] = _POWERS["up"] >> np.uint64(31), _POWERS["up"] & _LOW31
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _finished(sums: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    found = times(sums, _POWERS["down"][starts]) ^ (sizes.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def _sums(high: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of high * 2**31 + low over ranges, modulo the prime."""
    running = np.zeros(len(high) + 1, np.uint64)
    np.cumsum(high, out=running[1:])
    upper = reduced(running[ends] - running[starts])
    np.cumsum(low, out=running[1:])
    return reduced(times(upper, np.uint64(1 << 31)) + reduced(running[ends] - running[starts]))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; values are hashes themselves."""
    up, _ = powers(len(values) + 1)
    terms = times(reduced(values), up[: len(values)])
    return _finished(_sums(terms >> np.uint64(31), terms & _LOW31, starts, ends), starts, ends - starts)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32)).astype(np.uint8)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words between the six ASCII spaces, and the first word
    of each text."""
    gap = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[True], gap])[: len(data)] | border[:-1]
    after = np.concatenate([gap[1:], [True]])[: len(data)] | border[1:]
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    powers(len(data) + 1)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    found = _finished(_sums(values * _POWERS["high"][: len(data)], values * _POWERS["low"][: len(data)], starts, ends), starts, ends - starts)
    for i in np.flatnonzero(ends - starts > LONGEST_WORD).tolist():
        found[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return found


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def windows(marks: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many neighbouring words (also across texts)."""
    if len(marks) < size:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(marks) - size + 1)
    return range_hashes(marks, starts, starts + size)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The set of word shingles of each text, as sorted hashes: with fewer words than a
    shingle the whole sequence is one, without words there is none."""
    starts, ends, of_text = words(data, offsets)
    marks = word_hashes(data, starts, ends)
    runs = windows(marks, size)
    first, last = of_text[:-1].tolist(), of_text[1:].tolist()
    sets = []
    for a, b in zip(first, last, strict=True):
        if b - a >= size:
            sets.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            sets.append(range_hashes(marks[a:b], np.array([0]), np.array([b - a])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
