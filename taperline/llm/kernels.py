"""Array code over UTF-8 bytes that several operators use inside their tasks."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that only white space ends.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words made of digits, letters a-z and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1), or those of its inverse, modulo 2**64."""
    name = "inverse" if inverse else "base"
    known = _TABLES.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 20), _INVERSE if inverse else _BASE, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 1 << 22:
            _TABLES[name] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of bytes follows; one entry more than bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(len(data)), out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[starts:ends]; equal stretches have equal hashes wherever they stand."""
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in joined texts, and each text's first word; no word crosses texts."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = alphabet[data]
    borders = np.zeros(len(data) + 1, dtype=bool)
    borders[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | borders))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | borders))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the lower-cased texts, and each text's first word (one entry more than texts)."""
    lowered = LOWER[data]
    starts, ends, first = words(lowered, offsets, alphabet)
    return stretch_hash(prefix_hash(lowered), starts, ends), first
