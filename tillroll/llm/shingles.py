"""Hashed word shingles of whole texts, many texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
_U = np.uint64
_random = np.random.Generator(np.random.PCG64(20240607))
#: A random 64-bit number for each byte, and the base of the positional hash of a word with its inverse modulo 2**64.
BYTE = _random.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Factors of the words of a shingle.
PLACE = _random.integers(1, 1 << 63, WORDS + 1, dtype=_U) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for n bytes; kept for usual lengths."""
    size = max(1 << 22, n)
    if size > 1 << 22:
        return _powers(BASE, size), _powers(INVERSE, size)
    if size not in _tables:
        _tables[size] = _powers(BASE, size), _powers(INVERSE, size)
    return _tables[size]


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A-Z are lower-cased and words are cut at ASCII white space.  Shingles are of WORDS words; a text with fewer words
    has their whole sequence as its only one, a text without words has none.
    """
    parts = [text.encode("utf-8", "surrogatepass").lower() for text in texts]
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    stops = np.cumsum([len(p) + 1 for p in parts])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _tables_for(len(data))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(BYTE[data] * power[: len(data)], dtype=_U)))
    words = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))
    n = len(words)
    whole = np.zeros(max(0, n - WORDS + 1), _U)
    for i in range(WORDS):
        whole += words[i : n - WORDS + 1 + i] * PLACE[i] if n >= WORDS else whole
    whole = mix(whole)
    first = np.concatenate(([0], np.searchsorted(starts, stops)))
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            out.append(np.unique(whole[a : b - WORDS + 1]))
        elif b > a:
            short = np.sum(words[a:b] * PLACE[: b - a], dtype=_U, keepdims=True) + PLACE[WORDS:] * _U(b - a)
            out.append(mix(short))
        else:
            out.append(np.zeros(0, _U))
    return out
