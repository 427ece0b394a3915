"""Fuzzy hashing with the perfect binary Golay code [23, 12, 7].

Every 23-bit word lies within 3 bits of exactly one codeword. A word's keys
are the indices of all codewords within 4 bits of it: one if it is within 2
bits of its codeword, six if it is 3 bits away. Two words that differ in at
most 2 bits share a key: the word between them is within 3 bits of a codeword,
which is then within 4 bits of both.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH = 23
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
NO_KEY = -1


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    r = words.astype(np.int64).copy()
    for bit in range(LENGTH - 1, 10, -1):
        r ^= ((r >> bit) & 1) * (GENERATOR << (bit - 11))
    return r


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome its error (at most 3 bits), and the up to six
    differences from that codeword's index to the indices of its keys."""
    errors = np.array([sum(1 << i for i in c) for n in range(4) for c in combinations(range(LENGTH), n)])
    error_of = np.zeros(2048, dtype=np.int64)
    error_of[syndromes(errors)] = errors
    data = np.arange(4096) << 11
    code = data ^ syndromes(data)
    light = code[np.bitwise_count(code) == 7]
    keys = np.full((2048, 6), NO_KEY, dtype=np.int64)
    keys[:, 0] = 0
    for s in np.flatnonzero(np.bitwise_count(error_of) == 3):
        keys[s, 1:] = light[(light & error_of[s]) == error_of[s]] >> 11
    return error_of, keys


ERROR, NEAR = _tables()


def keys(words: np.ndarray) -> np.ndarray:
    """An (n, 6) array of key indices (0..4095), ``NO_KEY`` where unused."""
    s = syndromes(words)
    own = (words ^ ERROR[s]) >> 11
    near = NEAR[s]
    return np.where(near == NO_KEY, NO_KEY, own[:, None] ^ near)
