"""Hashed n-gram and word features of whole texts, with numpy."""

from __future__ import annotations

import numpy as np

_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[48:58], _SHAPES[65:91], _SHAPES[97:123], _SHAPES[9:14] = 57, 65, 97, 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PRIME = 0x100000001B3
_INVERSE = pow(_PRIME, -1, 1 << 64)
_CHUNK = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def letters(text: str) -> np.ndarray:
    """Bytes of the text in lower case; what is not a letter or a byte of a
    longer character is one space, also at both ends."""
    a = _LETTERS[np.frombuffer(b" " + text.lower().encode() + b" ", dtype=np.uint8)]
    keep = np.ones(len(a), dtype=bool)
    keep[1:] = (a[1:] != 32) | (a[:-1] != 32)
    return a[keep]


def ngrams(a: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket (0 .. 2**bits - 1) of every run of n bytes."""
    if len(a) < n:
        return np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        h = np.full(len(a) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h << np.uint64(8)) | a[i:len(a) - n + 1 + i]
        h ^= h >> np.uint64(29)
        return ((h * _ODD) >> np.uint64(64 - bits)).astype(np.int64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        with np.errstate(over="ignore"):
            step = lambda x: np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(x))]))
            _POWERS[size] = step(_PRIME), step(_INVERSE)
    return _POWERS[size]


def words(a: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of every word (run of bytes that are not white space): a
    polynomial hash of its bytes, from differences of running sums."""
    gap = _SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    first, last = edge[0::2], edge[1::2]
    if not len(first):
        return np.zeros(0, dtype=np.int64)
    up, down = _powers(len(a) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)])])
        h = (sums[last] - sums[first]) * down[first]
        h ^= h >> np.uint64(31)
        return ((h * _ODD) >> np.uint64(64 - bits)).astype(np.int64)


def chunks(text: str, size: int = _CHUNK):
    """Parts of a long text, cut at a space or line end where there is one, so
    that working memory stays bounded."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at + 1, at + size), text.rfind("\n", at + 1, at + size))
        cut = cut if cut > at else at + size
        yield text[at:cut]
        at = cut
    yield text[at:]


def shape(text: str) -> np.ndarray:
    """The text as classes: one A for a run of capitals, a for other letters,
    9 for digits, one space for white space; other characters stay, as one of
    a run of equal ones (beyond ASCII: one mark)."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    low = text.lower()
    lower = np.frombuffer(low.encode("utf-32-le"), dtype="<u4") if len(low) == len(text) else code
    out = np.where(code < 128, code, 97).astype(np.uint8)
    out = _SHAPES[out]
    out[code != lower] = 65
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = out[1:] != out[:-1]
    return out[keep]
