"""Words of many texts as arrays of 64-bit hashes, and minimum windows over them (numpy, in tasks)."""

from __future__ import annotations

import numpy as np

BLOCK = 4 << 20
P = np.uint64(0x9E3779B97F4A7C15)
Q = np.uint64(0xC2B2AE3D27D4EB4F)

_CODES = np.arange(256)
#: Word bytes: digits, letters, everything beyond ASCII; A-Z count as a-z.
IS_WORD = ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)
IS_WORD |= (_CODES >= 0x41) & (_CODES <= 0x5A)
LOWER = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 32, _CODES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * P
    x = (x ^ (x >> np.uint64(29))) * Q
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, P, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and how many words each text has."""
    counts = np.zeros(len(texts), np.int64)
    hashes = []
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    start = 0
    while start < len(data):
        stop = min(len(data), start + BLOCK)
        while IS_WORD[data[stop - 1]]:  # the last byte is none
            stop += 1
        part = data[start:stop]
        inside = IS_WORD[part]
        edge = np.diff(np.concatenate(([0], inside.view(np.int8))))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            lengths = last - first
            bytes_ = LOWER[part[inside]].astype(np.uint64) + np.uint64(1)
            begins = np.cumsum(lengths) - lengths
            place = np.arange(len(bytes_)) - np.repeat(begins, lengths)
            total = np.add.reduceat(bytes_ * _powers(int(lengths.max()))[place], begins)
            hashes.append(mix(total ^ (lengths.astype(np.uint64) << np.uint64(56))))
            counts += np.bincount(np.searchsorted(ends, first + start, "right"), minlength=len(texts))
        start = stop
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def count_words(texts: list[bytes]) -> np.ndarray:
    """How many words each text has."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = IS_WORD[data]
    first = inside & ~np.concatenate(([False], inside[:-1]))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.add.reduceat(first.astype(np.int64), ends - [len(t) + 1 for t in texts])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from every place on that has k words behind it."""
    n = max(0, len(hashes) - k + 1)
    total = np.zeros(n, np.uint64)
    for t in range(k):
        total = total * Q + hashes[t : t + n]
    return mix(total)


def winnow(values: np.ndarray, w: int) -> np.ndarray:
    """For every window of w values the place of its smallest, the last one of equals."""
    n = max(0, len(values) - w + 1)
    best, at = values[:n].copy(), np.arange(n)
    for t in range(1, w):
        smaller = values[t : t + n] <= best
        best = np.where(smaller, values[t : t + n], best)
        at[smaller] = np.flatnonzero(smaller) + t
    return at
