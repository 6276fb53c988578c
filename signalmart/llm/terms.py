"""Words of many texts as byte spans with their hashes, told from given words byte by byte (numpy, in tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from signalmart.llm import wordhash


def _hashes(part: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of every span of lower-cased bytes."""
    begins = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    bytes_ = part[np.repeat(first, lengths) + place].astype(np.uint64) + np.uint64(1)
    powers = wordhash._powers(int(lengths.max()))
    total = np.add.reduceat(bytes_ * powers[place], begins)
    return wordhash.mix(total ^ (lengths.astype(np.uint64) << np.uint64(56)))


def spans(data: np.ndarray, block: int = wordhash.BLOCK) -> Iterator[tuple[np.ndarray, ...]]:
    """Lower-cased block, its place, and the words in it: first byte, length, hash. `data` ends in no word byte."""
    start = 0
    while start < len(data):
        stop = min(len(data), start + block)
        while wordhash.IS_WORD[data[stop - 1]]:
            stop += 1
        part = data[start:stop]
        edge = np.diff(np.concatenate(([0], wordhash.IS_WORD[part].view(np.int8))))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            lower = wordhash.LOWER[part]
            yield lower, start, first, last - first, _hashes(lower, first, last - first)
        start = stop


class Vocabulary:
    """Given distinct words; finds which of them a text's words are, exactly."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        hashes = _hashes(self.bytes, self.begins, self.lengths) if words else np.zeros(0, np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.sorted = hashes[self.order]
        if len(np.unique(hashes)) < len(words):
            raise ValueError("two words of the vocabulary have one hash")

    def find(
        self, part: np.ndarray, first: np.ndarray, lengths: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are words of the vocabulary, and which words: hashes propose, bytes decide."""
        if not self.words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        hit = np.flatnonzero(self.sorted[place] == hashes)
        word = self.order[place[hit]]
        same = self.lengths[word] == lengths[hit]
        hit, word = hit[same], word[same]
        if not len(hit):
            return hit, word
        size = self.lengths[word]
        begins = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(begins, size)
        differs = part[np.repeat(first[hit], size) + at] != self.bytes[np.repeat(self.begins[word], size) + at]
        same = np.add.reduceat(differs.astype(np.int64), begins) == 0
        return hit[same], word[same]
