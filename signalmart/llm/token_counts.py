"""Operator 1, token counts: byte-level BPE by rank-synchronous merging of ragged arrays.

Pre-tokens not seen before in a slice lie one after another in one array of symbols. In every round
each pre-token's lowest-ranked adjacent pair is merged, in all pre-tokens at once, until none is
left; the symbols that survive are the tokens. Counts are kept per blank-delimited chunk, so the
rounds only see new ones. There is no exchange.

Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from signalmart.llm import common

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
CACHE_ENTRIES = 300_000

# The pre-token pattern of byte-level BPE and Unicode's white space.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
CHUNK = regex.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")


def byte_characters() -> list[str]:
    """Character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class RankMerger:
    """Merge table of one vocabulary as sorted arrays, and the counts of chunks met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.byte_ids = np.array([vocab[c] for c in byte_characters()], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.none = len(pairs)
        self.spaced: dict[str, int] = {}
        self.bare: dict[str, int] = {}

    def survivors(self, pieces: list[bytes]) -> np.ndarray:
        """Number of tokens of every (non-empty) pre-token."""
        out = np.zeros(len(pieces), np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.arange(len(pieces))
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            pairs = symbols << 32
            pairs[:-1] |= symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pairs), self.none - 1)
            rank = np.where(self.keys[at] == pairs, self.ranks[at], self.none)
            rank[starts + lengths - 1] = self.none
            best = np.minimum.reduceat(rank, starts)
            done = best == self.none
            out[owner[done]] = lengths[done]
            sequence = np.repeat(np.arange(len(owner)), lengths)
            hit = (rank == best[sequence]) & (rank < self.none)
            # "aaa": of overlapping hits every second one counts, from the left.
            index = np.arange(len(hit))
            first = hit & ~np.concatenate(([False], hit[:-1]))
            run = np.maximum.accumulate(np.where(first, index, 0))
            hit &= (index - run) % 2 == 0
            symbols = np.where(hit, self.merged[at], symbols)
            keep = ~np.concatenate(([False], hit[:-1])) & ~done[sequence]
            lengths = np.bincount(sequence[keep], minlength=len(owner))[~done]
            owner, symbols = owner[~done], symbols[keep]
        return out

    def _learn(self, cache: dict[str, int], chunks: list[str], lead: str) -> None:
        pieces = [PRE_TOKEN.findall(lead + chunk) for chunk in chunks]
        flat = list(dict.fromkeys(p for found in pieces for p in found))
        sizes = dict(zip(flat, self.survivors([p.encode() for p in flat]).tolist(), strict=True)) if flat else {}
        for chunk, found in zip(chunks, pieces, strict=True):
            cache[chunk] = sum(map(sizes.__getitem__, found))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of every text."""
        if len(self.spaced) + len(self.bare) > CACHE_ENTRIES:
            self.spaced.clear()
            self.bare.clear()
        out, jobs, spaced, bare = [], [], set(), set()
        for text in texts:
            parts, n = [text], 0
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                n = len(parts) - 1
            plain, led = [], []
            for part in parts:
                for k, piece in enumerate(common.cut(part)):
                    if "  " in piece:
                        plain += CHUNK.findall(" " + piece if k else piece)
                    else:
                        head, *tail = piece.split(" ")
                        (led if k else plain).append(head)
                        led += tail
            spaced.update(led)
            bare.update(plain)
            jobs.append((n, plain, led))
        self._learn(self.spaced, [c for c in spaced if c not in self.spaced], " ")
        self._learn(self.bare, [c for c in bare if c not in self.bare], "")
        for n, plain, led in jobs:
            n += sum(map(self.bare.__getitem__, plain))
            out.append(n + sum(map(self.spaced.__getitem__, led)))
        return out


@lru_cache(maxsize=2)
def merger(path: str) -> RankMerger:
    return RankMerger(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every document."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def count(piece: pa.RecordBatch) -> dict:
        n_tokens = pa.array(merger(path).counts(piece.column("text").to_pylist()), pa.int64())
        return {
            "doc_id": piece.column("doc_id"),
            "n_bytes": pc.binary_length(piece.column("text")).cast(pa.int64()),
            "n_tokens": n_tokens,
            "over_limit": pc.greater(n_tokens, limit),
        }

    return common.map_slices(common.texts(docs, id_col, text_col), count, SCHEMA)
