"""Operator 6, SentencePiece encoding and decoding: exact merges by backtracking.

A sequence of pieces is the merge result of a text if every two neighbours are: re-merging the pair
gives the pair again. So pieces are taken greedily, longest match of an Aho-Corasick automaton
first, each checked against the piece before it; where none fits, the position is marked in a bit
field and the last piece gives way to a shorter one. Texts are cut where no piece of the vocabulary
reaches across (before a word mark behind anything else), and chunks met before are remembered.

Null and empty texts have no ids and decode to the empty text; repeated rows are encoded each;
extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from signalmart.llm import common

MARK = "▁"
SCHEMA = "doc_id long, ids array<int>, decoded string"
CACHE_ENTRIES = 400_000
WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceCodec:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_unknown(i) or model.is_control(i) or model.is_byte(i) for i in range(n)]
        self.silent = {i for i in range(n) if model.is_control(i)}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece reaches across words: this vocabulary can't be cut at word marks")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, (len(piece) - 1, piece))
        self.automaton.make_automaton()
        #: The next shorter match at the same place.
        self.shorter = {
            p: next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in self.ids), p[0])
            for p in self.ids
            if len(p) > 1
        }
        #: Neighbouring characters inside pieces; nothing is ever merged across any others.
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.shown = {i: p.replace(MARK, " ") for p, i in self.ids.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, list[int]] = {}
        self.known: dict[str, tuple[bytes, str]] = {}

    def merge(self, text: str) -> list[str]:
        """The definition: merge the best-scored neighbours, leftmost first, until none is a piece."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """May `right` follow `left` (or start a chunk)? Yes if merging both anew gives both."""
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            # Two that make a piece together would have been merged.
            joint = left + right
            found = (not left or joint not in self.ids) and self.merge(joint) == ([left, right] if left else [right])
            self.pairs[pair] = found
        return found

    def split(self, chunk: str) -> list[str]:
        """Pieces (or single unknown characters) of a chunk."""
        longest = list(chunk)
        for end, (before, piece) in self.automaton.iter(chunk):  # ends ascend: the longest comes last
            longest[end - before] = piece
        pairs, shorter, size = self.pairs, self.shorter, len(chunk)
        failed, pos, last, out, piece = 0, 0, "", [], longest[0]
        while pos < size:
            while piece is not None:
                end = pos + len(piece)
                if not failed >> end & 1:
                    fits = pairs.get((last, piece))
                    if self.fits(last, piece) if fits is None else fits:
                        break
                piece = shorter.get(piece)
            if piece is None:
                failed |= 1 << pos
                piece = out.pop()
                pos -= len(piece)
                last = out[-1] if out else ""
                piece = shorter.get(piece)
            else:
                out.append(piece)
                pos, last = end, piece
                if pos < size:
                    piece = longest[pos]
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        ids: list[int] = []
        # A last character that no piece joins to the one before it is a part of its own.
        cuts = (chunk[:-1], chunk[-1]) if len(chunk) > 1 and chunk[-2:] not in self.joined else (chunk,)
        for part in cuts:
            found = self.parts.get(part)
            if found is None:
                pieces = self.split(part)
                try:
                    found = [self.ids[p] for p in pieces]
                except KeyError:  # a character without a piece is its bytes
                    found = [i for p in pieces for i in ([self.ids[p]] if p in self.ids else map(self.bytes.get, p.encode()))]
                if len(self.parts) > CACHE_ENTRIES:
                    self.parts.clear()
                self.parts[part] = found
            ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the word mark before the first word is not part of it."""
        parts, held, text_begun = [], bytearray(), False
        for i in [*ids, None]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                text_begun = True
                continue
            if held:
                parts.append(_lenient(bytes(held)))
                held.clear()
            if i is None or i in self.silent:
                continue
            piece = self.pieces[i]
            if not text_begun and piece.startswith(MARK):
                piece = piece[1:]
            text_begun = True
            parts.append(piece.replace(MARK, " "))
        return "".join(parts)

    def surface(self, ids: list[int]) -> str:
        """Decoded text with its leading word mark as a blank."""
        try:
            return "".join([self.shown[i] for i in ids])
        except KeyError:  # bytes: read them together
            return self.decode([self.ids[MARK], *ids])

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text with the word mark before it; none of the empty text."""
        if not text:
            return []
        out = []
        for piece in common.cut(text):
            if "  " in piece or piece[0] == " " or MARK in text:
                return WORDS.findall(MARK + text.replace(" ", MARK))
            out += piece.split(" ")
        return [MARK + word for word in out]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """32-bit ids and decoded text of every text."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known, ids, decoded = self.known, [], []
        for text in texts:
            found = []
            for chunk in self.chunks(text):
                entry = known.get(chunk)
                if entry is None:
                    own = self.encode_chunk(chunk)
                    entry = (array("i", own).tobytes(), self.surface(own))
                    known[chunk] = entry
                found.append(entry)
            ids.append(b"".join([e[0] for e in found]))
            decoded.append("".join([e[1] for e in found])[1:])
        return ids, decoded


def _lenient(data: bytes) -> str:
    """UTF-8 where it is valid; every other byte becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError as error:
        head = data[: error.start].decode()
        return head + "�" + _lenient(data[error.start + 1 :])


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_decode(
    docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, ids, decoded` of every document: its piece ids, and the text those decode to."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(piece: pa.RecordBatch) -> dict:
        ids, decoded = codec(path).encode(piece.column("text").to_pylist())
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(ids), np.int32))
        return {
            "doc_id": piece.column("doc_id"),
            "ids": pa.ListArray.from_arrays(pa.array(ends), values),
            "decoded": pa.array(decoded, pa.string()),
        }

    return common.map_slices(common.texts(docs, id_col, text_col), run, SCHEMA)
