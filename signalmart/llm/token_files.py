"""Operator 2, token ids as Parquet list columns.

`write` range-partitions the documents by id, encodes each partition in order and writes
`(doc_id, n_tokens, tokens)`: dictionary-encoded list column, delta encoding for the
integers that do not repeat, bounded row groups and pages, page indexes. A reader that wants
lengths, places or checksums reads three narrow columns, and a range of documents is found by the
row groups' and pages' doc_id bounds. `read` gives the documents back with their place in the stream.

Null and empty texts have the end id only; rows that repeat a doc_id are all kept, ordered by
their place in the files within the id; null ids come first; extra columns are not read; an empty table
writes an empty folder.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalmart.llm import common

SCHEMA = "doc_id long, n_tokens long, tokens array<int>"
#: Bytes of each half of the memory, with what an entry takes besides its piece and ids.
CACHE_BYTES, ENTRY_BYTES = 48 << 20, 250
#: Bytes of text looked at together, and new pieces handed to the library together.
SLICE_BYTES, AT_ONCE = 4 << 20, 100
#: What `CUTS` holds for: every run of letters, every digit and every run of other marks is a word, save that
#: an apostrophe takes some endings with it. Texts with special tokens, all of which hold `MARK`, are not cut.
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
MARK = "<|"
#: Letters that stay letters, one for one, whatever the normalizer does to them.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile("[a-zß-öø-ÿ]+")
#: Between a letter and an ASCII digit or mark, and between one of these, but an apostrophe, and a letter. Nothing
#: composes across, since neither an ASCII character nor a letter of these is a combining one.
CUTS = (rf"([{LETTERS}])([!-@\[-`{{-~])", rf"([!-&(-@\[-`{{-~])([{LETTERS}])")
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.columnindex.truncate.length": "64",
}


class ChunkEncoder:
    """The tokenizers library behind a bounded memory of the pieces texts are made of.

    White space is dropped by this tokenizer and no rule of it looks across, so the ids of a text are those
    of its blank-delimited chunks in turn. A chunk is cut once more at `CUTS`, where the tokenizer parts it
    as well, so that a word is one piece with and without the marks around it; under another tokenizer it
    stays whole. The memory has a recent and an older half; a piece met again moves to the recent one, and
    when that is full the older one goes, so frequent pieces stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0
        described = json.loads(self.library.to_str())
        self.cuts = RULES.items() <= described.items() and all(MARK in t["content"] for t in described["added_tokens"])
        vocabulary = self.library.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = described["model"].get("end_of_word_suffix")
        if self.cuts and suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # The same without the steps that leave lower-case words as they are.
        self.words = Tokenizer(self.library.model)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])

    def _keep(self, pieces: list[str], ids: list[bytes]) -> None:
        self.size += ENTRY_BYTES * len(pieces) + sum(map(len, pieces)) + sum(map(len, ids))
        self.recent.update(zip(pieces, ids, strict=True))
        if self.size > CACHE_BYTES:
            self.recent, self.older, self.size = {}, self.recent, 0

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch(pieces, add_special_tokens=False)
        return [np.array(encoding.ids, "<i4").tobytes() for encoding in encoded]

    def _as_one_text(self, words: list[str]) -> list[bytes]:
        """Lower-case words, in one call: the last id of each is one that closes a word, and no other is."""
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<i4")
        ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
        if len(ends) != len(words) or ends[-1] != ids.nbytes:
            return self._one_by_one(words)
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, 32 bits each."""
        found: list = list(map(self.recent.get, pieces))
        again, words, others = [], [], []
        for place in [place for place, ids in enumerate(found) if ids is None]:
            found[place] = self.older.get(pieces[place])
            if found[place] is not None:
                again.append(place)
            elif self.cuts and WORD.fullmatch(pieces[place]):
                words.append(place)
            else:
                others.append(place)
        for places, encode in ((again, None), (words, self._as_one_text), (others, self._one_by_one)):
            for start in range(0, len(places), AT_ONCE):
                part = places[start : start + AT_ONCE]
                texts = [pieces[place] for place in part]
                ids = encode(texts) if encode else [found[place] for place in part]
                for place, of_piece in zip(part, ids, strict=True):
                    found[place] = of_piece
                self._keep(texts, ids)
        return found

    def _cut(self, chunks: pa.Array) -> pa.ListArray:
        """The pieces of every chunk."""
        if not self.cuts:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(chunks) + 1), pa.int32()), chunks)
        spaced = chunks
        for pattern in CUTS:
            spaced = pc.replace_substring_regex(spaced, pattern, r"\1 \2")
        return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(chunks, MARK), chunks, spaced))

    def _lowered(self, pieces: pa.Array) -> pa.Array:
        """Words in lower case, as the normalizer has them; other pieces as they are."""
        if not self.cuts:
            return pieces
        return pc.if_else(pc.match_substring_regex(pieces, f"^[{LETTERS}]+$"), pc.utf8_lower(pieces), pieces)

    def encode(self, texts: pa.Array, end: np.ndarray) -> pa.ListArray:
        """Ids of every text, with those of `end` behind each."""
        lists = pc.ascii_split_whitespace(texts)
        chunks = lists.flatten().dictionary_encode()
        parts = self._cut(chunks.dictionary)
        pieces = self._lowered(parts.flatten()).dictionary_encode()
        found = self.ids_of(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, ends = _laid_out(np.frombuffer(b"".join(found), "<i4"), lengths, pieces.indices.to_numpy())
        upto = np.concatenate(([0], ends))[np.cumsum(pc.list_value_length(parts).to_numpy())]
        lengths = np.append(np.diff(upto, prepend=0), len(end))
        n_chunks = pc.list_value_length(lists).to_numpy()
        codes = np.insert(chunks.indices.to_numpy(), np.cumsum(n_chunks), len(lengths) - 1)
        ids, ends = _laid_out(np.concatenate((ids, end)), lengths, codes)
        offsets = np.concatenate(([0], ends[np.cumsum(n_chunks + 1) - 1]))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def _laid_out(values: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values`, one of each of `lengths`, in the order of `codes`, and where each ends."""
    begins = np.cumsum(lengths) - lengths
    sizes = lengths[codes]
    ends = np.cumsum(sizes)
    at = np.arange(int(sizes.sum()), dtype=np.int32)
    at += np.repeat((begins[codes] - (ends - sizes)).astype(np.int32), sizes)
    return values[at], ends


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(path)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int | None = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Token files of all documents, in ascending doc_id order across and within files."""
    vocabulary = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([] if end_id is None else [end_id], np.int32)

    def encode(batches):
        for piece in common.gathered(batches, SLICE_BYTES):
            tokens = encoder(vocabulary).encode(piece.column("text"), end)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id"),
                    "n_tokens": pc.list_value_length(tokens).cast(pa.int64()),
                    "tokens": tokens,
                }
            )
            pa.default_memory_pool().release_unused()

    narrow = common.texts(docs, id_col, text_col)
    dealt = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    dealt.mapInArrow(encode, SCHEMA).write.options(**LAYOUT).parquet(path)


def _checksums(tokens: DataFrame) -> DataFrame:
    def crc(batches):
        for batch in batches:
            lists = batch.column("tokens")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": batch.column("file"),
                    "row": batch.column("row"),
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": batch.column("n_tokens"),
                    "ids_crc32": pa.array(
                        [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)],
                        pa.int64(),
                    ),
                }
            )

    return tokens.mapInArrow(crc, "file string, row long, doc_id long, n_tokens long, ids_crc32 long")


def tokens_of(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """`doc_id, n_tokens, tokens` of an id range; row groups and pages outside it are skipped."""
    found = spark.read.schema(SCHEMA).parquet(path)
    if lo is not None:
        found = found.where(F.col("doc_id") >= lo)
    return found if hi is None else found.where(F.col("doc_id") <= hi)


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document, computed from the files.

    Files hold disjoint ranges, so a running sum per file and one over the (few) files' totals give
    the place of each document in the whole stream.
    """
    stored = spark.read.schema(SCHEMA).parquet(path).withColumns(
        {"file": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index")}
    )
    per_file = stored.groupBy("file").agg(
        F.sum("n_tokens").alias("total"), F.min("doc_id").alias("first_id"),
        F.count(F.when(F.col("doc_id").isNull(), 1)).alias("n_null"),
    )
    before = per_file.select(
        "file",
        F.coalesce(
            F.sum("total").over(
                Window.orderBy(F.col("n_null").desc(), F.col("first_id").asc_nulls_first(), "file")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("before"),
    )
    in_file = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        _checksums(stored)
        .withColumn("inner", F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0)))
        .join(before, "file")
        .select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
    )
