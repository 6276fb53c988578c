"""Operators 1, 2 and 6 against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer, pre_tokenizers

from signalmart.llm import piece_codec, queries, token_counts, token_files

ALPHABET = [*"ab'sth  \n\t,.é▁ñ漢字🙂ćΣ0123", "<|endoftext|>", "'ll", "  ", "   ", "<s>", "<0x41>", "the", "▁▁", "İ", "\x00"]


@pytest.fixture(scope="module")
def noise():
    rnd = random.Random(7)
    found = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    return [*found, "a" * 5000, "ab" * 3000, " " * 1000, "\n" * 500, " a", "a ", "  a  ", "", "x y " * 400_000]


def test_counts_are_the_librarys(noise):
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(noise, add_special_tokens=False)]
    assert token_counts.RankMerger(path).counts(noise) == want


def test_ids_are_the_librarys(noise):
    path = public_tokenizers.path("word_bpe_49k.json")
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(noise, add_special_tokens=False)]
    encoder = token_files.ChunkEncoder(path)
    assert encoder.encode(pa.array(noise), np.zeros(0, np.int32)).to_pylist() == want
    with_end = encoder.encode(pa.array(noise[:2000]).slice(500), np.array([2], np.int32))
    assert with_end.to_pylist() == [[*ids, 2] for ids in want[500:2000]]


def test_a_full_memory_keeps_what_is_met_again(noise, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(token_files, "CACHE_BYTES", 200_000)
    encoder = token_files.ChunkEncoder(path)
    none = np.zeros(0, np.int32)
    want = [e.ids for e in encoder.library.encode_batch(noise, add_special_tokens=False)]
    got = [encoder.encode(pa.array(["the", *noise[i : i + 50]]), none).to_pylist()[1:] for i in range(0, 3000, 50)]
    assert sum(got, []) == want[:3000]
    assert "the" in encoder.recent or "the" in encoder.older
    assert len(encoder.recent) + len(encoder.older) < 2000


def test_a_word_is_one_piece_whatever_marks_it_has():
    encoder = token_files.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    text = "harbour harbour, (Harbour) harbour's HARBOUR-harbour 7harbour. \"harbour\" état État, (état)"
    want = encoder.library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(pa.array([text]), np.zeros(0, np.int32)).to_pylist() == [want]
    held = [piece.lower() for piece in encoder.recent]
    assert sum("harbour" in piece for piece in held) == sum("état" in piece for piece in held) == 1


def test_cuts_change_no_ids():
    """Marks that compose, letters that do not stay single, endings after apostrophes, special tokens."""
    library = Tokenizer.from_file(path := public_tokenizers.path("word_bpe_49k.json"))
    parts = [*"aAsTvJhéÉÿß×ªİΣ,.'-<|>09½²漢\u0301\u030c\u0307\u0338 \xa0\x85\x1c", "'s", "''ll", "<|endoftext|>", "<|ENDOFTEXT|>"]
    rnd = random.Random(9)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(5000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_files.ChunkEncoder(path).encode(pa.array(texts), np.zeros(0, np.int32)).to_pylist() == want


def test_another_tokenizer_is_not_cut(tmp_path):
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    other.save(path := f"{tmp_path}/other.json")
    texts = ["harbour, harbour's (harbour) l'état,", "", "a1,b2"]
    want = [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]
    assert token_files.ChunkEncoder(path).encode(pa.array(texts), np.zeros(0, np.int32)).to_pylist() == want


def test_start_is_the_place_in_the_files(spark, tmp_path):
    """Rows that share an id stand where the files have them, whatever their length."""
    rows = [(5, "a b c d e f g"), (5, "one two"), (6, "x"), (5, "a b c d e f g"), (None, "n"), (5, None)]
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/t")
    stream = []
    for file in sorted(tmp_path.glob("t/part-*.parquet")):
        for tokens in pq.read_table(file).column("tokens").to_pylist():
            stream += tokens
    for r in token_files.read(spark, f"{tmp_path}/t").collect():
        ids = np.array(stream[r.start : r.start + r.n_tokens], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and ids[-1] == 2


def test_pieces_are_the_librarys(noise):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, decoded = piece_codec.PieceCodec(path).encode(noise)
    want = library.encode(noise)
    assert [np.frombuffer(x, np.int32).tolist() for x in ids] == want
    assert decoded == [library.decode(x) for x in want]


def test_any_ids_decode_as_the_librarys():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.PieceCodec(path)
    rnd = random.Random(3)
    for _ in range(1000):
        ids = [rnd.choice([1, 2, 3, 66, 200, 234, 259, 300, 1000, 29871, 29946]) for _ in range(rnd.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids)


def test_backtracking_is_merging():
    own = piece_codec.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    rnd = random.Random(5)
    for _ in range(2000):
        chunk = "▁" + "".join(rnd.choice("aeinorst,.") for _ in range(rnd.randint(0, 14)))
        assert own.split(chunk) == own.merge(chunk)


def test_hostile_rows(spark, hostile, hostile_docs, no_docs, tmp_path):
    texts = [(i, t or "") for i, t, *_ in hostile]
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(i), len(t.encode()), len(one.encode(t, add_special_tokens=False).ids)) for i, t in texts)
    got = token_counts.token_counts(hostile_docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)

    two = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    token_files.write(hostile_docs, f"{tmp_path}/tokens")
    read = token_files.read(spark, f"{tmp_path}/tokens").collect()
    crc = lambda t: zlib.crc32(np.array([*two.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in read) == sorted((str(i), crc(t)) for i, t in texts)
    read.sort(key=lambda r: r.start)
    assert [r.start for r in read] == np.cumsum([0, *(r.n_tokens for r in read)])[:-1].tolist()
    assert [r.doc_id if r.doc_id is not None else -1 for r in read] == sorted(r.doc_id if r.doc_id is not None else -1 for r in read)
    assert {r.doc_id for r in token_files.tokens_of(spark, f"{tmp_path}/tokens", 3, 5).collect()} == {3, 4, 5}

    digests = queries.piece_digests(piece_codec.encode_decode(hostile_docs)).collect()
    six = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((str(i), len(x := six.encode(t)), sha(",".join(map(str, x))), sha(six.decode(x))) for i, t in texts)
    assert sorted((str(r[0]), *r[1:]) for r in digests) == want

    assert token_counts.token_counts(no_docs).count() == 0
    token_files.write(no_docs, f"{tmp_path}/none")
    assert token_files.read(spark, f"{tmp_path}/none").count() == 0
    assert piece_codec.encode_decode(no_docs).count() == 0
