"""Byte-level and word-level ids against the libraries, and packing."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from shopworth.llm import byte_bpe, packing
from shopworth.llm.queries import END_ID, op1_packing, op7_byte_bpe, tokenizer_file
from shopworth.llm.tokens import byte_bpe_json, byte_encoder, read_ranks, word_encoder

DATA = "/root/testdata/sf0.001"
RANKS, WORDS = tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_file("word_bpe_49k.json")
PIECES = [" ", "  ", "\n", "\t", "a", "B", "é", "É", "'s", "'", "1", "23", ".", ",", "!!", "İ", "K", "ſ", "̇", "\x85", "\xa0", "\x1c"]
PIECES += ["中", "文", "ǰ", "J̌", "Σ", "ς", "​", "😀", "ÀB", "<|endoftext|>", "ß", "ﬁ", "　", "it's", "x-y", "́", "word", "the,", "end.##"]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return tokenizer


def packed_ids(ids):
    return np.array(ids, "<u4").tobytes()


def test_encoders_equal_the_libraries(reference, words):
    draw = random.Random(1)
    by_byte = byte_encoder(byte_bpe_json(read_ranks(RANKS)))
    by_word = word_encoder(words.to_str())
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 12))) for _ in range(4000)]
    texts += ["x" * 30_000, "long words " * 120_000, " " * 5000 + "a"]
    for text in texts:
        assert by_byte.encode(text) == packed_ids(reference.encode_ordinary(text))
        assert by_word.encode(text) == packed_ids(words.encode(text, add_special_tokens=False).ids)


def test_op7_whole_table(spark, reference):
    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    rows = op7_byte_bpe(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed_ids(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def spans_of(text, ids, reference):
    """First and last character (end exclusive) that a token has a byte of, by hand."""
    of_byte = [i for i, c in enumerate(text) for _ in c.encode()]
    starts, ends, at = [], [], 0
    for token in ids:
        size = len(reference.decode_single_token_bytes(token))
        starts.append(of_byte[at])
        ends.append(of_byte[at + size - 1] + 1)
        at += size
    return starts, ends


def test_op7_offsets_of_the_whole_table(spark, reference):
    texts = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    spans = [(r.doc_id, *spans_of(r.text or "", reference.encode_ordinary(r.text or ""), reference)) for r in texts]
    expected = spark.createDataFrame(spans, "doc_id long, starts array<int>, ends array<int>")
    expected = expected.select("doc_id", F.xxhash64("starts", "ends").alias("spans_hash"))
    found = op7_byte_bpe(spark, DATA).select("doc_id", "spans_hash")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_encoding_by_parts(spark, documents, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 20)
    texts = ["a b", None, "one text that is longer than a part", "", "é" * 15, "c", "d e f", None]
    found = byte_bpe.encode(documents(list(enumerate(texts))).coalesce(1), RANKS).collect()
    assert {r.doc_id: bytes(r.ids) for r in found} == {
        i: packed_ids(reference.encode_ordinary(t or "")) for i, t in enumerate(texts)
    }
    assert {r.doc_id: (r.starts, r.ends) for r in found} == {
        i: spans_of(t or "", reference.encode_ordinary(t or ""), reference) for i, t in enumerate(texts)
    }
    batch = pa.record_batch([pa.array([None if t is None else t for t in texts])], names=["text"])
    parts = list(byte_bpe._parts(batch, 20))
    assert [p.num_rows for p in parts] == [2, 1, 1, 1, 3] and pa.Table.from_batches(parts).num_rows == len(texts)
    empty = byte_bpe.encode(documents([]), RANKS)
    assert empty.count() == 0 and byte_bpe.decode(empty, RANKS).count() == 0


def test_offsets_and_decoding(documents, reference):
    texts = ["a 😀 naïve café", "", None, "😀😀", "plain words here", "plain words here"]
    df = byte_bpe.encode(documents(list(enumerate(texts))), RANKS)
    assert "a.b" in df.columns and "score" in df.columns
    for r in df.collect():
        text = texts[r.doc_id] or ""
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        data, at = text.encode(), 0
        for token, start, end in zip(ids, r.starts, r.ends, strict=True):
            size = len(reference.decode_single_token_bytes(token))
            covered = data[at : at + size]
            assert covered in text[start:end].encode()
            at += size
    back = byte_bpe.decode(df.select("doc_id", "ids"), RANKS).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t in enumerate(texts)}


def test_split_characters_decode_to_replacements(spark, reference):
    ids = reference.encode_ordinary("中")
    rows = [(packed_ids(ids),), (packed_ids(ids[:1]),), (None,)]
    out = byte_bpe.decode(spark.createDataFrame(rows, "ids binary"), RANKS).collect()
    assert [r.text for r in out] == ["中", "�", ""] or len(ids) == 1


def check_pieces(rows, texts, words, length):
    whole = {i: packed_ids([*words.encode(t or "", add_special_tokens=False).ids, END_ID]) for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == whole.keys()
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(whole[i]) // 4
            assert r.ids_crc32 == zlib.crc32(whole[i][4 * at : 4 * (at + r.length)])
            at += r.length
        assert 4 * at == len(whole[i])
    for n, pieces in by_sequence.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or n == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_op1_whole_table(spark, words):
    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    check_pieces(op1_packing(spark, DATA).collect(), texts, words, 4096)


def test_packing_edges(spark, documents, words):
    texts = {1: None, 2: "", 3: "one two", 4: "one two", 5: "many words " * 500, 6: "x", 7: "İ ǰ ſ é"}
    df = packing.pack(documents(list(texts.items())).repartition(3), WORDS, END_ID, 64)
    assert "a.b" in df.columns and "text" not in df.columns
    check_pieces(packing.with_crc32(df).collect(), texts, words, 64)
    full = packing.sequences(df, 64, 0).collect()
    assert all(len(r.ids) == 256 for r in full) and sum(r.n_ids for r in full) == sum(r.length for r in df.collect())
    assert packing.pack(documents([]), WORDS, END_ID, 64).count() == 0


def test_repeated_rows_are_documents_of_their_own(documents):
    rows = packing.pack(documents([(1, "a b"), (1, "a b")]), WORDS, END_ID, 64).collect()
    assert sorted(r.offset for r in rows) == [0, 3]
