import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from termloom.llm import bpe, token_counts
from termloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PIECES = list("aaabcdehrst  '\n\t.,19ΣσİßÉé́ǅ  \u0085\x1c\x1f\x00中文字🙂‍") + [
    "<|endoftext|>", "<|startoftext|>", "'ll", "'re", "the", "ing", " and", "Straße", "ΑΣ",
]
EDGES = ["", "   ", "\n", "a" * 3000, "ab " * 2000, "no<|endoftext|>gap", "<|endoftext|><|endoftext|>"]


def texts():
    rng = random.Random(9)
    return EDGES + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 80))) for _ in range(3000)]


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


def test_ids_and_labels_are_those_of_the_library(word_bpe):
    codec = bpe.WordCodec(open(public_tokenizers.path(bpe.VOCABULARY), encoding="utf-8").read())
    for text in texts():
        ids = codec.encode(text)
        want = word_bpe.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert codec.decode(ids) == word_bpe.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("chunk", [1, 7, 50, 65_536])
def test_counts_are_those_of_the_library_however_a_text_is_cut(byte_bpe, monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", chunk)
    counter = token_counts.TokenCounter(open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8").read())
    for text in texts()[: 3000 if chunk > 1 else 800]:
        assert counter.count(text) == len(byte_bpe.encode(text, add_special_tokens=False).ids)


def test_every_character_is_read_as_the_library_reads_it(word_bpe, byte_bpe):
    codec = bpe.WordCodec(open(public_tokenizers.path(bpe.VOCABULARY), encoding="utf-8").read())
    counter = token_counts.TokenCounter(open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8").read())
    # Without the ideographs of the astral planes and private characters, which are all alike.
    points = [p for p in range(0x20000) if not 0xD800 <= p < 0xF900] + list(range(0x2FA00, 0x2FA20)) + list(range(0xE0000, 0xE0200))
    texts = [f"a{chr(p)}b {chr(p)}1'S" for p in points]
    coded = word_bpe.encode_batch(texts, add_special_tokens=False)
    counted = byte_bpe.encode_batch(texts, add_special_tokens=False)
    for text, want, count in zip(texts, coded, counted):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == want.ids, ascii(text)
        assert counter.count(text) == len(count.ids), ascii(text)


def test_random_strings_of_newer_characters(word_bpe, byte_bpe):
    codec = bpe.WordCodec(open(public_tokenizers.path(bpe.VOCABULARY), encoding="utf-8").read())
    counter = token_counts.TokenCounter(open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8").read())
    rng = random.Random(10)
    pieces = PIECES + list("\u1c89\ua7cb\U00010d50\u0c5c\u0378\U0001fae9")
    for _ in range(2000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == word_bpe.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(byte_bpe.encode(text, add_special_tokens=False).ids)


def test_small_tables_of_the_transducer_change_nothing(byte_bpe, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_STATES", 5)
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 3)
    counter = token_counts.TokenCounter(open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8").read())
    for text in texts()[:500]:
        assert counter.count(text) == len(byte_bpe.encode(text, add_special_tokens=False).ids)


def test_queries_over_whole_tables(spark, word_bpe, byte_bpe):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op9_bpe"](spark, SF).collect()}
    counts = {r.doc_id: r for r in QUERIES["op10_token_counts"](spark, SF).collect()}
    assert len(got) == len(counts) == len(docs)
    for doc_id, text in docs:
        ids = word_bpe.encode(text, add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        decoded = word_bpe.decode(ids, skip_special_tokens=False).encode()
        assert tuple(got[doc_id]) == (doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest())
        n = len(byte_bpe.encode(text, add_special_tokens=False).ids)
        assert tuple(counts[doc_id]) == (doc_id, len(text.encode()), n, n > 1024)


def test_edges(spark, word_bpe):
    rows = [(1, None, 5), (1, "", 5), (None, "It's", 5), (2, "It's", 5), (2, "It's", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    coded = bpe.encode(docs, ["doc_id"])
    want = word_bpe.encode("It's", add_special_tokens=False).ids
    assert sorted((str(r.doc_id), r.ids) for r in coded.collect()) == [("1", []), ("1", []), ("2", want), ("2", want), ("None", want)]
    assert {r.decoded for r in bpe.decode(coded, ["doc_id"]).collect()} == {"", word_bpe.decode(want)}
    assert sorted(r.n_tokens for r in token_counts.token_counts(docs, ["doc_id"]).collect()) == [0, 0, 2, 2, 2]
    for made in (coded, token_counts.token_counts(docs.limit(0), ["doc_id"]), bpe.round_trip(docs.limit(0), ["doc_id"])):
        assert made.limit(0).count() == 0
