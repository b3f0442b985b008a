import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from termloom.llm import alignment
from termloom.llm.automaton import byte_symbols
from termloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, row string, pairs int, n_a string"
PATH_A = public_tokenizers.path(alignment.VOCABULARY_A)
PATH_B = public_tokenizers.path(alignment.VOCABULARY_B)
PIECES = list("aaabcdehrstTHE  '\n\n\t\r.,19ΣßÉé́ \u0085\x1c\x1f\x00中文字🙂🏽‍　​") + [
    " ", "  ", "the", "ing", " and", "Straße", "<s>", "<0x41>", "<|endoftext|>", "\r\n", "    ", "'ll", "�",
]


@pytest.fixture(scope="module")
def plain():
    """Groups of a whole text by the bytes of its tokens alone; None without tokens."""
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    byte = byte_symbols()
    entries = {i: bytes(byte[c] for c in e) for e, i in json.load(open(PATH_A, encoding="utf-8"))["model"]["vocab"].items()}
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)

    def part_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def groups(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        if not b"".join(entries[i] for i in ids_a) == b"".join(map(part_b, ids_b)) == (" " + text).encode():
            return None
        made, i, j, x, y = [([], [])], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if x <= y:
                x += len(entries[ids_a[i]])
                made[-1][0].append(ids_a[i])
                i += 1
            else:
                y += len(part_b(ids_b[j]))
                made[-1][1].append(ids_b[j])
                j += 1
            if x == y:
                made.append(([], []))
        return made[:-1]

    return groups


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def expected(plain, rows):
    found = [(doc_id, plain(text)) for doc_id, text in rows]
    linked = [Counter((x, y) for a, b in groups or [] for x in a for y in b) for _, groups in found]
    count = Counter(pair for links in linked for pair in links)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    made = []
    for (doc_id, groups), links in zip(found, linked):
        groups = groups or []
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        best = sum(n for pair, n in links.items() if count[pair] == most[pair[0]])
        sums = sum(n * count[pair] for pair, n in links.items())
        made.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), links.total(), best, sums, digest))
    return sorted(made, key=str)


def test_query_over_the_whole_table(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(plain, rows)


def random_texts(n):
    rng = random.Random(11)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("kept", [5, 200_000])
def test_groups_of_pieces_are_those_of_whole_texts(plain, monkeypatch, kept):
    monkeypatch.setattr(alignment, "CACHED_PIECES", kept)
    aligner = alignment.Aligner(open(PATH_A, encoding="utf-8").read(), open(PATH_B, "rb").read())
    texts = random_texts(3000) + [" ", "\n", " \n ", "x▁y", "▁", "a" * 5000, "\n\n\n", "\r\n\r\n", "\t", "é" * 99, "🏴󠁧󠁢󠁥󠁮󠁧󠁿 " * 9]
    without = 0
    for i in range(0, len(texts), 100):
        made = aligner.align(texts[i : i + 100])
        for text, digest in zip(texts[i : i + 100], made["groups_sha256"].to_pylist()):
            groups = plain(text)
            without += groups is None
            assert digest == (hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""), repr(text)
    assert 0 < without < 20


@pytest.mark.parametrize("sent", [0, 40, 1_000_000])
def test_edges_and_pairs_that_are_not_sent(spark, plain, sent):
    some = random_texts(40)
    rows = [(1, None), (2, ""), (3, " "), (None, "the end"), (4, "the end"), (4, "the end"), (5, "x▁y the"), (6, "a" * 30_000), (7, "the " * 20_000)]
    rows += [(10 + i, t) for i, t in enumerate(some)]
    frame = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(3)
    got = alignment.align(frame, ["doc_id"], sent_pairs=sent)
    assert sorted(map(tuple, got.collect()), key=str) == expected(plain, rows)


def test_no_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.align(empty, ["doc_id"]).collect() == []
    one = spark.createDataFrame([(1, "the", "r", 3, "n")], SCHEMA)
    made = alignment.align(one, ["row", "pairs", "doc_id"]).select("row", "pairs", "doc_id", "n_links").collect()
    assert [tuple(r) for r in made] == [("r", 3, 1, 1)]
