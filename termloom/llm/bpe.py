"""Encoding texts into tokens of a word-level byte-pair encoding, and back.

The merges are compiled into a deterministic automaton over tokens (automaton.py).
A text is normalized and cut into words as the vocabulary's file asks; each word is
read along the automaton's arcs, and what a word gave is kept in a bounded table. Texts
with characters that Python's tables do not know are normalized and cut by the library's.
Decoding emits the labels of the arcs, joined by spaces, as the public library does
for a file without a decoder.

Results of edge cases: a null or empty text has no tokens; strings of special tokens
inside a text are those tokens; every row of the input is one row of the output.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from termloom.llm import automaton
from termloom.llm.common import map_texts, schema_of

VOCABULARY = "word_bpe_49k.json"
# The file's own pattern with its disjoint alternatives in order of frequency.
WORDS = r"{L}+|{N}|'s|'t|'re|'ve|'m|'ll|'d|[^{S}{L}{N}]+"
CACHED_WORDS = 400_000


class WordPattern:
    """A pattern over letters, numbers and white space, by a faster engine for texts of Latin letters."""

    # The letters, numbers and white space among the first 256 characters.
    LATIN = {"L": "A-Za-zªµºÀ-ÖØ-öø-ÿ", "N": "0-9²³¹¼-¾", "S": r"\t-\r \x85\xa0"}
    ANY = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\s"}

    def __init__(self, pattern: str):
        self.latin, self.any = (
            make(re.sub(r"(\[\^?)?((?:\{[LNS]\})+)(\])?", lambda m: self._classes(m, classes), pattern))
            for make, classes in ((re.compile, self.LATIN), (regex.compile, self.ANY))
        )

    @staticmethod
    def _classes(found: re.Match, classes: dict[str, str]) -> str:
        return (found[1] or "[") + "".join(classes[c] for c in found[2] if c in classes) + "]"

    def findall(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any.findall(text)
        return self.latin.findall(text)


@cache
def unassigned() -> re.Pattern:
    """Characters that Python's tables do not know. Those of the library may be newer."""
    edges, before = [], False
    for point in range(0x110000):
        now = unicodedata.category(chr(point)) == "Cn"
        if now != before:
            edges.append(point if now else point - 1)
            before = now
    edges += [0x10FFFF] if before else []
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(edges[::2], edges[1::2])) + "]")


class LibraryWords:
    """Words as the library's own tables normalize and cut a text, for texts with unassigned characters."""

    def __init__(self, text: str):
        spec = json.loads(text)
        spec["model"], spec["added_tokens"] = {"type": "BPE", "vocab": {}, "merges": []}, []
        tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.byte = automaton.byte_symbols()

    def findall(self, text: str) -> list[str]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        pieces = self.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(map(self.byte.__getitem__, piece)).decode() for piece, _ in pieces]


class WordCodec:
    def __init__(self, text: str):
        self.automaton, self.added = automaton.load(text)
        self.words, self.library = WordPattern(WORDS), LibraryWords(text)
        self.special = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.labels = list(self.automaton.labels)
        self.labels += [""] * (max(self.added.values(), default=0) + 1 - len(self.labels))
        for label, token in self.added.items():
            self.labels[token] = label
        self.known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = np.array(self.automaton.encode(word.encode("utf-8", "surrogatepass")), dtype="<u4").tobytes()
        if len(word) <= 40:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            if unassigned().search(text):
                return self.library.findall(text)
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: a sigma at a word's end stays the common small sigma.
        return self.words.findall(text.replace("Σ", "σ").lower())

    def _plain(self, text: str) -> list[bytes]:
        words = self._words(text)
        known, make = self.known, self._word
        return [known.get(w) or make(w) for w in words]

    def encode(self, text: str) -> bytes:
        """The ids, each as four bytes, the lowest first."""
        if self.special is None or not self.special.search(text):
            return b"".join(self._plain(text))
        made, at = [], 0
        for found in self.special.finditer(text):
            made += self._plain(text[at : found.start()])
            made.append(self.added[found.group()].to_bytes(4, "little"))
            at = found.end()
        return b"".join(made + self._plain(text[at:]))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _shared(docs: DataFrame, path: str):
    """The file's text on all executors: two megabytes, whatever the data."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    key = hashlib.sha256(text.encode()).hexdigest()
    return key, docs.sparkSession.sparkContext.broadcast(text)


def encode(docs: DataFrame, columns: list[str], path: str | None = None, text: str = "text") -> DataFrame:
    """`columns` and `ids`, the tokens of the text."""
    key, file = _shared(docs, path or public_tokenizers.path(VOCABULARY))

    def work(texts: list[str]) -> dict:
        codec = automaton.loaded(f"codec {key}", file.value, WordCodec)
        ids = [codec.encode(t) for t in texts]
        offsets = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
        values = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}

    return map_texts(docs, columns, {"ids": "array<int>"}, work, text, f"codec {key}")


def decode(docs: DataFrame, columns: list[str], path: str | None = None, ids: str = "ids") -> DataFrame:
    """`columns` and `decoded`, the labels of the tokens in `ids`; null ids are none."""
    key, file = _shared(docs, path or public_tokenizers.path(VOCABULARY))

    def run(batches):
        codec = automaton.loaded(f"codec {key}", file.value, WordCodec)
        for batch in batches:
            texts = [codec.decode(np.array(i or [], dtype="<u4").tobytes()) for i in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*columns, "decoded"])

    return docs.select(*columns, ids).mapInArrow(run, schema_of(docs, columns, {"decoded": "string"}))


def round_trip(
    docs: DataFrame, columns: list[str], path: str | None = None, text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """`columns`, the digests of encoding and decoding, and the ids if asked for, in one pass."""
    key, file = _shared(docs, path or public_tokenizers.path(VOCABULARY))

    def work(texts: list[str]) -> dict:
        codec = automaton.loaded(f"codec {key}", file.value, WordCodec)
        made: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for t in texts:
            ids = codec.encode(t)
            if keep_ids:
                made["ids"].append(np.frombuffer(ids, dtype="<u4").astype(np.int32))
            made["n_tokens"].append(len(ids) // 4)
            made["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            made["decoded_sha256"].append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        if keep_ids:
            made["ids"] = pa.array(made["ids"], pa.list_(pa.int32()))
        return made

    more = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    if keep_ids:
        more["ids"] = "array<int>"
    return map_texts(docs, columns, more, work, text, f"codec {key}")

