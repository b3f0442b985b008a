"""How the tokens of two tokenizers lie on each other.

A text with a space before it is encoded by a byte-level vocabulary (A) and by a
vocabulary of pieces with byte fallback (B), which adds that space itself. Byte places
where tokens of both end cut the text into groups; every token of A in a group is
linked with every token of B in it. Pairs of ids are counted by documents over the corpus.

1. The libraries give spans: A's are of characters, B's of bytes. Where a span's end is
   where the token's decoded bytes end, it is a cut. Tokens that end inside a character,
   parts of multibyte characters and fallback bytes, have spans that say less: their
   ends are refined to those of their decoded bytes.
2. Both tokenizers cut a text before a space, or a line end, that follows something
   else: A's pattern always, B where no piece goes on over one, which is asked of the
   vocabulary. So texts are taken piece by piece, and what a piece gave is kept in a
   bounded table. Groups never reach over such a cut, as tokens of both end there.
3. A document's distinct pairs, and how many links each has, are stored as two lists. Pairs
   are counted from them; tasks count what they have before the shuffle, so a pair of
   every document is one row a task. The most frequent ones, `SENT_PAIRS` at most, are sent
   to all tasks; other pairs are shuffled to their counts, and as all frequent ones
   are among those sent, none of them is a large group.

A null or empty text has no tokens, nor has one whose bytes the tokens do not give back,
such as a text with U+2581, which B takes for a space. Links within a group are counted, not
listed: a long stretch without common cuts costs the product of its distinct ids. Each
row is a document of its own, also where ids repeat or are null.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import Counter
from itertools import chain
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.llm import automaton
from termloom.llm.common import map_texts, stored

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
SPACE = "▁"
TOGETHER = 4_000  # pieces encoded as one text
LARGE = 4_096  # links of a group that are looked at one by one
CACHED_PIECES = 500_000
CACHED_CHARS = 16_000_000
SENT_PAIRS = 1_000_000  # rows of 17 bytes
CELLS = 8  # of counts, to a power of two


class Unsound(Exception):
    """The tokens do not give back the bytes of the text."""


def byte_ends(coarse: list[int], parts: list[bytes], data: bytes) -> list[int]:
    """Where each token ends in `data`: at its span's end, or inside a character, where its bytes end."""
    made, here = [], 0
    for cut, part in zip(coarse, parts):
        end = here + len(part)
        if data[here:end] != part:
            raise Unsound
        if end != cut and not (end < len(data) and data[end] & 0xC0 == 0x80):
            raise Unsound
        made.append(end)
        here = end
    if here != len(data):
        raise Unsound
    return made


class Aligner:
    def __init__(self, vocabulary_a: str, model_b: bytes):
        spec = json.loads(vocabulary_a)
        self.a = Tokenizer.from_str(vocabulary_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.a.no_truncation()
        self.a.no_padding()
        byte = automaton.byte_symbols()
        self.bytes_a = {i: bytes(byte[c] for c in entry) for entry, i in spec["model"]["vocab"].items()}
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.width = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(self.width)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)
        ]
        self.sizes_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)])
        self.sizes_b = np.array([len(p) for p in self.bytes_b])
        # How an id is written before another of its group, and as the last of its side.
        self.shown = [f"{i}{mark}" for i in range(len(self.sizes_a)) for mark in ",|"] + [f"{i}{mark}" for i in range(self.width) for mark in ",;"]
        own = spec.get("pre_tokenizer") or {}
        cuts = own.get("type") == "ByteLevel" and own.get("use_regex") and spec.get("normalizer") is None
        cuts = cuts and not any(SPACE in p.lstrip(SPACE) for p in names)
        at = r" \n" if not any("\n" in p for p in names) else " "
        # From a space or line end after something else to the next such.
        self.pieces = re.compile(rf"[{at}]\s*(?:\S+(?:[^\S{at}]\s*)?)*" if cuts else r"(?s).+")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.written: list[str | None] = []
        self.counts = array("q")  # of each piece: tokens of A, of B, groups, links
        self.starts = array("q", [0])
        self.keys, self.links = array("q"), array("q")

    def _learn(self, pieces: list[str]) -> None:
        # Together they are cut as each alone, but for those that end in white space.
        joined = [p for p in pieces if not p[-1].isspace()]
        for i in range(0, len(joined), TOGETHER):
            part = joined[i : i + TOGETHER]
            if not self._learn_joined(part):
                self._learn_each(part)
        self._learn_each([p for p in pieces if p[-1].isspace()])

    def _learn_each(self, pieces: list[str]) -> None:
        made_a = self.a.encode_batch(pieces, add_special_tokens=False)
        # B adds a space: in place of the piece's own, or one that is taken off again.
        made_b = self.b.encode([p.removeprefix(" ") for p in pieces], return_type="proto", num_threads=1)
        for piece, a, b in zip(pieces, made_a, made_b):
            try:
                groups = self._groups(piece, a, b)
            except Unsound:
                groups = None
            self._keep(groups)
            self._note(piece)

    def _note(self, piece: str) -> None:
        self.known[piece] = len(self.known)
        self.chars += len(piece)

    def _learn_joined(self, pieces: list[str]) -> bool:
        """Take pieces as one text; False, and nothing is learnt, if some are not sound or have large groups."""
        first = " a"  # takes the space that B adds
        text = first + "".join(pieces)
        data = text.encode()
        raw = np.frombuffer(data, np.uint8)
        encoded = self.a.encode(text, add_special_tokens=False)
        a = np.array(encoded.ids)
        until = np.fromiter(map(itemgetter(1), encoded.offsets), np.int64, len(a))
        coarse_a = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))[until]
        found = self.b.encode(text[1:], return_type="proto", num_threads=1).pieces
        b = np.array([p.id for p in found])
        coarse_b = np.array([p.end for p in found]) + 1
        ends = []
        for ids, parts, sizes, coarse in ((a, self.bytes_a, self.sizes_a, coarse_a), (b, self.bytes_b, self.sizes_b, coarse_b)):
            if b"".join([parts[i] for i in ids.tolist()]) != data:
                return False
            end = np.cumsum(sizes[ids])
            inside = end[end != coarse]
            if (inside >= len(raw)).any() or (raw[inside] & 0xC0 != 0x80).any():
                return False
            ends.append(end)
        cuts = np.intersect1d(*ends, assume_unique=True)
        last = np.cumsum([len(first), *(len(p.encode()) for p in pieces)])
        group_a, group_b = np.searchsorted(cuts, ends[0]), np.searchsorted(cuts, ends[1])
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        if not np.isin(last, cuts, assume_unique=True).all() or (n_a * n_b).max() > LARGE:
            return False
        piece = np.searchsorted(last, cuts)  # of each group; 0 is the one put first
        before_a, before_b = np.cumsum(n_a), np.cumsum(n_b) - n_b
        # Each group's tokens of A, then those of B, as they are written.
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + before_b[group_a]] = 2 * a + np.append(np.diff(group_a) > 0, True)
        shown[np.arange(len(b)) + before_a[group_b]] = 2 * (len(self.sizes_a) + b) + np.append(np.diff(group_b) > 0, True)
        strings = [self.shown[i] for i in shown.tolist()]
        n = len(pieces) + 1
        of_a, of_b = np.bincount(piece[group_a], minlength=n), np.bincount(piece[group_b], minlength=n)
        at = np.cumsum(of_a + of_b).tolist()
        self.written.extend(["".join(strings[i:j]) for i, j in zip(at[:-1], at[1:])])
        # Every token of A with every token of B of its group.
        times = n_b[group_a]
        other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(before_b[group_a], times)
        key, owner = np.repeat(a, times) * self.width + b[other], np.repeat(piece[group_a], times)
        order = self._order(owner, key)
        key, owner = key[order], owner[order]
        new = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(key) != 0)))
        links = np.diff(np.append(new, len(key)))
        new, links = new[owner[new] > 0], links[owner[new] > 0]
        n_links, n_pairs = np.bincount(owner, minlength=n), np.bincount(owner[new], minlength=n)
        self.counts.extend(np.stack([of_a, of_b, np.bincount(piece, minlength=n), n_links], axis=1)[1:].ravel().tolist())
        start = len(self.keys)
        self.keys.frombytes(key[new].astype(np.int64).tobytes())
        self.links.frombytes(links.astype(np.int64).tobytes())
        self.starts.extend((start + np.cumsum(n_pairs[1:])).tolist())
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.chars += sum(map(len, pieces))
        return True

    def _order(self, owner: np.ndarray, key: np.ndarray) -> np.ndarray:
        """By owner, then key; owners are few enough for both to go into one number."""
        return np.argsort(owner * (len(self.sizes_a) * self.width) + key)

    def _groups(self, piece: str, a, b) -> list[tuple[list[int], list[int]]]:
        data = piece.encode()
        places = range(len(data) + 1) if len(data) == len(piece) else np.cumsum([0, *(len(c.encode()) for c in piece)]).tolist()
        ids_a = a.ids
        ends_a = byte_ends([places[end] for _, end in a.offsets], [self.bytes_a[i] for i in ids_a], data)
        found = [(p.id, p.end) for p in b.pieces]
        added = 1 if piece[0] == " " else 0
        if not added:
            if not found or self.bytes_b[found[0][0]] != b" ":
                raise Unsound
            found = found[1:]
        if piece == " ":  # the last space of a text
            found = [(self.b.piece_to_id(SPACE), 0)]
        ids_b = [i for i, _ in found]
        ends_b = byte_ends([end + added for _, end in found], [self.bytes_b[i] for i in ids_b], data)
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a).intersection(ends_b)):
            at_a, at_b = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append((ids_a[i:at_a], ids_b[j:at_b]))
            i, j = at_a, at_b
        return groups

    def _keep(self, groups: list[tuple[list[int], list[int]]] | None) -> None:
        pairs: Counter = Counter()
        for in_a, in_b in groups or []:
            times_b = Counter(in_b)
            for x, n in Counter(in_a).items():
                for y, m in times_b.items():
                    pairs[x * self.width + y] += n * m
        shown = None if groups is None else "".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in groups)
        self.written.append(shown)
        groups = groups or []
        self.counts.extend((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), pairs.total()))
        self.keys.extend(pairs.keys())
        self.links.extend(pairs.values())
        self.starts.append(len(self.keys))

    def align(self, texts: list[str]) -> dict[str, pa.Array]:
        """Of each text the numbers, the digest of its groups, its distinct pairs, and the links of each pair."""
        if len(self.known) > CACHED_PIECES or self.chars > CACHED_CHARS:
            self._forget()
        cut = [self.pieces.findall(f" {t}") if t else [] for t in texts]
        new = list({p: None for pieces in cut for p in pieces if p not in self.known})
        self._learn(new)
        digests = []
        numbers = [[self.known[p] for p in pieces] for pieces in cut]
        for k, found in enumerate(numbers):
            shown = [self.written[i] for i in found]
            if None in shown:
                numbers[k] = shown = []
            digests.append(hashlib.sha256("".join(shown)[:-1].encode()).hexdigest() if shown else "")
        owner = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
        piece = np.fromiter(chain.from_iterable(numbers), np.int64, len(owner))
        counts = np.array(self.counts, np.int64).reshape(-1, 4)
        ends = np.cumsum([len(n) for n in numbers])
        running = np.vstack([np.zeros((1, 4), np.int64), np.cumsum(counts[piece], axis=0)])
        totals = np.diff(running[np.append(0, ends).astype(np.int64)], axis=0)
        # Distinct pieces of a text, then distinct pairs.
        once, times = np.unique(owner * len(counts) + piece, return_counts=True) if len(piece) else (piece, piece)
        owner, piece = (once // len(counts), once % len(counts)) if len(once) else (once, once)
        starts = np.array(self.starts, np.int64)
        sizes = starts[piece + 1] - starts[piece]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[piece], sizes)
        owner, key = np.repeat(owner, sizes), np.array(self.keys, np.int64)[at]
        links = np.array(self.links, np.int64)[at] * np.repeat(times, sizes)
        order = self._order(owner, key)
        owner, key, links = owner[order], key[order], links[order]
        first = np.flatnonzero(np.diff(owner, prepend=-1) | np.diff(key, prepend=-1)) if len(key) else key
        links = np.add.reduceat(links, first) if len(first) else links
        offsets = pa.array(np.searchsorted(owner[first], np.arange(len(texts) + 1)).astype(np.int32))
        return {
            **{name: pa.array(totals[:, i]) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "groups_sha256": pa.array(digests, pa.string()),
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(key[first])),
            "links": pa.ListArray.from_arrays(offsets, pa.array(links)),
        }


_ALIGNERS: dict[str, Aligner] = {}


def _aligned(docs: DataFrame, columns: list[str], path_a: str, path_b: str, text: str) -> DataFrame:
    with open(path_a, encoding="utf-8") as file_a, open(path_b, "rb") as file_b:
        files = file_a.read(), file_b.read()
    key = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    known = docs.sparkSession.sparkContext.broadcast(files)  # two megabytes, whatever the data

    def work(texts: list[str]) -> dict:
        if key not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[key] = Aligner(*known.value)
        return _ALIGNERS[key].align(texts)

    more = {c: "bigint" for c in ("n_a", "n_b", "n_groups", "n_links")}
    return map_texts(docs, columns, {**more, "groups_sha256": "string", "pairs": "array<bigint>", "links": "array<bigint>"}, work, text)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """pair, n and best: in how many documents a pair is linked, and if no pair of its A id is in more."""
    pairs = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = stored(pairs, "alignment-counts")
    own = F.floor(F.col("pair") / width)
    most = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))  # a row for each id of a vocabulary
    return counts.withColumn("a", own).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, columns: list[str], path_a: str | None = None, path_b: str | None = None, text: str = "text", sent_pairs: int = SENT_PAIRS
) -> DataFrame:
    """`columns`, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of `docs`."""
    path_b = path_b or public_tokenizers.path(VOCABULARY_B)
    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    named = docs.select(F.struct(*columns).alias("of"), F.col(text).cast("string").alias("text"))
    made = _aligned(named, ["of"], path_a or public_tokenizers.path(VOCABULARY_A), path_b, "text")
    # Numbered once, as it is written.
    aligned = stored(made.select(F.monotonically_increasing_id().alias("row"), "*"), "alignment-documents")
    counts = stored(pair_counts(aligned, width), "alignment-pairs")
    cell = F.floor(CELLS * F.log2("n"))
    sizes = counts.groupBy(cell.alias("cell")).agg(F.count("*").alias("pairs")).collect()  # 64 * CELLS rows at most
    least, sent = 0, 0
    for r in sorted(sizes, reverse=True):
        sent += r.pairs
        if sent > sent_pairs:
            least = r.cell + 1
            break
    frequent = F.broadcast(counts.where(cell >= least))
    each = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("of")).select("row", F.col("of.pairs").alias("pair"), F.col("of.links").alias("links"))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(F.lit(0))).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum")
        )

    sums = summed(each.join(frequent, "pair"))
    if least:
        rest = each.join(frequent, "pair", "left_anti").join(counts.where(cell < least), "pair")
        both = sums.union(summed(rest)).groupBy("row")
        sums = both.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("bigint")
    return aligned.drop("pairs", "links").join(sums, "row", "left").select(
        *(F.col(f"of.`{c}`").alias(c) for c in columns),
        "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )
