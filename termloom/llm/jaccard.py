"""Documents whose sets of word shingles are alike: a Jaccard self-join.

1. One pass makes the set of each text: its size and a digest (equal sets are one class).
   A shingle that comes twice within a task is counted in a count-min sketch of fixed
   size; those that come once, the bulk, are not. What fills a cell in the middle is
   taken off, so that a fuller sketch still knows what stands out. Any order of the
   shingles that all documents share would do; theirs is by the sketch's estimate, then
   by hash, so those with long lists come last.
2. Two sets that are alike enough share l of the first `n - ceil(t * n) + l` shingles of
   each, where l is the smaller of the two sets' `1 + n / 10`. These prefixes are the
   only lists that are dealt out by shingle. In a short list all pairs of fitting sizes
   are counted, and pairs that reach l are edges; documents of a longer list all get
   an edge to its first. So a pair that is alike has an edge of its own, or is in one
   longer list. Connected documents form a family; links never leave a family.
3. A family too large for one tile is dealt out again by its own, exact counts: what the
   sketch took for rare, or what all of the family have in common, then comes last. Of a
   longer list only documents that have it among their first `n - ceil(t * n) + 1` get an
   edge; any two that are alike share one of these. Pairs of short lists must reach l less
   the shingles of longer lists that both may share. This goes on while families shrink by a tenth,
   and costs in proportion to their texts, however the first order went wrong.
4. Each family is searched with the whole sets of its documents, in tiles of bounded
   size where it is large. Texts go to the families that fit a tile, and their sets are made
   there; sets are stored for larger families only. A search is a T-occurrence search by DivideSkip: of the
   inverted lists of a query's shingles the short ones are merged, which gives
   documents that occur often enough to reach the needed overlap together with the
   long ones, and these are probed by binary search, until T is reached or out of
   reach. Whoever reaches it is decided by the exact sizes.

A tile returns the links of a spanning forest, as many rows as it has documents.
Shingles are compared by 64-bit hashes. A hot shingle's list is cut into parts by a
digest of the document, and the parts' leaders are led together. Of documents with
equal sets only the least is dealt out and searched, and of all texts only those of
families: a bit map of fixed size tells the others before they are sent. What is stored
or shuffled on the way to the families, and to the links, goes as soon as these are known.

A text with fewer words than a shingle has is one shingle; without words, or null, it
has the empty set and is linked with nothing. Rows of one doc_id are one document in
links and a row each in the result; a row without doc_id is linked with nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import bound_batches, map_texts, release_shuffles, settled, stored
from termloom.llm.components import connected_components
from termloom.llm.embeddings import Forest
from termloom.operators.split_join import join_split

WORDS = 5
PERCENT = 75  # links: 100 * intersection >= PERCENT * union
DEPTH, CELL_BITS = 3, 21  # of the sketch, which takes 25 MB whatever the data
CHUNK = 1 << 15  # cells that are summed up together
MARK_BITS = 26  # of the bit map of documents, which takes 8 MB whatever the data
MARK_TASKS = 4  # that read ids, each for a map of its own
HELD = 4_000_000  # shingles in which a task looks for repeats
LONG = 1_000  # estimate from which a list is cut into parts, if cells differ by less
NOISE = 6  # times that cells differ from the middle, which an estimate must exceed to be long
PARTS = 64
SHORT = 24  # documents of a list whose pairs are counted
SHARE = 10  # of a set's size, one in so many shingles of the prefix must be shared
ROUNDS = 4  # of dealing large families out again; any number gives the same links
TILE_DOCUMENTS = 1_024
TILE_SHINGLES = 500_000
TASK_DOCUMENTS = 500  # whose families a task searches, where each fits a tile
LONG_WEIGHT = 0.1  # the share of DivideSkip's formula that a probe's cost has
SLICE_BYTES = 200_000  # of texts whose sets are made together
SENT_BYTES = 1 << 15  # texts over this go to their family as a set where that is smaller
DIGESTED = 24  # bytes; longer words are hashed by a cryptographic digest
REMEMBERED = 500_000  # digests that a task remembers, to send equal sets once

_BASE = 0x9E3779B97F4A7C15
_FIRST_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(words: pa.Array) -> np.ndarray:
    """A hash of each string: its length and eight bytes at a time, mixed one after the other; long ones by a digest."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    starts, size = ends[:-1], np.diff(ends)
    used = np.frombuffer(data, np.uint8)[: ends[-1]] if data is not None else np.zeros(0, np.uint8)
    padded = np.concatenate([used, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(used) + 1, "<u8", padded, strides=(1,))
    made = _mixed(size.astype(np.uint64) + np.uint64(_BASE))
    for k in range(0, DIGESTED, 8):
        more = np.flatnonzero(size > k)
        part = eight[starts[more] + k] & _FIRST_BYTES[np.minimum(size[more] - k, 8)]
        made[more] = _mixed(made[more] + part)
    for i in np.flatnonzero(size > DIGESTED):
        digest = hashlib.blake2b(used[starts[i] : ends[i + 1]].tobytes(), digest_size=8).digest()
        made[i] = int.from_bytes(digest, "little")
    return made


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many each text has."""
    # Of both functions ASCII is all they know: A-Z, and the six white space characters.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    found = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    coded = words.dictionary_encode()
    hashes = _hashed(coded.dictionary)
    return hashes[coded.indices.to_numpy()[found]], np.bincount(owner[found], minlength=len(texts))


def _slice_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sets of a few texts. A shingle's hash is a polynomial of the hashes of its words, mixed."""
    word, many = _word_hashes(texts)
    size = np.minimum(many, words)
    starts = np.cumsum(many) - many
    kept = many - size + (many > 0)
    ends = np.cumsum(kept)
    # Where each shingle begins among the words.
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - kept), kept)
    length = np.repeat(size, kept)
    made = length.astype(np.uint64)
    whole = length == words
    for i in range(words):
        if whole.all():
            made = made * np.uint64(_BASE) + word[at + i]
        else:
            some = np.flatnonzero(length > i)
            made[some] = made[some] * np.uint64(_BASE) + word[at[some] + i]
    made = _mixed(made)
    begins = ends - kept
    for begin, end in zip(begins, ends):
        made[begin:end].sort()
    new = np.ones(len(made), bool)
    new[1:] = made[1:] != made[:-1]
    new[begins[kept > 0]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    made = made[new]
    return [made[before[begin] : before[end]] for begin, end in zip(begins, ends)]


def _by_slice(texts: pa.Array, words: int = WORDS) -> Iterator[list[np.ndarray]]:
    """The sets of the texts, of so many texts at a time as fit SLICE_BYTES, or of one."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield _slice_sets(texts.slice(start, end - start), words)
        start = end


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The set of each text, as sorted hashes."""
    for sets in _by_slice(texts, words):
        yield from sets


def _digest(made: np.ndarray) -> bytes:
    return hashlib.blake2b(made.tobytes(), digest_size=16).digest()


def _cells(made: np.ndarray, row: int) -> np.ndarray:
    return (_mixed(made + np.uint64(row)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest of each row; and rows without n: chunks of the task's sketch."""
    names = ["doc_id", "n", "digest", "chunk", "counts"]

    def add(sketch: np.ndarray, held: list[np.ndarray]) -> None:
        token, count = np.unique(np.concatenate(held), return_counts=True)
        token, count = token[count > 1], count[count > 1]
        for row in range(DEPTH):
            sketch[row] += np.bincount(_cells(token, row), count, 1 << CELL_BITS).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros((DEPTH, 1 << CELL_BITS), np.int32), set()
        held, size = [], 0
        for batch in batches:
            n, digests = [], []
            for made in shingle_sets(batch.column(1)):
                digests.append(_digest(made) if len(made) else None)
                n.append(len(made))
                if digests[-1] not in seen:
                    if len(seen) < REMEMBERED:
                        seen.add(digests[-1])
                    held.append(made.copy())
                    size += len(made)
                    if size >= HELD:
                        add(sketch, held)
                        held, size = [], 0
            empty = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), *empty], names=names)
        if held:
            add(sketch, held)
        chunks = sketch.reshape(-1, CHUNK)
        some = np.flatnonzero(chunks.any(axis=1))
        empty = [pa.nulls(len(some), kind) for kind in (pa.int64(), pa.int64(), pa.binary())]
        packed = [zlib.compress(chunks[i].tobytes(), 1) for i in some]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(some.astype(np.int32)), pa.array(packed, pa.binary())], names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, digest binary, chunk int, counts binary")


class Sketch:
    """Estimates of how many documents have a shingle; 0 for those never seen twice.

    The cells of a row are filled alike by the many shingles that a few documents have. Their
    median is taken off; `long` is what estimates exceed that cannot come from the rest.
    """

    def __init__(self, sets: DataFrame):
        self.cells = np.zeros((DEPTH, 1 << CELL_BITS), np.uint32)
        chunks = self.cells.reshape(-1, CHUNK)
        most = np.iinfo(np.uint32).max

        def add(table: pa.Table) -> pa.Table:
            total = np.zeros(CHUNK, np.int64)
            for counts in table["counts"]:
                total += np.frombuffer(zlib.decompress(counts.as_py()), np.int32)
            packed = zlib.compress(np.minimum(total, most).astype(np.uint32).tobytes(), 1)
            return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([packed], pa.binary())})

        parts = sets.where("counts is not null").select("chunk", "counts")
        for r in parts.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect():  # DEPTH * 2^CELL_BITS cells
            chunks[r.chunk] = np.frombuffer(zlib.decompress(r.counts), np.uint32)
        self._level()

    def _level(self) -> None:
        middle, upper = np.percentile(self.cells, [50, 84], axis=1, method="lower")
        self.cells -= np.minimum(self.cells, middle[:, None].astype(np.uint32))
        self.long = max(LONG, NOISE * int((upper - middle).max()))

    def estimate(self, made: np.ndarray) -> np.ndarray:
        found = self.cells[0, _cells(made, 0)]
        for row in range(1, DEPTH):
            found = np.minimum(found, self.cells[row, _cells(made, row)])
        return found


class Marks:
    """Documents of which some may be others: a bit for a hash of each id in `ids`."""

    def __init__(self, ids: DataFrame):
        size = (1 << MARK_BITS) // 8

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size, np.uint8)
            for batch in batches:
                at = _marked_at(batch.column(0).to_numpy(zero_copy_only=False))
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())], names=["bits"])

        self.bits = np.zeros(size, np.uint8)
        for r in ids.coalesce(MARK_TASKS).mapInArrow(mark, "bits binary").collect():  # of 2^MARK_BITS bits, packed
            self.bits |= np.frombuffer(zlib.decompress(r.bits), np.uint8)

    def among(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows whose first column may be one of the ids; few others, and all that are."""
        at = _marked_at(batch.column(0).to_numpy(zero_copy_only=False))
        return batch.filter(pa.array((self.bits[at >> 3] >> (at & 7) & 1).astype(bool)))


def _marked_at(ids: np.ndarray) -> np.ndarray:
    return (_mixed(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def _prefix(made: np.ndarray, sketch: Sketch, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles in the common order, and their estimates."""
    keep = len(made) + (-percent * len(made)) // 100 + 1 + len(made) // SHARE
    estimate = sketch.estimate(made)
    order = np.lexsort((made, estimate))[:keep]
    return made[order], estimate[order]


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text of the rows that have a doc_id."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _shared_prefixes(docs: DataFrame, sketch: Sketch, percent: int, leaders: Marks | None = None) -> DataFrame:
    """Edges a, b between documents, of `leaders` where these are given, whose prefixes share enough."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((sketch, leaders))  # 33 MB, always

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (sketch, leaders), seen = model.value, set()
        for batch in batches:
            if leaders is not None:
                batch = leaders.among(batch)
            ids = iter(batch.column(0).to_numpy(zero_copy_only=False))
            for sets in _by_slice(batch.column(1)):
                token, salt, owner, size = [], [], [], []
                for made, doc_id in zip(sets, ids):
                    digest = _digest(made)
                    if not len(made) or digest in seen:
                        continue
                    if len(seen) < REMEMBERED:
                        seen.add(digest)
                    first, estimate = _prefix(made, sketch, percent)
                    token.append(first.view(np.int64))
                    salt.append(np.where(estimate > sketch.long, 1 + int(_mixed(np.array([doc_id]).astype(np.uint64))[0] % np.uint64(PARTS)), 0))
                    owner.append(np.full(len(first), doc_id))
                    size.append(np.full(len(first), len(made), np.int32))
                if token:
                    arrays = [np.concatenate(token), np.concatenate(salt).astype(np.int32), np.concatenate(owner), np.concatenate(size)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["token", "salt", "doc_id", "n"])

    rows = _texts(docs).mapInArrow(run, "token bigint, salt int, doc_id bigint, n int")
    of_list = Window.partitionBy("token", "salt")
    lists = rows.select("*", F.min("doc_id").over(of_list).alias("leader"), F.count("*").over(of_list).alias("length"))
    shared = stored(lists.where("length > 1 or salt > 0"), "jaccard-prefixes")
    release_shuffles(spark)
    long = shared.where((F.col("salt") > 0) | (F.col("length") > SHORT))
    leaders = long.where("salt > 0").groupBy("token", "salt").agg(F.min("leader").alias("leader"))
    first = leaders.groupBy("token").agg(F.min("leader").alias("a"))
    across = leaders.join(first, "token").select("a", F.col("leader").alias("b"))
    within = long.select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    short = shared.where((F.col("salt") == 0) & (F.col("length") <= SHORT)).withColumn("hot", F.lit(0))
    members = short.repartition("leader").groupBy("leader", "token").agg(_in_order())
    return within.union(across).where("a < b").union(_counted_pairs(members, percent)).distinct()


def _in_order() -> Column:
    return F.sort_array(F.collect_list(F.struct("doc_id", "n", "hot"))).alias("m")


def _counted_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of short lists `m` of doc_id, n, hot that share as many shingles as alike pairs must.

    Up to `hot` of the shingles of a document's prefix are in longer lists, and not counted here.
    The lists are dealt by their first documents: those of the same documents lie together, so a
    pair that shares many shingles is counted before it is sent.
    """

    def pairs(x, i):
        later = F.filter(
            F.slice("m", i + 2, F.lit(SHORT)),
            lambda y: (F.greatest(x["n"], y["n"]) * percent <= F.least(x["n"], y["n"]) * 100) & (x["doc_id"] < y["doc_id"]),
        )
        least = lambda y: 1 + F.floor(F.least(x["n"], y["n"]) / SHARE) - F.least(x["hot"], y["hot"])
        return F.transform(
            later, lambda y: F.struct(x["doc_id"].alias("a"), y["doc_id"].alias("b"), F.greatest(least(y), F.lit(1)).alias("least"))
        )

    found = members.select(F.explode(F.flatten(F.transform("m", pairs))).alias("p")).select("p.a", "p.b", "p.least")
    counted = found.groupBy("a", "b", "least").agg(F.count("*").alias("shared"))
    return counted.where(F.col("shared") >= F.col("least")).select("a", "b")


def _exact_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Edges a, b between sets (family, doc_id, set) of a family, in the order of its exact counts."""
    text = ["family", "doc_id", "of"]
    whole = sets.withColumn("of", F.xxhash64("set")).dropDuplicates(text)
    tokens = whole.select(*text, F.size("set").alias("n"), F.explode("set").alias("shingle"))
    tokens = tokens.select(*text, "n", F.xxhash64("family", "shingle").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
    common = join_split(tokens, counts, "token", "length", "doc_id")
    of_text = Window.partitionBy(*text)
    # Shingles that no other has come first; they are not among the joined ones.
    place = F.col("n") - F.count("*").over(of_text) + F.row_number().over(of_text.orderBy("length", "token"))
    standard = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    placed = common.select("*", place.alias("place"), standard.alias("standard"))
    first = placed.where(F.col("place") <= F.col("standard") + F.floor(F.col("n") / SHARE))
    hot = F.sum((F.col("length") > SHORT).cast("int")).over(of_text)
    first = stored(first.select("token", "doc_id", "n", "length", (F.col("place") <= F.col("standard")).alias("lead"), hot.alias("hot")), "jaccard-exact")
    long = first.where(F.col("lead") & (F.col("length") > SHORT)).select("token", "doc_id")
    leaders = long.groupBy("token").agg(F.min("doc_id").alias("leader"), F.count("*").alias("held"))
    within = join_split(long, leaders, "token", "held", "doc_id").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    lists = first.where(F.col("length") <= SHORT).groupBy("token").agg(_in_order())
    members = lists.repartition(F.col("m")[0]["doc_id"])
    return within.where("a < b").union(_counted_pairs(members, percent)).distinct()


class Index:
    """Inverted lists of some sets: places of the sets that have a shingle, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(self.starts, len(tokens))
        self.owner = owner[order]

    def lists(self, query: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.tokens, query)
        at = at[(at < len(self.tokens)) & (self.tokens[np.minimum(at, len(self.tokens) - 1)] == query)]
        return [self.owner[self.starts[i] : self.starts[i + 1]] for i in at]

    def search(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """DivideSkip: sets that have at least `least` of the query's shingles, and how many."""
        lists = sorted(self.lists(query), key=len)
        if len(lists) < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        probed = min(int(least / (LONG_WEIGHT * np.log2(len(lists[-1]) + 1) + 1)), least - 1)
        short, long = lists[: len(lists) - probed], lists[len(lists) - probed :]
        # Sorting sorted runs by a stable sort is merging them.
        merged = np.sort(np.concatenate(short), kind="stable")
        found, count = np.unique(merged, return_counts=True)
        keep = count >= least - probed
        found, count = found[keep], count[keep]
        for left, places in zip(range(probed - 1, -1, -1), long):
            if not len(found):
                break
            at = np.minimum(np.searchsorted(places, found), len(places) - 1)
            count = count + (places[at] == found)
            keep = count >= least - left
            found, count = found[keep], count[keep]
        return found, count


def _search(table: pa.Table, same: bool, first: int, percent: int) -> pa.Table:
    """The links of a spanning forest of a tile."""
    table = table.sort_by("doc_id")
    ids = table["doc_id"].to_numpy()
    flat = table["set"].combine_chunks()
    tokens, ends = flat.values.to_numpy().view(np.uint64), flat.offsets.to_numpy()
    sets = [tokens[start:end] for start, end in zip(ends, ends[1:])]
    part = table["part"].to_numpy()
    left = np.flatnonzero(part == first)
    right = left if same else np.flatnonzero(part != first)
    forest = Forest(len(ids))
    if len(left) and len(right):
        index = Index([sets[i] for i in right])
        sizes = np.array([len(sets[i]) for i in right])
        for i in left:
            n = len(sets[i])
            found, common = index.search(sets[i], -(-percent * n // 100))
            linked = 100 * common >= percent * (n + sizes[found] - common)
            other = right[found[linked]]
            other = other[other > i] if same else other
            forest.link(np.full(len(other), i), other)
    moved = np.flatnonzero(forest.least != np.arange(len(ids)))
    return pa.table({"a": ids[forest.least[moved]], "b": ids[moved]})


def _members(families: DataFrame, sets: DataFrame) -> DataFrame:
    """doc_id, family, and the `parts` that keep its tiles in bounds; of families of more than one."""
    sizes = families.join(sets.where("n > 0").groupBy("doc_id").agg(F.sum("n").alias("n")), "doc_id")
    parts = sizes.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / TILE_DOCUMENTS), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int").alias("parts"),
        F.count("*").alias("size"),
    )
    return families.join(parts.where("size > 1"), "family").select("doc_id", "family", "parts")


def _texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The columns of `members` and `text`, a row for each text of theirs."""
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(Marks(members.select("doc_id")))  # 8 MB, always

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (model.value.among(batch) for batch in batches)

    # Members grow with the texts, so both are sorted whatever their size.
    return _texts(docs).mapInArrow(run, "doc_id bigint, text string").join(members.hint("merge"), "doc_id")


def _as_sets(texts: DataFrame) -> DataFrame:
    """doc_id and `set` of each text, with one."""

    def work(texts: list[str]) -> dict:
        return {"set": [made.view(np.int64) for made in shingle_sets(pa.array(texts, pa.string()))]}

    return map_texts(texts, ["doc_id"], {"set": "array<bigint>"}, work).where("size(set) > 0")


def _with_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """doc_id and `set` of each text, with one, of the members."""
    return _as_sets(_texts_of(docs, members.select("doc_id").distinct()))


def _leaders_of(families: DataFrame, known: DataFrame) -> DataFrame:
    """Families of the least documents that have the sets of their members."""
    return families.join(known, "doc_id").select(F.col("leader").alias("doc_id"), "family").distinct()


def _narrowed(members: DataFrame, sets: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """`_members` of families, those of several parts dealt out again while they shrink.

    What is counted are the sets that their tiles read. A round reads and deals out all texts of
    these families, so one that saves less than a tenth of those sets is the last.
    """
    before = None
    for _ in range(ROUNDS):
        large = members.where("parts > 1")
        work = large.agg(F.sum(F.col("parts").cast("bigint"))).first()[0]
        if work is None or before is not None and 10 * work > 9 * before:
            break
        before = work
        edges = _exact_prefixes(texts.join(large.select("doc_id", "family"), "doc_id"), percent)
        found = connected_components(edges).toDF("doc_id", "family")
        again = _members(found.union(found.select("family", "family")).distinct(), sets)
        members = stored(members.where("parts = 1").unionByName(again), "jaccard-families")
    return members


def _links(texts: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links a, b of spanning forests of the documents of each family."""
    parts = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = members.withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int")).withColumn("other", F.explode(parts))
    sent = texts.join(dealt, "doc_id").select(
        "family", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "doc_id", "set"
    )

    def search(key: tuple, table: pa.Table) -> pa.Table:
        return _search(table, key[1].as_py() == key[2].as_py(), key[1].as_py(), percent)

    return sent.groupBy("family", "first", "second").applyInArrow(search, "a bigint, b bigint")


def _sent(texts: DataFrame) -> DataFrame:
    """family, doc_id and text of `texts`, or `set` in place of a longer text whose set is smaller.

    A text that says the same again and again is much larger than its set, by which tiles are bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            made: list[bytes | None] = [None] * len(texts)
            for i in np.flatnonzero(size > SENT_BYTES):
                (one,) = _slice_sets(texts.slice(i, 1), WORDS)
                if one.nbytes < size[i]:
                    made[i] = one.tobytes()
            kept = pc.if_else(pa.array([m is None for m in made], pa.bool_()), texts, pa.scalar(None, texts.type))
            columns = [batch.column(0), batch.column(1), kept, pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["family", "doc_id", "text", "set"])

    return texts.select("family", "doc_id", "text").mapInArrow(run, "family bigint, doc_id bigint, text string, set binary")


def _links_of_texts(texts: DataFrame, percent: int) -> DataFrame:
    """`_links` of families that fit a tile, from texts (family, doc_id, text)."""

    def search(table: pa.Table) -> pa.Table:
        texts = pc.fill_null(table["text"], "").combine_chunks()
        given = table["set"].to_pylist()
        sets = [made if of is None else np.frombuffer(of, np.uint64) for made, of in zip(shingle_sets(texts), given)]
        some = np.flatnonzero([len(made) > 0 for made in sets])
        ends = np.cumsum([0, *(len(sets[i]) for i in some)]).astype(np.int32)
        flat = np.concatenate([sets[i] for i in some]).view(np.int64) if len(some) else np.zeros(0, np.int64)
        columns = {
            "doc_id": table["doc_id"].take(pa.array(some)),
            "part": pa.array(np.zeros(len(some), np.int32)),
            "set": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
        }
        return _search(pa.table(columns), True, 0, percent)

    # Searching costs much more than reading, so sizes do not say how many tasks it needs.
    tasks = max(1, -(-texts.count() // TASK_DOCUMENTS))
    return _sent(texts).repartition(tasks, "family").groupBy("family").applyInArrow(search, "a bigint, b bigint")


def _all_links(docs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b of spanning forests of the documents of each family of `_members`."""
    texts = stored(_texts_of(docs, members), "jaccard-texts")
    found = _links_of_texts(texts.where("parts = 1"), percent)
    large = members.where("parts > 1")
    if large.isEmpty():
        return found
    made = stored(_as_sets(texts.where("parts > 1")), "jaccard-large")
    return found.union(_links(made, _narrowed(large, sets, made, percent), percent))


def jaccard_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs` (doc_id, text)."""
    sets = stored(_sets(docs), "jaccard-sets")
    rows = sets.where("n is not null")
    # Documents of one digest, and of one doc_id, are one.
    some = rows.where("n > 0 and doc_id is not null").select("doc_id", "digest")
    known = stored(some.distinct().join(some.groupBy("digest").agg(F.min("doc_id").alias("leader")), "digest").select("doc_id", "leader"), "jaccard-classes")

    def families() -> DataFrame:
        leaders = Marks(known.where("doc_id = leader").select("doc_id"))
        found = connected_components(_shared_prefixes(docs, Sketch(sets), percent, leaders)).toDF("doc_id", "family")
        return _members(_leaders_of(found.union(found.select("family", "family")).distinct(), known), sets)

    members = settled(docs.sparkSession, families, "jaccard-families")
    links = settled(docs.sparkSession, lambda: _all_links(docs, members, sets, percent), "jaccard-links")
    copies = known.where("leader < doc_id").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    components = connected_components(links.union(copies)).toDF("doc_id", "component")
    found = rows.join(components, "doc_id", "left")
    alone = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))
