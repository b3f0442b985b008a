"""Removal of byte strings that an earlier document has: a distributed suffix sort.

A byte goes if a string of `LENGTH` bytes that covers it also starts in a document with
a smaller doc_id. Sorting all suffixes of a corpus brings equal strings together; here
the suffixes are first dealt into small buckets that hold all equal ones.

1. Each string of `LENGTH` bytes has an anchor: the sequence of `ANCHOR` bytes in it whose
   hash is least, the leftmost of equals. Neighbouring strings mostly have the same
   anchor; such a run, with all bytes of its strings, is a stretch. Equal strings have
   equal anchors, at the same distance. Only hashes of stretches are dealt out, by
   anchor. A stretch that a smaller doc_id also has is settled, within a task even
   before the shuffle. An anchor whose stretches are all equal is settled, too. Of an
   anchor that a task holds with many different stretches, two stand for it and the
   others are known to be open, so that no anchor is a large group.
2. What is left are stretches with equal anchors but other bytes around them: ends of
   shared passages, places of edits, chance. Their bytes are dealt by the anchor with
   half of its surroundings to the left, and to the right; each string has one of the
   two whole. In each bucket the suffixes at the strings' starts, less those whose hash of
   LENGTH bytes no other has, are sorted by merging; two suffixes are compared by binary search for the length of their common
   beginning, by prefix hashes. Neighbours that seem equal are compared by bytes; if any
   differ after all, the bucket is sorted by its bytes. A key with more stretches than
   a bucket is to have is split over several; of each string such a part passes on those
   of its least doc_id, and these are compared by their bytes with those of other parts.
3. The spans found are brought to their documents, checked against the text by their
   hash, and cut out.

A null or empty text has no bytes and nothing removed. Rows with one doc_id are judged
each on its own against smaller ids, never against each other. A row without doc_id
keeps all its bytes and takes none from others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import release_shuffles, stored
from termloom.llm.jaccard import _mixed

LENGTH = 50
ANCHOR = 16
STRINGS = LENGTH - ANCHOR + 1  # sequences of ANCHOR bytes in a string, and places of an anchor
HALF = STRINGS // 2
HELD = 1_000_000  # stretches that a task holds to settle equal ones
# A task takes an anchor for common if it holds more different stretches of it than a share of all, and than so many.
COMMON_SHARE = 1 << 14
COMMON_LEAST = 8
OPEN = 0x8000  # in a place: open without being judged
BUCKET_STRETCHES = 4_000
SENT_BYTES = 2_000_000  # of open stretches, handed on at once
SENT_KEYS = 1_000_000  # rows of some 20 bytes that may be sent to every task

SPANS = "doc_id bigint, start int, end int, hash bigint"

_random = np.random.default_rng(8)
_LETTERS = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    made = np.ones(max(n, 1), np.uint64)
    if n > 1:
        made[1:] = np.uint64(base)
        made = np.multiply.accumulate(made)
    return made


class _Powers:
    """Powers of the base and its inverse modulo 2^64, as far as they were needed."""

    up = _powers(_BASE, 1 << 16)
    down = _powers(_INVERSE, 1 << 16)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            cls.up, cls.down = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
        return cls.up[:n], cls.down[:n]


class Bytes:
    """The bytes of a text with hashes of all their substrings."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.up, self.down = _Powers.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[data] * self.up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64)).view(np.int64)


def _of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, start, end, and the anchor's place of each stretch, in order."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), *(np.zeros(0, np.int64) for _ in range(3))
    packed = data.astype(np.uint64)
    for size in (1, 2, 4):
        packed = packed[:-size] | packed[size:] << np.uint64(8 * size)
    mixed = packed * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed[:-8] ^ mixed[:-8] >> np.uint64(32)) + packed[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    least = mixed & np.uint64(0xFFFFFFFF00000000) | np.arange(len(mixed), dtype=np.uint64)
    width = 1
    while width * 2 <= STRINGS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < STRINGS:
        least = np.minimum(least[: n - LENGTH + 1], least[STRINGS - width :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    ends = np.append(starts[1:], len(at)) - 1 + LENGTH
    return mixed[at[starts]].view(np.int64), starts, ends, at[starts]


def _first_pass(docs: DataFrame) -> DataFrame:
    """Stretches by anchor, their place as start << 16 | size.

    A stretch that the task has settled has the complement of its place, which is
    negative, and is dealt by its document. So is one of a common anchor, with the bit
    OPEN in its place, but for two different ones, which keep all others of the anchor open.
    """
    names = ["anchor", "stretch", "doc_id", "place"]

    def settle(held: list[tuple]) -> pa.RecordBatch:
        anchor, stretch, doc, start, end = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, stretch, anchor))
        new = np.concatenate([[True], (anchor[order][1:] != anchor[order][:-1]) | (stretch[order][1:] != stretch[order][:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        settled = np.zeros(len(order), bool)
        settled[order] = doc[order] > doc[order][first]
        heads = np.flatnonzero(new)
        group = np.cumsum(np.concatenate([[True], anchor[order][heads][1:] != anchor[order][heads][:-1]])) - 1
        rank = np.arange(len(heads)) - np.flatnonzero(np.diff(group, prepend=-1))[group]
        common = np.bincount(group) > max(COMMON_LEAST, len(order) // COMMON_SHARE)
        open_ = np.zeros(len(order), bool)
        open_[order] = (common[group] & (rank > 1))[np.cumsum(new) - 1]
        open_ &= ~settled
        place = start << 16 | (end - start)
        columns = (np.where(settled | open_, doc, anchor), stretch, doc, np.where(settled, ~place, np.where(open_, place | OPEN, place)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = _of(text.as_py())
                anchor, start, end, _ = stretches(data)
                if len(anchor):
                    held.append((anchor, Bytes(data).hash(start, end), np.full(len(anchor), doc_id, np.int64), start, end))
                    count += len(anchor)
                if count >= HELD:
                    yield settle(held)
                    held, count = [], 0
        if held:
            yield settle(held)

    return docs.select("doc_id", "text").mapInArrow(run, "anchor bigint, stretch bigint, doc_id bigint, place bigint")


def _surrounded(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """Bytes of the open stretches, by side and key: the anchor and what surrounds it on that side."""
    wanted = open_.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "stretch"))).alias("wanted"))
    rows = texts.join(wanted, "doc_id")
    names = ["key", "right", "doc_id", "start", "anchor_at", "bytes"]

    def of_text(doc_id: int, text: str | None, wanted: pa.StructArray) -> tuple[np.ndarray, ...] | None:
        data = _of(text)
        _, start, end, at = stretches(data)
        if not len(start):
            return None
        made = Bytes(data)
        places = wanted.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
        which = np.minimum(np.searchsorted(start, places), len(start) - 1)
        # Another text of the same doc_id may have other stretches.
        own = (start[which] == places) & (made.hash(start[which], end[which]) == wanted.field("stretch").to_numpy(zero_copy_only=False))
        which = which[own]
        s, e, a = start[which], end[which], at[which]
        left = np.flatnonzero(a - s >= HALF)  # strings with a whole half before the anchor
        right = np.flatnonzero(e - a - ANCHOR >= LENGTH - ANCHOR - HALF + 1)
        key = np.concatenate([made.hash(a[left] - HALF, a[left] + ANCHOR), made.hash(a[right], a[right] + LENGTH - HALF + 1)])
        pick = np.concatenate([left, right])
        s, sizes = s[pick], (e - s)[pick]
        content = data[np.arange(sizes.sum()) + np.repeat(s - (np.cumsum(sizes) - sizes), sizes)]
        return key, np.repeat([False, True], [len(left), len(right)]), np.full(len(pick), doc_id), s, a[pick] - s, sizes, content

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        key, right, doc, start, anchor_at, sizes, content = (np.concatenate(x) for x in zip(*made))
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(content)])
        numbers = [key, right, doc.astype(np.int64), start.astype(np.int32), anchor_at.astype(np.int32)]
        return pa.RecordBatch.from_arrays([*map(pa.array, numbers), binary], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                made = of_text(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].values)
                if made is None:
                    continue
                held.append(made)
                size += len(made[-1])
                if size >= SENT_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    schema = "key bigint, right boolean, doc_id bigint, start int, anchor_at int, bytes binary"
    return rows.select("doc_id", "text", "wanted").mapInArrow(run, schema)


class SuffixSorter:
    """Suffixes of joined byte strings, compared by the hashes of their beginnings."""

    def __init__(self, content: Bytes, start: np.ndarray, segment: np.ndarray):
        self.content, self.start, self.segment = content, start, segment

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many of the first LENGTH bytes two suffixes share: binary search over prefix hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), LENGTH, np.int64)
        x, y = self.start[a], self.start[b]
        sums, down = self.content.sums, self.content.down
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = (sums[x + middle] - sums[x]) * down[x] == (sums[y + middle] - sums[y]) * down[y]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Does suffix a come before b? Suffixes of other segments are never looked into."""
        made = self.segment[a] < self.segment[b]
        alike = np.flatnonzero(self.segment[a] == self.segment[b])
        if len(alike):
            x, y = a[alike], b[alike]
            shared = self.common(x, y)
            inside = np.minimum(shared, LENGTH - 1)
            data = self.content.data
            made[alike] = (shared < LENGTH) & (data[self.start[x] + inside] < data[self.start[y] + inside])
        return made

    def sorted(self) -> np.ndarray:
        """Merge sort, all runs of a width at once; pairs of runs in order already are left alone."""
        order = np.argsort(self.segment, kind="stable")
        n, width = len(order), 1
        while width < n:
            begin = np.arange(0, n - width, 2 * width)
            middle, end = begin + width, np.minimum(begin + 2 * width, n)
            mixed = self.less(order[middle], order[middle - 1])
            begin, middle, end = begin[mixed], middle[mixed], end[mixed]
            if len(begin):
                order = self._merged(order, begin, middle, end)
            width *= 2
        return order

    def _merged(self, order: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Each element goes to its place in its own run plus its rank in the other."""
        sizes = end - begin
        pair = np.repeat(np.arange(len(begin)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[pair]
        of_left = at < middle[pair]
        low = np.where(of_left, middle[pair], begin[pair])
        high = np.where(of_left, end[pair], middle[pair])
        base = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            half = (low[open_] + high[open_]) // 2
            mine, theirs = order[at[open_]], order[half]
            # Of equal suffixes those of the left run come first.
            before = self.less(theirs, mine)
            right = np.flatnonzero(~of_left[open_] & ~before)
            before[right] = ~self.less(mine[right], theirs[right])
            low[open_], high[open_] = np.where(before, half + 1, low[open_]), np.where(before, high[open_], half)
        own = np.where(of_left, at - begin[pair], at - middle[pair])
        made = order.copy()
        made[begin[pair] + own + low - base] = order[at]
        return made


def _bucketed(surrounded: DataFrame) -> DataFrame:
    """`surrounded` with the bucket of each row, and if its key is split over several."""
    counts = surrounded.groupBy("key", "right").agg(F.count("*").alias("n"))
    large = stored(counts.where(F.col("n") > BUCKET_STRETCHES), "suffix-keys")
    large = F.broadcast(large) if large.count() <= SENT_KEYS else large
    buckets = max(1, -(-surrounded.count() // (2 * BUCKET_STRETCHES)))
    parts = F.ceil(F.col("n") / BUCKET_STRETCHES)
    part = F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("doc_id", "start"), parts)).otherwise(F.lit(0))
    return surrounded.join(large, ["key", "right"], "left").select(
        *surrounded.columns, F.col("n").isNotNull().alias("split"), F.pmod(F.xxhash64("key", part), F.lit(buckets)).alias("bucket")
    )


def _contents(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column one after the other, and their sizes."""
    whole = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks])
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def _bucket(table: pa.Table) -> pa.Table:
    """Spans of strings in a bucket that a smaller doc_id has as well.

    Of strings with a key that is split, those of the least doc_id here follow, with
    their bytes.
    """
    key, right = table["key"].to_numpy(), table["right"].to_numpy(zero_copy_only=False)
    doc, place = table["doc_id"].to_numpy(), table["start"].to_numpy().astype(np.int64)
    anchor_at = table["anchor_at"].to_numpy().astype(np.int64)
    content, sizes = _contents(table["bytes"])
    group = np.unique(key * 2 + right, return_inverse=True)[1]
    alone = (np.bincount(group)[group] < 2) & ~table["split"].to_numpy(zero_copy_only=False)
    offset = np.cumsum(sizes) - sizes
    data = Bytes(content)
    # The strings of a stretch, by the anchor's distance from their start.
    rows, starts, distances = [], [], []
    for distance in range(STRINGS):
        side = right != (distance >= HALF)
        start = anchor_at - distance
        fits = np.flatnonzero(side & ~alone & (start >= 0) & (start + LENGTH <= sizes))
        rows.append(fits)
        starts.append(offset[fits] + start[fits])
        distances.append(np.full(len(fits), distance))
    row, start, distance = (np.concatenate(x) for x in (rows, starts, distances))
    split = table["split"].to_numpy(zero_copy_only=False)
    # A string whose hash no other one here has is equal to none of them, and is not sorted.
    _, which, count = np.unique(data.hash(start, start + LENGTH), return_inverse=True, return_counts=True)
    asked = (count[which] > 1) | split[row]
    row, start, distance = row[asked], start[asked], distance[asked]
    segment = group[row] * STRINGS + distance
    sorter = SuffixSorter(data, start, segment)
    order = sorter.sorted()
    a, b = order[:-1], order[1:]
    same = segment[a] == segment[b]
    same[same] = sorter.common(a[same], b[same]) >= LENGTH
    window = np.arange(LENGTH)
    x, y = start[a[same]], start[b[same]]
    if not all(np.array_equal(data.data[x[i : i + 65536, None] + window], data.data[y[i : i + 65536, None] + window]) for i in range(0, len(x), 65536)):
        strings = [(segment[i], data.data[s : s + LENGTH].tobytes()) for i, s in enumerate(start)]
        order = np.array(sorted(range(len(start)), key=strings.__getitem__), np.int64)
        same = np.array([strings[i] == strings[j] for i, j in zip(order[:-1], order[1:])], bool)
    first = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
    owner = doc[row[order]]
    heads = np.flatnonzero(first)
    least = np.minimum.reduceat(owner, heads)[np.cumsum(first) - 1] if len(heads) else owner
    gone, rest = order[owner > least], order[(owner == least) & split[row[order]]]
    # Strings of a stretch that overlap are one span.
    gone = gone[np.lexsort((start[gone], row[gone]))]
    apart = (row[gone][1:] != row[gone][:-1]) | (start[gone][1:] - start[gone][:-1] > LENGTH)
    heads = np.flatnonzero(np.concatenate([[True], apart])) if len(gone) else gone
    lasts = np.append(heads[1:], len(gone))[: len(heads)] - 1
    made = np.concatenate([gone[heads], rest])
    begin, end = start[made], np.concatenate([start[gone[lasts]], start[rest]]) + LENGTH
    at = place[row[made]] + begin - offset[row[made]]
    columns = {"doc_id": doc[row[made]], "start": at.astype(np.int32), "end": (at + end - begin).astype(np.int32), "hash": data.hash(begin, end)}
    strings = [None] * len(heads) + [data.data[s : s + LENGTH].tobytes() for s in start[rest]]
    return pa.table({**columns, "string": pa.array(strings, pa.binary())})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, start, end and hash of spans that a smaller doc_id has; they may overlap."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dealt = _first_pass(texts)
    by_anchor, equal = Window.partitionBy("anchor"), Window.partitionBy("anchor", "stretch")
    before = F.col("place") < 0  # settled by a task
    open_ = ~before & (F.col("place").bitwiseAND(F.lit(OPEN)) != 0)
    asked = ~before & ~open_
    judged = dealt.select(
        "*",
        F.min(F.when(asked, F.col("doc_id"))).over(equal).alias("least"),
        F.min(F.when(asked, F.col("stretch"))).over(by_anchor).alias("one"),
        F.max(F.when(asked, F.col("stretch"))).over(by_anchor).alias("other"),
    )
    settled = before | (asked & (F.col("doc_id") > F.col("least")))
    place = F.when(before, F.bitwise_not("place")).otherwise(F.col("place"))
    left = stored(
        judged.where(settled | open_ | (F.col("one") != F.col("other"))).select(
            "doc_id",
            F.shiftright(place, 16).cast("int").alias("start"),
            place.bitwiseAND(F.lit(OPEN - 1)).cast("smallint").alias("size"),
            "stretch",
            settled.alias("settled"),
        ),
        "suffix-stretches",
    )
    del dealt, judged
    release_shuffles(docs.sparkSession)
    whole = left.where("settled").select("doc_id", "start", (F.col("start") + F.col("size")).alias("end"), F.col("stretch").alias("hash"))
    # Stored, as keys are counted before they are dealt.
    surrounded = stored(_surrounded(texts, left.where("not settled").select("doc_id", "start", "stretch")), "suffix-surrounded")
    release_shuffles(docs.sparkSession)
    grouped = _bucketed(surrounded).groupBy("bucket")
    found = stored(grouped.applyInArrow(lambda table: _bucket(table), f"{SPANS}, string binary"), "suffix-spans")
    del surrounded, grouped
    release_shuffles(docs.sparkSession)
    columns = ["doc_id", "start", "end", "hash"]
    parts = found.where("string is null").select(columns)
    least = F.min("doc_id").over(Window.partitionBy("string"))
    merged = found.where("string is not null").withColumn("least", least).where("doc_id > least").select(columns)
    return whole.union(parts).union(merged)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row of `docs`."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    spans = repeated_spans(docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "hash")).alias("spans"))
    rows = texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for i in range(batch.num_rows):
                data = _of(batch.column(1)[i].as_py())
                spans = batch.column(2)[i]
                keep, removed = np.ones(len(data), bool), 0
                if spans.is_valid:
                    start, end, hashed = (spans.values.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end", "hash"))
                    inside = end <= len(data)
                    start, end, hashed = start[inside].astype(np.int64), end[inside].astype(np.int64), hashed[inside]
                    own = Bytes(data).hash(start, end) == hashed
                    change = np.zeros(len(data) + 1, np.int64)
                    np.add.at(change, start[own], 1)
                    np.add.at(change, end[own], -1)
                    keep = np.cumsum(change)[:-1] == 0
                gone = ~keep
                runs = int(gone[:1].sum() + (gone[1:] & keep[:-1]).sum())
                made.append((len(data), int(gone.sum()), runs, data[keep].tobytes()))
            columns = list(zip(*made)) if made else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())], names=names
            )

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


