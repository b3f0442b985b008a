"""Personal data in texts: four known forms, and what a conditional random field adds.

The nodes of the field are the words with digits or an at sign. Neighbouring ones are
linked as a chain, and each is linked to the previous word of the same text that
equals it, or that ends in the same seven digits: these skip links make distant
mentions share what they say. Words within a known form are observed. What an observed
word says fades along a chain of links, so a word between two that are not observed is
also linked to the latest such word before it that is, or else to the first after it.
Loopy message passing, until the messages rest, gives each other word the probability of
its labels, and one that is more likely of a kind than all else becomes a span.

The weights are learnt from the known forms themselves, by pseudo-likelihood: the
words of all texts are counted by shape, cue, labels of the linked words and own
label. There are as many counts as such combinations, so they fit on the driver
whatever the data, and the fit over them is the fit over all words.

Places are code points, ends exclusive. A null or empty text has no spans. Every row
of the input gives one row, repeated ones too. Without any known form in the table
the field adds nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import map_texts, slices

# The kinds in the order in which they are listed, and their forms; fixed values.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NODE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
ANY_NODE = re.compile(r"[0-9@]")
WORD_BEFORE = re.compile(r"(\w+)\W{1,3}$")
CUES = {
    "email": 1, "mail": 1, "contact": 1, "write": 1,
    "ip": 2, "host": 2, "server": 2, "address": 2,
    "card": 3, "visa": 3, "credit": 3, "account": 3,
    "phone": 4, "tel": 4, "call": 4, "mobile": 4, "fax": 4,
}
# Numbers of values of the attributes of a node: digits, at signs, dots, letters, plus, marks, cue.
SIZES = (8, 3, 5, 3, 2, 3, 5)
LABELS = len(KINDS) + 1  # the first is none
NOBODY = LABELS  # the label of a linked word that does not exist
ROUNDS = 10  # of messages, besides two for each link of the longest chain
RESTING = 1e-6  # change of a message that is passed on no more
DAMPING = 0.3
SURE = 0.5
PENALTY = 1.0


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign outwards, so that long runs are read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free if found else at + 1)


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".") if p.strip("0")):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                spans.append((3, *m.span()))
    return spans


class Graph:
    """The nodes and links of some texts: one field of unconnected parts."""

    def __init__(self, texts: list[str]):
        self.known: list[list] = []
        self.where: list[tuple[int, int, int]] = []  # text, start, end
        labels, attributes, chain, skip, direct = [], [], [], [], []
        self.longest = [0] * len(texts)  # links in a row, of one kind, in each text
        for i, text in enumerate(texts):
            if not ANY_NODE.search(text):
                self.known.append([])
                continue
            spans = known_spans(text)
            self.known.append(spans)
            by_place = sorted((a, b, k) for k, a, b in spans)
            latest: dict[str, int] = {}
            observed: dict[str, int] = {}
            waiting: dict[str, list[int]] = {}
            length: dict[str, int] = {}
            next_span, previous_end, run = 0, -1, 0
            for m in NODE.finditer(text):
                core = m.group().strip("\"'`,;:!?()[]{}<>.#$%&*|")
                start = m.start() + m.group().find(core) if core else m.start()
                end = start + len(core) if core else m.end()
                while next_span < len(by_place) and by_place[next_span][1] <= m.start():
                    next_span += 1
                label, k = 0, next_span
                while k < len(by_place) and by_place[k][0] < m.end():
                    if by_place[k][1] > m.start():
                        label = by_place[k][2] + 1
                        break
                    k += 1
                node = len(labels)
                labels.append(label)
                attributes.append(self._attributes(text, m.start(), core))
                self.where.append((i, start, end))
                if previous_end >= 0 and text[previous_end : m.start()].isspace():
                    chain.append((node - 1, node))
                    run += 1
                else:
                    run = 0
                previous_end = m.end()
                digits = re.sub(r"[^0-9]", "", core)
                key = digits[-7:] if len(digits) >= 7 else core.lower()
                before = latest.get(key)
                if before is not None:
                    skip.append((before, node))
                if label:
                    # The last that waits has the skip link.
                    direct += [(node, other) for other in waiting.pop(key, [])[:-1]]
                    observed[key] = node
                elif key not in observed:
                    waiting.setdefault(key, []).append(node)
                elif not labels[before]:
                    direct.append((observed[key], node))
                latest[key] = node
                length[key] = length.get(key, 0) + 1
                self.longest[i] = max(self.longest[i], run, length[key])
        self.labels = np.array(labels, np.int64)
        self.attributes = np.array(attributes, np.int64).reshape(-1, len(SIZES))
        self.chain = np.array(chain, np.int64).reshape(-1, 2)
        self.skip = np.array(skip, np.int64).reshape(-1, 2)
        self.direct = np.array(direct, np.int64).reshape(-1, 2)

    @staticmethod
    def _attributes(text: str, at: int, core: str) -> tuple:
        digits = sum(c.isdigit() for c in core)
        letters = sum(c.isalpha() for c in core)
        found = WORD_BEFORE.search(text, max(0, at - 24), at)
        return (
            sum(digits > limit for limit in (0, 3, 4, 6, 8, 12, 19)),
            0 if "@" not in core else 2 if "." in core[core.find("@") :] else 1,
            min(core.count("."), 4),
            0 if not letters else 1 if letters <= digits else 2,
            int(core.startswith("+")),
            (2 if "(" in core or ")" in core else 1) if re.search(r"[()/_=:-]", core) else 0,
            CUES.get(found[1].lower(), 0) if found else 0,
        )

    def linked(self) -> np.ndarray:
        """Of each node the labels of the words before and after it, by chain and by skip link."""
        made = np.full((len(self.labels), 4), NOBODY, np.int64)
        for column, links in ((0, self.chain), (2, self.skip)):
            made[links[:, 1], column] = self.labels[links[:, 0]]
            made[links[:, 0], column + 1] = self.labels[links[:, 1]]
        return made


class Field:
    """The potentials: of attributes, chain links and skip links."""

    def __init__(self):
        self.unary = [np.zeros((n, LABELS)) for n in SIZES]
        self.bias = np.zeros(LABELS)
        self.chain = np.zeros((LABELS, LABELS))
        self.skip = np.zeros((LABELS, LABELS))

    def fit(self, cells: np.ndarray, counts: np.ndarray) -> Field:
        """Pseudo-likelihood of the labels, by accelerated gradient steps over the counted cells."""
        if not len(cells):
            return self
        a = len(SIZES)
        attributes, linked, labels = cells[:, :a], cells[:, a : a + 4], cells[:, -1]
        # One-hot columns: attributes, the label before, the label after, linked by skip, the constant.
        blocks = [np.eye(n)[attributes[:, i]] for i, n in enumerate(SIZES)]
        hot = np.vstack([np.eye(LABELS), np.zeros(LABELS)])
        blocks += [hot[linked[:, 0]], hot[linked[:, 1]], hot[linked[:, 2]] + hot[linked[:, 3]], np.ones((len(cells), 1))]
        x = np.hstack(blocks)
        target = np.eye(LABELS)[labels]
        total = counts.sum()
        share = counts[:, None] / total
        step = 1 / (0.5 * (x * x).sum(axis=1).max() + PENALTY / total)
        w = ahead = np.zeros((x.shape[1], LABELS))
        for k in range(1500):
            p = np.exp(x @ ahead - (x @ ahead).max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            following = ahead - step * (x.T @ (share * (p - target)) + PENALTY / total * ahead)
            ahead = following + k / (k + 3) * (following - w)
            w = following
        at = 0
        for i, n in enumerate(SIZES):
            self.unary[i] = w[at : at + n]
            at += n
        before, after, skip = (w[at + i * LABELS : at + (i + 1) * LABELS] for i in range(3))
        self.chain = (before + after.T) / 2
        self.skip = (skip + skip.T) / 2
        self.bias = w[-1]
        return self

    def marginals(self, graph: Graph) -> np.ndarray:
        """Of each node the probabilities of its labels; observed nodes keep theirs."""
        score = self.bias + sum(u[graph.attributes[:, i]] for i, u in enumerate(self.unary))
        score[graph.labels > 0] = -50.0
        seen = np.flatnonzero(graph.labels)
        score[seen, graph.labels[seen]] = 50.0
        score -= score.max(axis=1, keepdims=True)
        links = np.vstack([graph.chain, graph.skip, graph.direct])
        kinds = [self.chain] * len(graph.chain) + [self.skip] * (len(graph.skip) + len(graph.direct))
        pair = np.stack(kinds) if len(links) else np.zeros((0, LABELS, LABELS))
        # Messages along each link, forwards and backwards, as logarithms.
        source, to = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        potential = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        message = np.zeros((len(source), LABELS))
        # Observed nodes hear nothing: many messages would outvote them.
        hears = graph.labels[to] == 0
        active = np.flatnonzero(hears)
        # By its own text: what lies beside a text in a batch changes nothing in it.
        text = np.array([i for i, _, _ in graph.where], np.int64)
        rounds = ROUNDS + 2 * np.array(graph.longest, np.int64)[text[to]]
        for k in range(rounds.max(initial=0)):
            active = active[rounds[active] > k]
            if not len(active):
                break
            sent = (score[source[active]] - message[back[active]])[:, :, None] + potential[active]
            top = sent.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(sent - top).sum(axis=1, keepdims=True)))[:, 0, :]
            new -= new.max(axis=1, keepdims=True)
            change = (1 - DAMPING) * (new - message[active])
            message[active] += change
            np.add.at(score, to[active], change)
            # Those that moved go on, and those that listen to them.
            moved = active[np.abs(change).max(axis=1) > RESTING]
            heard = np.zeros(len(score), bool)
            heard[to[moved]] = True
            following = heard[source]
            following[moved] = True
            active = np.flatnonzero(following & hears)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def spans(self, texts: list[str]) -> tuple[list, list]:
        """Known spans, and all spans, of each text."""
        graph = Graph(texts)
        found = [list(k) for k in graph.known]
        if len(graph.labels):
            p = self.marginals(graph)
            best = p.argmax(axis=1)
            for node in np.flatnonzero((graph.labels == 0) & (best > 0) & (p.max(axis=1) >= SURE)):
                i, start, end = graph.where[node]
                found[i].append((int(best[node]) - 1, start, end))
        return graph.known, [sorted(f) for f in found]


def fit(docs: DataFrame, text: str = "text") -> Field:
    """The field that the known forms of all texts teach."""
    sizes = [*SIZES, *[LABELS + 1] * 4, LABELS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in slices(texts):
                graph = Graph(texts[part])
                if len(graph.labels):
                    cells = np.hstack([graph.attributes, graph.linked(), graph.labels[:, None]])
                    packed, n = np.unique(np.ravel_multi_index(cells.T, sizes), return_counts=True)
                    counts.update(dict(zip(packed.tolist(), n.tolist())))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(list(counts), pa.int64()), "n": pa.array(list(counts.values()), pa.int64())})

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = texts.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found.sort(key=lambda r: r.cell)
    cells = np.array(np.unravel_index(np.array([r.cell for r in found], np.int64), sizes), np.int64).T
    return Field().fit(cells, np.array([r.n for r in found], float))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_pii(docs: DataFrame, columns: list[str], field: Field | None = None, text: str = "text") -> DataFrame:
    """`columns` with `known` and `found`: kind, start and end of spans, by kind, then start."""
    model = docs.sparkSession.sparkContext.broadcast(field or fit(docs, text))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(texts: list[str]) -> dict:
        made = model.value.spans(texts)
        return {
            name: pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans] for spans in lists], kind)
            for name, lists in zip(("known", "found"), made)
        }

    return map_texts(docs, columns, {"known": SPANS, "found": SPANS}, work, text)


def redacted(docs: DataFrame, columns: list[str], field: Field | None = None, text: str = "text") -> DataFrame:
    """`columns` and `redacted`, the text with each span replaced by its kind in brackets."""
    model = docs.sparkSession.sparkContext.broadcast(field or fit(docs, text))

    def replace(content: str, spans: list) -> str:
        made, at = [], 0
        for start, end, kind in sorted((a, b, k) for k, a, b in spans):
            if start >= at:
                made += [content[at:start], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)  # what overlaps goes with the first
        return "".join(made) + content[at:]

    def work(texts: list[str]) -> dict:
        found = model.value.spans(texts)[1]
        return {"redacted": [replace(t, s) if s else t for t, s in zip(texts, found)]}

    return map_texts(docs, columns, {"redacted": "string"}, work, text)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
