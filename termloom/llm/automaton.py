"""The automaton of correct token sequences of a byte-pair encoding.

The merges are compiled one after the other. Before the first, one state has an
arc back to itself for every single symbol. The merge of u and v changes that
automaton so that v no longer follows u and their concatenation takes the place:
the arcs labelled u are led to a copy of their state that lacks the arc v, and
every state with an arc u gets an arc uv to where v led. All arcs of a label lead
to one state, so a merge makes one new state, and a state is what the last token
permits to follow.

A copy is not written out: it notes the state it was copied from, when, and the
one arc it lacks. Whether a state has an arc follows from these notes, and what
has been asked before is looked up in a table.
"""

from __future__ import annotations

import ctypes
import gc
import json

import pyarrow as pa

ROOT = 0
# Answers kept in the table of arcs, and words kept in a cache of results.
TABLE_SIZE = 500_000


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeAutomaton:
    """States and arcs, and a tree of the labels to read words with.

    `suffix` marks the last symbol of a word in vocabularies that have such a mark.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str | None = None):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        size = max(vocabulary.values()) + 1
        self.suffix = suffix
        self.labels = [""] * size
        for label, token in vocabulary.items():
            self.labels[token] = label
        self.first = [-1] * size  # the left half of a merged token
        self.born = [-1] * size  # the merge that made it
        # of states: copied from, at which merge, without which arc
        self.origin, self.since, self.without = [-1], [-1], [-1]
        self.target = [ROOT] * size  # where the arcs of a token lead
        self.arcs: dict[int, bool] = {}
        for time, (left, right) in enumerate(pairs):
            self._merge(time, vocabulary[left], vocabulary[right], vocabulary[left + right])
        self.arcs.clear()
        self._grow_tree(vocabulary)

    def _merge(self, time: int, u: int, v: int, merged: int) -> None:
        before = self.target[u]
        if self.born[merged] >= 0 or not self.has_arc(before, v):
            return
        self.arcs.clear()
        self.origin.append(before)
        self.since.append(time)
        self.without.append(v)
        self.first[merged], self.born[merged] = u, time
        self.target[merged] = before if u == v else self.target[v]
        self.target[u] = len(self.origin) - 1

    def has_arc(self, state: int, token: int) -> bool:
        """May the token follow in this state?"""
        key = state << 20 | token
        known = self.arcs.get(key)
        if known is not None:
            return known
        at, asked = state, token
        while True:
            if asked == self.without[at]:
                answer = False
                break
            if at == ROOT:
                answer = True
                break
            if self.born[asked] >= self.since[at]:
                asked = self.first[asked]
            else:
                at = self.origin[at]
        if len(self.arcs) > TABLE_SIZE:
            self.arcs.clear()
        self.arcs[key] = answer
        return answer

    def _grow_tree(self, vocabulary: dict[str, int]) -> None:
        """The labels by their bytes: children of a node and a byte, tokens of a node."""
        byte = byte_symbols()
        self.children: dict[int, int] = {}
        self.inner, self.final = [-1], [-1]  # the token spelt here, and that which ends a word
        self.leaf = [False]
        for label, token in vocabulary.items():
            bare = label.removesuffix(self.suffix) if self.suffix else label
            if self.first[token] < 0 and len(bare) > 1:
                continue  # no merge makes it
            node = 0
            for symbol in bare:
                key = node << 8 | byte[symbol]
                if key not in self.children:
                    self.children[key] = len(self.inner)
                    self.inner.append(-1)
                    self.final.append(-1)
                    self.leaf.append(True)
                    self.leaf[node] = False
                node = self.children[key]
            (self.final if bare != label or not self.suffix else self.inner)[node] = token
        if not self.suffix:
            self.inner = self.final

    def encode(self, word: bytes) -> list[int]:
        """The one accepted path that spells the word.

        Long arcs are tried first. Only one path leads to each place in a word, so
        a place from which the end was not reached is never tried again.
        """
        n, at, state = len(word), 0, ROOT
        path: list[int] = []
        open_: list[tuple[int, int, list]] = []  # place, state, arcs not yet tried
        dead = set()
        children, inner, final, target, arcs = self.children, self.inner, self.final, self.target, self.arcs
        while at < n:
            found, node = [], 0
            for j in range(at, n):
                node = children.get(node << 8 | word[j])
                if node is None:
                    break
                token = inner[node] if j < n - 1 else final[node]
                if token >= 0:
                    found.append((token, j + 1))
            while True:
                while found:
                    token, end = found.pop()
                    if end in dead:
                        continue
                    known = arcs.get(state << 20 | token)
                    if known if known is not None else self.has_arc(state, token):
                        break
                else:
                    dead.add(at)
                    at, state, found = open_.pop()
                    path.pop()
                    continue
                break
            open_.append((at, state, found))
            path.append(token)
            at, state = end, target[token]
        return path


def load(text: str) -> tuple[MergeAutomaton, dict[str, int]]:
    """The automaton of a tokenizer file, and the ids of its added tokens."""
    spec = json.loads(text)
    model = spec["model"]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    automaton = MergeAutomaton(model["vocab"], model["merges"], model.get("end_of_word_suffix"))
    return automaton, added


_LOADED: dict[str, tuple] = {}


def loaded(key: str, text: str, make) -> object:
    """What `make` builds of a tokenizer file, built once in a worker process."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = make(text)
    return _LOADED[key]


def release(keep: str | None) -> None:
    """Give back the memory of what other operators built in this process, which outlives their tasks."""
    if _LOADED.keys() - {keep}:
        _LOADED.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Return what is free in this process to the system: the allocators keep it for themselves."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)
