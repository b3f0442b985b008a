"""Counting tokens without making them.

The merges are compiled into a deterministic transducer over bytes whose transitions
carry the number of tokens that they settle. Its state is what the rest of a word may
still depend on: every place where an unfinished token may have begun, as a node of
the tree of tokens, the state of the merge automaton there, and the tokens up to
there beyond those settled. States and transitions are built when first met.

A text is cut into chunks. A chunk's map is `head, count, tail`: the tokens between
the first and the last place where a word surely begins, whatever stands before, and
the unfinished ends. Maps compose associatively, so a long text is counted as a tree
of pairs of neighbours, as in a parallel prefix scan; only the ends are read again.

Results of edge cases: a null or empty text has 0 bytes and 0 tokens; strings of
special tokens inside a text are one token each; every row gives one row.
"""

from __future__ import annotations

import public_tokenizers
import regex
from pyspark.sql import DataFrame

from termloom.llm import automaton
from termloom.llm.bpe import LibraryWords, WordPattern, _shared, unassigned
from termloom.llm.common import map_texts

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
# The usual pattern of byte-level vocabularies, its disjoint alternatives in order of frequency.
WORDS = r" ?{L}+| ?{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{S}{L}{N}]+|{S}+(?![^{S}])|{S}+"
CHUNK_CHARS = 65_536
CACHED_WORDS = 500_000
CACHED_STATES = 100_000


class CountTransducer:
    """Bytes of a word in, number of tokens out."""

    def __init__(self, machine: automaton.MergeAutomaton):
        self.machine = machine
        self._forget()

    def _forget(self) -> None:
        # A state is a row of numbers: node << 44 | state of the automaton << 20 | tokens.
        start = (automaton.ROOT << 20,)
        self.states, self.known = [start], {start: 0}
        self.table: dict[int, int] = {}  # state and byte to state and settled tokens

    def _transition(self, state: int, byte: int) -> int:
        machine = self.machine
        children, tokens, leaf, arcs = machine.children, machine.inner, machine.leaf, machine.arcs
        going, settled, ended = [], 1 << 20, 0
        for packed in self.states[state]:
            child = children.get(packed >> 44 << 8 | byte)
            if child is None:
                continue
            rest = packed & 0xFFFFFFFFFFF
            if not leaf[child]:
                going.append(child << 44 | rest)
                settled = min(settled, rest & 0xFFFFF)
            token = tokens[child]
            if token >= 0:
                known = arcs.get(rest >> 20 << 20 | token)
                if known if known is not None else machine.has_arc(rest >> 20, token):
                    ended = machine.target[token] << 20 | (rest & 0xFFFFF) + 1
        going.append(ended)  # single bytes are tokens, so some token always ends here
        settled = min(settled, ended & 0xFFFFF)
        key = tuple([packed - settled for packed in going])
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = len(self.states)
            self.states.append(key)
        made = number << 24 | settled
        self.table[state << 8 | byte] = made
        return made

    def count(self, word: bytes) -> int:
        if len(self.states) > CACHED_STATES:
            self._forget()
        state = total = 0
        get = self.table.get
        for byte in word:
            made = get(state << 8 | byte)
            if made is None:
                made = self._transition(state, byte)
            state = made >> 24
            total += made & 0xFFFFFF
        return total + (self.states[state][-1] & 0xFFFFF)


class TokenCounter:
    def __init__(self, text: str):
        machine, added = automaton.load(text)
        self.transducer = CountTransducer(machine)
        self.words, self.library = WordPattern(WORDS), LibraryWords(text)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        # A word begins wherever white space follows something else.
        self.edge = regex.compile(r"(?<=\S)(?=\s)")
        self.last_edge = regex.compile(r"(?r)(?<=\S)(?=\s)")
        self.known: dict[str, int] = {}

    def _word(self, word: str) -> int:
        count = self.transducer.count(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 40:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = count
        return count

    def _plain(self, text: str) -> int:
        known, make = self.known, self._word
        newer = not text.isascii() and unassigned().search(text)
        return sum([known.get(w) or make(w) for w in (self.library if newer else self.words).findall(text)])

    def _whole(self, text: str) -> int:
        """Tokens of a text that nothing precedes or follows."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def chunk(self, text: str) -> tuple[str, int, str | None]:
        """The map of a chunk; without an inner edge all of it is head, and the tail is None."""
        first = self.edge.search(text)
        if first is None:
            return text, 0, None
        last = self.last_edge.search(text)
        return text[: first.start()], self._whole(text[first.start() : last.start()]), text[last.start() :]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbours. Where they meet may be an edge that neither has seen."""
        if a[2] is None and b[2] is None:
            return self._joined(a[0], b[0])
        if a[2] is None:
            head, count, tail = self._joined(a[0], b[0])
            return (head, b[1], b[2]) if tail is None else (head, count + self._whole(tail) + b[1], b[2])
        head, count, tail = self._joined(a[2], b[0])
        if b[2] is None:
            return (a[0], a[1], head) if tail is None else (a[0], a[1] + self._whole(head) + count, tail)
        return a[0], a[1] + self._whole(head) + count + (self._whole(tail) if tail is not None else 0) + b[1], b[2]

    def _joined(self, left: str, right: str) -> tuple[str, int, str | None]:
        """Two pieces without inner edges; one may lie between them."""
        if left and right and not left[-1].isspace() and self.edge.search(left[-1] + right[0]):
            return left, 0, right
        return left + right, 0, None

    def count(self, text: str) -> int:
        maps = [self.chunk(text[i : i + CHUNK_CHARS]) for i in range(0, len(text), CHUNK_CHARS)]
        while len(maps) > 1:
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(pairs) * 2 :]
        if not maps:
            return 0
        head, count, tail = maps[0]
        return self._whole(head) + count + (self._whole(tail) if tail is not None else 0)


def token_counts(
    docs: DataFrame, columns: list[str], path: str | None = None, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """`columns`, n_bytes, n_tokens, and whether those are over the limit."""
    key, file = _shared(docs, path or public_tokenizers.path(VOCABULARY))

    def work(texts: list[str]) -> dict:
        counter = automaton.loaded(f"counter {key}", file.value, TokenCounter)
        counts = [counter.count(t) for t in texts]
        return {
            "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    more = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    return map_texts(docs, columns, more, work, text, f"counter {key}")


