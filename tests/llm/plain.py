"""Plain, slow versions of what the operators compute."""

import hashlib
import math
import re

from termloom.llm import decontamination, secret_scan

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def secret_spans(text: str) -> tuple[list, list]:
    known = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    known += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    known += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    more = []
    for kind, (pattern, _, least) in secret_scan.CLASSES.items():
        for m in re.finditer(pattern, text):
            w = min(secret_scan.WINDOW, len(m[0]))
            harmless = all(re.search(secret_scan.ALLOWED, piece) for piece in re.split(secret_scan.MARKS, m[0]))
            mixed = w == secret_scan.WINDOW or re.search("[A-Za-z]", m[0]) and re.search("[0-9]", m[0])
            if not harmless and mixed and best_entropy(m[0], w) >= math.log2(w) * (least / math.log2(secret_scan.WINDOW)):
                more.append((kind, *m.span()))
    order = secret_scan.KINDS.index
    return tuple(sorted(spans, key=lambda s: (s[1], order(s[0]))) for spans in (known, known + more))


def best_entropy(string: str, w: int) -> float:
    windows = (string[i : i + w] for i in range(len(string) - w + 1))
    return max(-sum(x.count(c) / w * math.log2(x.count(c) / w) for c in set(x)) for x in windows)


def contaminated(docs: list, items: list) -> set:
    """(doc_id, item_id, agreeing, window) by laying every window at every distance."""
    import regex

    def words(text):
        return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())

    best: dict = {}
    for doc_id, text in docs:
        d = words(text)
        at: dict = {}
        for i, w in enumerate(d):
            at.setdefault(w, []).append(i)
        for item_id, passage in items:
            t = words(passage)
            if doc_id is None or item_id is None or not t:
                continue
            w = min(decontamination.WINDOW, len(t))
            for p, i in {(p, i) for p in range(len(t)) for i in at.get(t[p], [])}:
                for s in range(max(p - w + 1, 0), min(p, len(t) - w) + 1):
                    if i + s - p >= 0 and i + s - p + w <= len(d):
                        n = sum(d[i + s - p + k] == t[s + k] for k in range(w))
                        if n >= math.ceil(w * decontamination.AGREEMENT):
                            best[doc_id, item_id] = max(best.get((doc_id, item_id), (0, w)), (n, w))
    return {(*key, *value) for key, value in best.items()}


def kept_bytes(docs: list, length: int = 50) -> list:
    """(doc_id, bytes, removed, spans, digest) of each row."""
    first: dict = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            if doc_id is not None:
                s = data[p : p + length]
                first[s] = min(first.get(s, doc_id), doc_id)
    made = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if doc_id is not None and first[data[p : p + length]] < doc_id:
                gone[p : p + length] = b"\1" * length
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        rest = bytes(b for b, g in zip(data, gone) if not g)
        made.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return made


def shingle_set(text: str | None) -> frozenset:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(nodes, links) -> dict:
    """The least node that each can reach."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def jaccard(docs: list) -> list:
    """(doc_id, size of the set, component) of each row, by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    links.append((i, j))
    least = components({i for i, _ in docs if i is not None}, links)
    return [(i, len(s), least.get(i)) for i, s in sets]
