"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WHITE = re.compile("[^\x20\x09-\x0d]+")
LETTERS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def shingles(text: str | None) -> frozenset:
    words = WHITE.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near(docs: list[tuple]) -> Counter:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    groups = Groups(len(docs))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * len(a | sets[j]):
                groups.join(i, j)
    low: dict[int, list] = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        low[groups.find(i)].append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in low.items()}
    return Counter((doc, len(sets[i]), least[groups.find(i)]) for i, (doc, _) in enumerate(docs))


def repeats(docs: list[tuple], length: int = 400) -> Counter:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows."""
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out: Counter = Counter()
    for (doc, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def windows(text: str | None) -> tuple[list[str], list[tuple]]:
    words = LETTERS.findall((text or "").translate(LOWER))
    return words, [tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))] if words else []


def contaminated(docs: list[tuple], items: list[tuple]) -> Counter:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    wanted: dict[tuple, set[str]] = defaultdict(set)
    for item, text in items:
        for w in windows(text)[1]:
            if item is not None:
                wanted[w].add(str(item))
    sizes = {len(w) for w in wanted}
    out: Counter = Counter()
    for doc, text in docs:
        words, hit, found = windows(text)[0], set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(words[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc, len(words), len(hit), len(found), digest, bool(hit)] += 1
    return out


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]
