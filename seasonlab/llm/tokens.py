"""Exact token counts of every prefix of a text, stored once and asked often.

A byte-level BPE tokenizer cuts a text into pieces by a pattern and merges the bytes of
each piece by rank. The last token of any stretch's encoding is the only token that ends
it and does not clash with the last token of what is left before it. So one pass over a
piece gives the last token, and the number of tokens, of every prefix: a dynamic program
over prefixes, not one encoding per prefix. What is stored of a text is the change of
that number from each prefix to the next, as 16-bit integers, one per code point. How
many tokens the first k characters have, and how much of a text fits a budget, are then
sums of stored changes, whatever budgets are asked later.

The prefixes are those of the text, not of its pieces: a cut in a run of white space, in
a shortened word (``'ll``) or in a special token is encoded as the cut text would be.

Null texts are empty and have no tokens; null and repeated ids are as good as any;
columns of the input stay as they are, and an input column named like a new one is
replaced. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

# The pattern by which byte-level BPE cuts a text, its shortened words, and
# the bytes that stand for themselves in its vocabulary files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORTENED = ["'re", "'ve", "'ll"]
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

CACHE_PIECES = 500_000  # remembered pieces and their changes, per worker
CACHE_PAIRS = 1 << 20  # remembered answers on neighbouring tokens of long pieces, per worker
LONG_PIECE = 64  # bytes; longer pieces are worked on one by one and not remembered
OUT_CHARS = 1 << 21  # characters of text worked on together


def _letters() -> dict[str, int]:
    """The byte that each letter of a vocabulary file stands for."""
    others = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}


class _Table:
    """Values by whole-number key for many keys at once; open addressing."""

    def __init__(self, known: dict[int, int]):
        self.bits = max(4, (4 * len(known)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        keys, values = np.fromiter(known, np.int64, len(known)), np.fromiter(known.values(), np.int32, len(known))
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # one of those that meet in a slot stays
            put = self.keys[at] == keys
            self.values[at[put]] = values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found, there = self.values[at], self.keys[at]
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there[left], found[left] = self.keys[at[left]], self.values[at[left]]
            left = left[(there[left] != keys[left]) & (there[left] >= 0)]
        found[there < 0] = -1
        return found


class PrefixCounter:
    """Counts tokens of prefixes for a byte-level BPE, given as a tokenizer's JSON text.

    Refuses a tokenizer of another kind: one that normalises, cuts otherwise, falls back,
    or makes a token by more than one merge.
    """

    def __init__(self, spec: str):
        told = json.loads(spec)
        model, cut = told["model"], told["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        odd += [k for k in ("fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or told["normalizer"] or odd:
            raise ValueError("not a plain byte-level BPE tokenizer")
        letter = _letters()
        size = 1 + max(model["vocab"].values())
        self.size = size
        self.merges: dict[int, int] = {}  # left * size + right: rank
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        data = {i: bytes(letter[c] for c in name) for name, i in model["vocab"].items()}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if self.rank[z] >= 0 or max(self.rank[x], self.rank[y]) >= rank or len(data[z]) < 2:
                raise ValueError(f"token {z} is made by more than one merge, or before its parts")
            self.merges[x * size + y], self.left[z], self.right[z], self.rank[z] = rank, x, y, rank
        if any(self.rank[i] < 0 and len(d) > 1 for i, d in data.items()):
            raise ValueError("a token is made by no merge")
        whole = [False] * size  # tokens that encode their own bytes
        for i in sorted(data, key=self.rank.__getitem__):
            x, y, r = self.left[i], self.right[i], self.rank[i]
            whole[i] = r < 0 or (whole[x] and whole[y] and not self._clash(x, y, r))
        self.tokens = {d: i for i, d in data.items() if whole[i]}
        self._index()
        self.joined: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.cut = regex.compile(PATTERN)
        self.blank = regex.compile(r"\s{2,}(?=\S)")
        special = [t for t in told.get("added_tokens") or []]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
            raise ValueError("special tokens that take neighbouring characters")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def _clash(self, a: int, b: int, before: int) -> bool:
        """Whether neighbouring tokens do not stay apart: a merge across their border comes
        before the border's two sides are merged with what is behind them."""
        merges, size, rank = self.merges, self.size, self.rank
        x, x_ends = a, before
        while x >= 0:
            y, y_ends = b, before
            while y >= 0:
                r = merges.get(x * size + y)
                if r is not None and r < x_ends and r <= y_ends:
                    return True
                y, y_ends = self.left[y], rank[y]
            x, x_ends = self.right[x], rank[x]
        return False

    def _index(self) -> None:
        """A trie of the tokens read backwards, and arrays of what the merges say."""
        ways: dict[int, int] = {}
        ends = [-1]
        for data, token in self.tokens.items():
            node = 0
            for byte in reversed(data):
                key = node * 256 + byte
                node = ways.setdefault(key, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = token
        self.tails = {d[k:] for d in self.tokens for k in range(len(d))}
        self.ways, self.ends, self.ranks = _Table(ways), np.array(ends, dtype=np.int64), _Table(self.merges)
        self.lefts, self.rights, self.made = (np.array(v, dtype=np.int64) for v in (self.left, self.right, self.rank))

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of neighbouring tokens stay apart: :meth:`_clash` of many pairs."""
        apart = np.ones(len(a), dtype=bool)
        at, x, x_ends = np.arange(len(a)), a, np.full(len(a), len(self.merges))
        while len(at):
            inner, y, y_ends = np.arange(len(at)), b[at], np.full(len(at), len(self.merges))
            while len(inner):
                r = self.ranks[x[inner] * self.size + y]
                clash = (r >= 0) & (r < x_ends[inner]) & (r <= y_ends)
                apart[at[inner[clash]]] = False
                y_ends, y = self.made[y], self.lefts[y]
                on = ~clash & (y >= 0)
                inner, y, y_ends = inner[on], y[on], y_ends[on]
            x_ends, x = self.made[x], self.rights[x]
            on = apart[at] & (x >= 0)
            at, x, x_ends = at[on], x[on], x_ends[on]
        return apart

    def _programs(self, pieces: list[str]) -> None:
        """The program of :meth:`_program` for many short pieces at once, one end after the other."""
        both = sorted(((p.encode(), p) for p in pieces), key=lambda b: len(b[0]), reverse=True)
        data = [d for d, _ in both]
        sizes = np.array([len(d) for d in data])
        width = int(sizes[0])
        letters = np.frombuffer(b"".join(d.ljust(width, b"a") for d in data), dtype=np.uint8).reshape(len(data), width).astype(np.int64)
        last = np.full((len(data), width + 1), -1, dtype=np.int64)
        count = np.zeros((len(data), width + 1), dtype=np.int64)
        for end in range(1, width + 1):
            rows = np.arange(int(np.searchsorted(-sizes, -end, side="right")))
            node = np.zeros(len(rows), dtype=np.int64)
            for start in range(end - 1, -1, -1):
                node = self.ways[node * 256 + letters[rows, start]].astype(np.int64)
                if (node < 0).any() and start == end - 1:
                    raise ValueError("the vocabulary lacks a byte")
                rows, node = rows[node >= 0], node[node >= 0]
                token = self.ends[node]
                is_token = np.flatnonzero(token >= 0)
                if start:
                    is_token = is_token[self._apart(last[rows[is_token], start], token[is_token])]
                done = rows[is_token]
                last[done, end], count[done, end] = token[is_token], count[done, start] + 1
                on = np.ones(len(rows), dtype=bool)
                on[is_token] = False
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
        # a character ends where the piece does or another byte than one of its own follows
        is_end = np.arange(1, width + 1) <= sizes[:, None]
        is_end[:, :-1] &= (letters[:, 1:] & 0xC0 != 0x80) | (np.arange(1, width) == sizes[:, None])
        found = count[:, 1:][is_end]
        ends = np.cumsum(is_end.sum(axis=1))
        steps = np.diff(found, prepend=0)
        steps[ends[:-1]] = found[ends[:-1]]
        stored, start = steps.astype("<i2").tobytes(), 0
        for (_, piece), end in zip(both, (2 * ends).tolist()):
            self.pieces[piece] = stored[start:end]
            start = end

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Changes of the number of tokens at each character of these pieces."""
        if len(self.pieces) + len(pieces) > CACHE_PIECES:
            self.pieces.clear()
        new = [p for p in pieces if p not in self.pieces]
        short = [p for p in new if len(p.encode()) <= LONG_PIECE]
        if short:
            self._programs(short)
        for p in pieces.intersection(SHORTENED):  # cut inside, "'l" is two pieces
            whole = int(np.frombuffer(self.pieces[p], dtype="<i2").sum())
            self.pieces[p] = np.array([1, 1, whole - 2], dtype="<i2").tobytes()
        long = {p: self._program(p) for p in new if p not in self.pieces}
        return {**self.pieces, **long} if long else self.pieces

    def _joins(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.joined.get(key)
        if known is None:
            if len(self.joined) >= CACHE_PAIRS:
                self.joined.clear()
            known = self.joined[key] = not self._clash(a, b, len(self.merges))
        return known

    def _program(self, piece: str) -> bytes:
        data = piece.encode()
        n, tokens, tails, joins = len(data), self.tokens, self.tails, self._joins
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            start = end
            while start:
                start -= 1
                part = data[start:end]
                if part not in tails:
                    raise ValueError("the vocabulary lacks a byte")
                token = tokens.get(part)
                if token is not None and (not start or joins(last[start], token)):
                    last[end], count[end] = token, count[start] + 1
                    break
        if n == len(piece):
            found = np.array(count)
        else:
            first = np.frombuffer(data + b"a", dtype=np.uint8) & 0xC0 != 0x80
            found = np.array(count)[first]
        return np.diff(found).astype("<i2").tobytes()

    def _segments(self, texts: list[str]) -> list[np.ndarray]:
        """Changes at each character of texts without special tokens."""
        cuts = [self.cut.findall(t) for t in texts]
        # white space at the end of a text is one piece; before a word, its last character is not
        blanks = [[(m.group(), m.end()) for m in self.blank.finditer(t)] for t in texts]
        wanted = {p for c in cuts for p in c}
        wanted |= {p for b in blanks for run, _ in b for p in (run, run[:-1], run[-1])}
        steps = self._learn(wanted)
        total = {run: sum(sign * int(np.frombuffer(steps[p], dtype="<i2").sum()) for sign, p in ((1, run), (-1, run[:-1]), (-1, run[-1]))) for b in blanks for run, _ in b}
        out = []
        for pieces, runs in zip(cuts, blanks):
            found = np.frombuffer(b"".join(map(steps.__getitem__, pieces)), dtype="<i2")
            more = [(total[run], end) for run, end in runs if total[run]]
            if more:
                found = found.copy()
                for change, end in more:
                    found[end - 1] += change
                    found[end] -= change
            out.append(found)
        return out

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the change of the number of tokens from each prefix to the next."""
        special = [list(self.special.finditer(t)) if self.special else [] for t in texts]
        parts = []
        for text, found in zip(texts, special):
            at = 0
            for m in found:
                parts.append(text[at : m.end() - 1])  # all but a special token's last character is ordinary text
                at = m.end()
            parts.append(text[at:])
        made = iter(self._segments(parts))
        out = []
        for found in special:
            own, at = [], 0
            for m in found:
                ordinary = next(made)
                own += [ordinary, np.array([1 - int(ordinary[m.start() - at :].sum())], dtype="<i2")]
                at = m.end()
            own.append(next(made))
            out.append(np.concatenate(own) if found else own[0])
        return out


_counters: dict[str, PrefixCounter] = {}


def _counter(spec: str) -> PrefixCounter:
    """One counter per worker and tokenizer."""
    if spec not in _counters:
        _counters.clear()
        _counters[spec] = PrefixCounter(spec)
    return _counters[spec]


def prefix_counts(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``steps`` (16-bit changes, little endian).

    ``tokenizer`` is the path of a tokenizer's JSON file, read on the driver and sent to
    the tasks once (its size is the vocabulary's).
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    new = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("steps", BinaryType())]
    names = [f.name for f in new]
    kept = [c for c in docs.columns if c not in names or c == text]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    if text in names:
        raise ValueError(f"the text column cannot be one of {names}")
    schema = StructType([*rows.schema.fields, *new])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(spec.value)

        for batch in batches:
            texts = [value.as_py() or "" for value in batch.column(at)]
            first = 0
            while first < len(texts):
                last, held = first, 0
                while last < len(texts) and (last == first or held + len(texts[last]) <= OUT_CHARS):
                    held += len(texts[last])
                    last += 1
                steps = counter.steps(texts[first:last])
                sizes = pa.array([len(t.encode()) for t in texts[first:last]], type=pa.int64())
                tokens = pa.array([int(s.sum(dtype=np.int64)) for s in steps], type=pa.int64())
                stored = pa.array([s.tobytes() for s in steps], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns, sizes, tokens, stored], names=[*kept, *names])
                first = last

    return rows.mapInArrow(run, schema)


def tokens_of_prefix(chars: Column | str, steps: Column | str = "steps") -> Column:
    """Tokens of the first ``chars`` characters; all of them where a text is shorter, null for a null."""

    @F.pandas_udf("long")
    def ask(kept, chars):
        import pandas as pd

        found = [None if s is None or c is None or c != c else int(np.frombuffer(s, dtype="<i2")[: max(int(c), 0)].sum(dtype=np.int64)) for s, c in zip(kept, chars)]
        return pd.Series(found, dtype="Int64")

    return ask(steps, chars)


def chars_within(budget: Column | str, steps: Column | str = "steps") -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens, null for a null.

    The number of tokens can fall as a prefix grows, so the longest is meant, not the
    last one before the budget is first passed.
    """

    @F.pandas_udf("long")
    def ask(kept, budget):
        import pandas as pd

        def longest(s: bytes, b: int) -> int:
            fits = np.flatnonzero(np.cumsum(np.frombuffer(s, dtype="<i2"), dtype=np.int64) <= b)
            return int(fits[-1]) + 1 if len(fits) and b >= 0 else 0

        return pd.Series([None if s is None or b is None or b != b else longest(s, int(b)) for s, b in zip(kept, budget)], dtype="Int64")

    return ask(steps, budget)
