"""Removing documents that hold passages of a benchmark, by suffix arrays of the documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField

from seasonlab.llm.common import free_name
from seasonlab.llm.textbytes import LETTERS, LOWER, Slice, append_columns, slices, word_hashes

WINDOW = 10
BLOCK_WORDS = 2_000_000  # of the benchmark that are held at once


class TestSuffixes:
    """A block of the benchmark: its words numbered, and every suffix cut to a window.

    An item of fewer words than a window is one window. Equal windows are kept once,
    with all items they occur in.
    """

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        words = np.concatenate([w for _, w in items]) if items else np.zeros(0, dtype=np.uint64)
        self.vocabulary = np.unique(words)
        rows, owners = [], []
        for item, own in items:
            ids = np.searchsorted(self.vocabulary, own) + 1
            for at in range(max(1, len(ids) - window + 1)):
                row = np.zeros(window, dtype=">u4")
                row[: min(window, len(ids))] = ids[at : at + window]
                rows.append(row)
                owners.append(item)
        keys = np.array(rows, dtype=">u4").reshape(-1, window)
        self.keys, which = np.unique(keys, axis=0, return_inverse=True)
        self.lengths = (self.keys > 0).sum(axis=1)
        self.items: list[list[str]] = [[] for _ in self.keys]
        for k, item in zip(which.ravel(), owners):
            if item not in self.items[k]:
                self.items[k].append(item)
        base = len(self.vocabulary) + 2
        second = np.where(self.lengths > 1, self.keys[:, 1] if window > 1 else 0, 0)
        self.base, self.heads = base, np.unique(self.keys[:, 0].astype(np.int64) * base + second)
        self.singles = np.unique(self.keys[self.lengths == 1, 0].astype(np.int64))

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the benchmark's vocabulary, 0 if it is not there."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def suffix_array(ids: np.ndarray, ends: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of a shard's words: their first ``window`` words and positions.

    ``ids`` numbers the words, ``ends`` has the end of each word's text. Only suffixes
    that begin like some test suffix are sorted: no other can match a window.
    """
    n = len(ids)
    follow = np.zeros(n, dtype=np.int64)
    follow[:-1] = ids[1:]
    follow[np.arange(1, n + 1) >= ends] = 0
    begins = (ids > 0) & (_member(ids * tests.base + follow, tests.heads) | _member(ids, tests.singles))
    at = np.flatnonzero(begins)
    rows = np.zeros((len(at), tests.window), dtype=">u4")
    for k in range(tests.window):
        inside = at + k < ends[at]
        rows[inside, k] = ids[at[inside] + k]
    keys = rows.view(f"S{4 * tests.window}").ravel()
    order = np.argsort(keys, kind="stable")
    return keys[order], at[order]


def occurrences(tests: TestSuffixes, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (window, position) where a window occurs verbatim, by binary search."""
    size = 4 * tests.window
    low = tests.keys.view(f"S{size}").ravel()
    above = np.where(tests.keys > 0, tests.keys, 0xFFFFFFFF).astype(">u4").view(f"S{size}").ravel()
    left = np.searchsorted(keys, low, side="left")
    right = np.searchsorted(keys, above, side="right")
    count = right - left
    which = np.repeat(np.arange(len(count)), count)
    starts = np.repeat(left - np.concatenate([[0], np.cumsum(count)[:-1]]), count) if len(count) else left
    return which, at[starts + np.arange(len(which))]


def _search(part: Slice, tests: TestSuffixes):
    """Words of a slice (text of each, end of each one's text) and the windows found in it."""
    lowered = Slice(part.first, part.last, LOWER[part.data], part.at)
    s, e, text = lowered.words(LETTERS)
    per_text = np.bincount(text, minlength=part.last - part.first)
    stops = np.cumsum(per_text)
    ids = tests.numbered(word_hashes(lowered.data, s, e))
    keys, at = suffix_array(ids, stops[text], tests)
    which, where = occurrences(tests, keys, at)
    return text, per_text, stops, which, where


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[TestSuffixes]:
    """The benchmark in blocks of bounded size, read item by item."""
    held, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    for item, text in rows.toLocalIterator():
        data = LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]
        part = Slice(0, 1, data, np.array([0, len(data)]))
        s, e, _ = part.words(LETTERS)
        if item is None or not len(s):
            continue
        if held and size + len(s) > BLOCK_WORDS:
            yield TestSuffixes(held, window)
            held, size = [], 0
        held.append((item, word_hashes(data, s, e)))
        size += len(s)
    yield TestSuffixes(held, window)


def matched(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, str, str, str]:
    """Rows with three more columns, and their names: number of words, a bit per word
    that lies in an occurrence of a window, and the items with occurring windows.

    The texts of a batch are a shard. For each block of the benchmark the shard's
    suffix array is built and every test suffix looked up in it; blocks follow each
    other in the same stage, nothing is shuffled, and no more than a block
    (``BLOCK_WORDS`` words) is sent to the tasks at once.
    """
    spark = docs.sparkSession
    count, bits, found = (free_name(docs, n) for n in ("n_words", "hit_words", "hit_items"))
    out = docs
    for k, block in enumerate(_blocks(benchmark, item_col, item_text, window)):
        sent = spark.sparkContext.broadcast(block)

        def work(parts: Iterable[Slice], sent=sent) -> Iterator[list]:
            tests = sent.value
            for part in parts:
                text, per_text, stops, which, where = _search(part, tests)
                covered = np.zeros(len(text) + 1, dtype=np.int64)
                np.add.at(covered, where, 1)
                np.add.at(covered, where + tests.lengths[which], -1)
                hit = np.cumsum(covered)[:-1] > 0
                items: list[set] = [set() for _ in per_text]
                pairs = np.unique(np.stack([text[where], which]), axis=1) if len(where) else np.zeros((2, 0), dtype=int)
                for t, w in pairs.T:
                    items[t].update(tests.items[w])
                begin = stops - per_text
                has = np.add.reduceat(np.append(hit, False), np.minimum(begin, len(hit))) if len(per_text) else []
                packed = [np.packbits(hit[a:b]).tobytes() if n and a < b else b"" for a, b, n in zip(begin, stops, has)]
                yield [per_text.tolist(), packed, [sorted(x) for x in items]]

        names = (count, bits, found) if k == 0 else tuple(free_name(out, f"{n}_{k}") for n in (count, bits, found))
        fields = [StructField(names[0], LongType()), StructField(names[1], BinaryType()), StructField(names[2], ArrayType(StringType()))]
        out = append_columns(out, text_col, fields, work)
        if k:
            later = [names[1], names[2]]
            out = out.withColumn(found, F.array_union(found, later[1]))
            out = out.withColumn(bits, _either(bits, later[0])).drop(*names)
    return out, count, bits, found


def _either(a: str, b: str) -> Column:
    @F.udf("binary")
    def both(x, y):
        if not x or not y:
            return bytes(x or y)
        return (np.frombuffer(x, np.uint8) | np.frombuffer(y, np.uint8)).tobytes()

    return both(a, b)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or wordless text has no words and is clean; items without words or without an
    id match nothing; repeated items count once. Words are compared by 64-bit hashes.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out, count, bits, found = matched(named, benchmark, "text", window=window)
    ones = _ones(bits)
    return out.select(
        "doc_id",
        F.col(count).alias("n_words"),
        ones.alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(found), ","), 256).alias("items_sha256"),
        (F.size(found) > 0).alias("contaminated"),
    )


def _ones(bits: str) -> Column:
    """Set bits of a binary column: its hexadecimal digits, counted by their bits."""
    digits = F.hex(bits)
    total = F.lit(0)
    for wanted, group in ((1, "1248"), (2, "3569AC"), (3, "7BDE"), (4, "F")):
        total = total + wanted * F.length(F.regexp_replace(digits, f"[^{group}]", ""))
    return total.cast("long")


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Longest verbatim matches and where they are: doc_id, doc_word, item_id, n_words.

    Occurrences of windows of one item that follow each other in a document are one match.
    """
    schema = "doc_id long, doc_word long, item_id string, n_words long"
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = []
    for block in _blocks(benchmark, "item_id", "text", window):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            import pyarrow as pa

            tests = sent.value
            for batch in batches:
                rows = []
                ids = batch.column(0).to_pylist()
                for part in slices(batch.column(1)):
                    text, per_text, stops, which, where = _search(part, tests)
                    spans: dict[tuple[int, str], list] = {}
                    for at, w in sorted(zip(where.tolist(), which.tolist())):
                        for item in tests.items[w]:
                            own = spans.setdefault((int(text[at]), item), [])
                            end = at + int(tests.lengths[w])
                            if own and at <= own[-1][1] - tests.window + 1:
                                own[-1][1] = max(own[-1][1], end)
                            else:
                                own.append([at, end])
                    for (t, item), own in spans.items():
                        begin = int(stops[t] - per_text[t])
                        rows += [(ids[part.first + t], a - begin, item, b - a) for a, b in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], type=kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                    names=["doc_id", "doc_word", "item_id", "n_words"],
                )

        parts.append(named.mapInArrow(run, schema))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows, all columns, whose text holds no window of the benchmark."""
    out, count, bits, found = matched(docs, benchmark, text_col, window=window)
    return out.where(F.size(found) == 0).drop(count, bits, found)
