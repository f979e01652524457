"""Runs: stretches of words that repeat with a period, found by seeds on diagonals.

A run of length L with smallest period q matches itself q words on over L - q words. With
L >= max(least, 2 q), those are at least max(least - q, q) words, so two occurrences of
one k-gram, q apart, lie in every run, for any k up to that. Lags are taken in classes
[k, 2k), each with k-grams of the length that the class guarantees: k words, ``least / 2``
in the first class (which also holds the smaller lags). Every class indexes the k-grams
of all documents of a slice, names of longer grams being pairs of names of shorter ones;
a gram that occurs once in its document is not carried on.

Occurrences at most k/2 apart form a chain: they lie in one run of a small period, and a
pair inside two chains matches only as far as the ends of the chains do. So a pair
(i, i + lag) is a seed only if i or i + lag is the first of its chain, and the two are not
of one chain (but for lags of up to half a gram). A gram with no small period has chains of one, and at most two partners in a class; a chain of m gives
m pairs, not m * m. No run is lost: on its diagonal, a run's matching stretch holds a
gram that is alone in its chain, or starts where the run of the small period around it
starts, on one of the two sides.

Seeds are extended over names of grams, longest first, so that a stretch of any length
takes a few steps. Seeds of one lag are taken in order: the furthest word that the lag
has covered so far tells which of them lie in a stretch that is known already. Stretches
that are long enough are runs, unless a smaller period covers the same words. Work and
memory grow as n log n with the words of a text, whatever they repeat.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as bytes; nothing is hashed. Null and empty
texts have no words and no runs. Ids are not read. Extra columns stay as they are; input
columns with the names of new ones are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

SLICE_WORDS = 1 << 18  # words worked on together; a longer text is a slice of its own

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., then first[1], ..., ``sizes`` of each."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both columns are."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def _repeated(at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose name occurs more than once."""
    often = np.bincount(name)[name] > 1 if len(name) else np.zeros(0, dtype=bool)
    return at[often], name[often]


def _joined(at: np.ndarray, name: np.ndarray, step: int, other_at: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams that end in a gram of ``other``, ``step`` words on; both lists are in order of place."""
    if not len(at) or not len(other_at):
        return at[:0], name[:0]
    found = np.minimum(np.searchsorted(other_at, at + step), len(other_at) - 1)
    there = other_at[found] == at + step
    at, left, right = at[there], name[there], other[found[there]]
    return _repeated(at, _names(left, right))


def _grams(size: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the repeated grams of ``size`` words."""
    whole = parts = _repeated(np.arange(len(words)), _names(words, words * 0))
    have = 1
    for bit in f"{size:b}"[1:]:
        whole, have = _joined(*whole, have, *whole), 2 * have
        if bit == "1":
            whole, have = _joined(*whole, have, *parts), have + 1
    return whole


def _seeds(at: np.ndarray, name: np.ndarray, low: int, high: int, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of occurrences of a gram with a lag in [low, high), one of which is the first
    of its chain of occurrences at most ``near`` apart."""
    order = np.argsort(name, kind="stable")
    at, name = at[order], name[order]
    key = name * (int(at.max(initial=0)) + high + 1) + at  # no lag leads from one name to another
    is_head = np.diff(key, prepend=-near - 1) > near
    heads, chain = np.flatnonzero(is_head), np.cumsum(is_head)
    pairs = []
    for ahead in (True, False):
        bounds = (low, high) if ahead else (1 - high, 1 - low)
        first, last = (np.searchsorted(key, key[heads] + b) for b in bounds)
        one, two = np.repeat(at[heads], last - first), at[_spread(first, last - first)]
        own = near < abs(two - one)  # in one chain, such a pair only tells its small period again
        own &= np.repeat(chain[heads], last - first) == chain[_spread(first, last - first)]
        pairs.append((one[~own], two[~own]) if ahead else (two[~own], one[~own]))
    left, right = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    return left, right - left


def _matching(tables: list[tuple[int, np.ndarray]], at: np.ndarray, lag: np.ndarray, back: bool) -> np.ndarray:
    """The place up to which words match those a lag later, from ``at`` on or back from it.

    ``tables`` has names of grams by size, falling; each is tried once, the words at last
    as often as the least gram is long.
    """
    n = len(tables[-1][1])
    at = at.copy()
    least = tables[-2][0] if len(tables) > 1 else 2
    for size, names in [*tables[:-1], *[tables[-1]] * (least - 1)]:
        probe = at - size if back else at
        inside = np.flatnonzero((probe >= 0) & (probe + lag < n))
        name = names[probe[inside]]
        on = inside[(name >= 0) & (name == names[probe[inside] + lag[inside]])]
        at[on] += -size if back else size
    return at


def _stretches(tables: list[tuple[int, np.ndarray]], at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, lag) of the matching stretches that hold the seeds, each once."""
    span = len(tables[-1][1]) + 1
    key = np.unique(lag * span + at)  # by lag, then place
    at, lag = key % span, key // span
    new = np.diff(key, prepend=-1) > 1  # seeds one after the other match as one
    at, lag = at[new], lag[new]
    last = _matching(tables, at, lag, back=False)
    covered = np.zeros(len(at), dtype=bool)  # by the stretch of the seed before
    covered[1:] = (lag[1:] == lag[:-1]) & (at[1:] < last[:-1])
    at, last, lag = at[~covered], last[~covered], lag[~covered]
    return _matching(tables, at, lag, back=True), last, lag


def runs_of(words: np.ndarray, starts: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, by document, start and period.

    ``words`` are numbers, equal where words are; document d has those from ``starts[d]``
    to ``starts[d + 1]``. A run has ``least`` words and two periods at least.
    """
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    words = _names(doc, words)  # words of different documents differ, so no gram lies in two
    tables, seeds = [(1, words)], []
    low, size = 1, (least + 1) // 2
    at, name = _grams(size, words)
    while len(at):
        if size > 1:
            names = np.full(len(words), -1, dtype=np.int32)
            names[at] = name
            tables.insert(0, (size, names))
        seeds.append(_seeds(at, name, low, 2 * size, size // 2))
        at, name = _joined(at, name, size, at, name)
        low, size = 2 * size, 2 * size
    if not seeds:
        return np.zeros((0, 4), dtype=np.int64)
    first, last, lag = _stretches(tables, *(np.concatenate([s[k] for s in seeds]) for k in (0, 1)))
    long = last - first + lag >= np.maximum(least, 2 * lag)
    first, last, lag = first[long], last[long] + lag[long], lag[long]
    order = np.lexsort((lag, last, first))
    first, last, lag = first[order], last[order], lag[order]
    smallest = np.ones(len(first), dtype=bool)  # of the periods of the same words
    smallest[1:] = (np.diff(first) != 0) | (np.diff(last) != 0)
    first, last, lag = first[smallest], last[smallest], lag[smallest]
    runs = np.stack([doc[first], first - starts[doc[first]], last - first, lag], axis=1)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, and where each text starts."""
    starts = np.cumsum([0, *map(len, texts)])
    table: dict[bytes, int] = {}
    fresh = count()
    words = np.fromiter((table.setdefault(w, n) for t in texts for w, n in zip(t, fresh)), np.int64, int(starts[-1]))
    return words, starts


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 12) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period, by start and period) and
    ``collapsed`` (the words outside runs and in the first period of all runs that hold
    them, joined by one space)."""
    if least < 2:
        raise ValueError("a run needs two words at least")
    new = [StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]
    kept = [c for c in docs.columns if c not in ("runs", "collapsed")]
    if text not in kept:
        raise ValueError(f"the text column cannot be {text}")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text)

    def part(batch: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        words, starts = _numbered(texts)
        runs = runs_of(words, starts, least)
        # words that a run drops: those after its first period
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, starts[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
        np.add.at(change, starts[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
        stays = np.cumsum(change[:-1]) == 0
        bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
        cells = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(to_arrow_schema(RUN)))
        listed = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), cells)
        left = []
        for k, own in enumerate(texts):
            if bounds[k] < bounds[k + 1]:
                own = [own[i] for i in np.flatnonzero(stays[starts[k] : starts[k + 1]])]
            left.append(b" ".join(own).decode())
        columns = [*batch.columns, listed.cast(to_arrow_schema(StructType(new)).field(0).type), pa.array(left, type=pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*kept, "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, texts, held = 0, [], 0
            for value in batch.column(at):
                words = (value.as_py() or "").encode().split()  # at bytes 0x20 and 0x09-0x0D
                if texts and held + len(words) > SLICE_WORDS:
                    yield part(batch.slice(first, len(texts)), texts)
                    first, texts, held = first + len(texts), [], 0
                texts.append(words)
                held += len(words)
            if texts:
                yield part(batch.slice(first, len(texts)), texts)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *new]))
