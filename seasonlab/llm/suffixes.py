"""Removing byte strings that occur more than once, by names of sampled suffixes.

As in a difference-cover suffix array, a sample of positions is chosen such that any two
equal strings of ``LENGTH`` bytes hold a sampled position at the same offset. A cover by
residues names two thirds of all bytes; here the position with the least hash of its
next ``GRAM`` bytes among any ``REACH`` neighbours is sampled, one in about a hundred,
with the same guarantee because the choice depends on these bytes alone.

1. Sampled suffixes are named by triples of stretches, dealt by name and sorted, so that
   equal ones meet. A suffix whose name occurs once cannot begin a repeat.
2. The names recurse once, to the whole context of a sampled position: equal contexts
   settle all the suffixes between this position and the sampled one before at once.
3. Where contexts differ, the suffixes between two sampled positions are merged in: each
   is named by its first ``LENGTH`` bytes, sorted, and compared with its neighbours.

Deeper recursion isn't needed, as prefixes of ``LENGTH`` bytes decide. Names are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlab.llm.common import stored
from seasonlab.llm.textbytes import Hashes, Slice, mixed, slices

LENGTH = 400
REACH = 200  # positions among which one is sampled
GRAM = 16
STEP = 32  # suffixes that are dealt together
ENTRIES_A_TASK = 4_000_000

# What an entry says beside its place: its context is known to occur again; its name is
# known to occur with other contexts, in so many that it is dealt by single suffixes.
AGAIN, MANY = 1, 2

FOUND, ASKED, ASKED_AGAIN = 1, 2, 3


def least_within(h: np.ndarray, reach: int) -> np.ndarray:
    """Place of the least value, the first of equals, among each ``reach`` neighbours."""
    bits = max(1, int(len(h)).bit_length())
    low = np.uint64((1 << bits) - 1)
    v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    if width < reach:
        v = np.minimum(v[: len(v) - (reach - width)], v[reach - width :])
    return (v & low).astype(np.int64)


def sampled(part: Slice, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """All sampled suffixes of a slice that begin or lie in a string of ``length`` bytes:
    text, name, context, first suffix, sampled place less first suffix, suffixes.

    The suffixes that share a sampled position follow each other; their places are
    counted from the start of their text.
    """
    sizes = np.diff(part.at)
    count = np.maximum(0, sizes - length + 1)
    if not count.sum():
        none = np.zeros(0, dtype=np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none
    text = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + part.at[:-1][text]
    hashes = Hashes(part.data)
    grams = np.arange(len(part.data) - GRAM + 1)
    place = least_within(hashes.of(grams, grams + GRAM), reach)[at]
    start = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    n = np.diff(np.append(start, len(at)))
    first, place, text = at[start], place[start], text[start]
    third = (length - reach + 1) // 3
    cuts = [place, place + third, place + 2 * third, place + length - reach + 1]
    name = np.zeros(len(place), dtype=np.uint64)
    for k in range(3):
        name += hashes.of(cuts[k], cuts[k + 1]) * np.uint64(pow(0xD1342543DE82EF95, k + 1, 2**64))
    context = hashes.of(first, first + n - 1 + length)
    context = mixed(context + ((place - first) * 1024 + n).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    return text, mixed(name), context, first - part.at[text], place - first, n


def _place(first: np.ndarray, ahead: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (first << 24) | (ahead << 14) | (n << 4)


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 24, (place >> 14) & 1023, (place >> 4) & 1023


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Whether a sorted row is the first with its keys."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _counts(new: np.ndarray) -> np.ndarray:
    """Size of each row's run."""
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(new)))
    return np.repeat(size, size)


def _any(flag: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Whether any row of each row's run has the flag."""
    run = np.cumsum(new) - 1
    return np.bincount(run, flag, minlength=1)[run] > 0 if len(run) else flag


def combine(name: np.ndarray, context: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Settle in the map task what it can, so that no name brings more than one row per batch.

    Returns results (key, place, name, kind) and entries (name, context, key, place) for others.
    """
    order = np.lexsort((context, name))
    name, context, key, place = name[order], context[order], key[order], place[order]
    new_context, new_name = _starts(name, context), _starts(name)
    again = _counts(new_context) > 1
    found = np.stack([key, place, name.view(np.int64), np.full(len(key), FOUND)], axis=1)[again]
    place = place | np.where(again, AGAIN, 0)
    name, context, key, place, new_name = (c[new_context] for c in (name, context, key, place, new_name))
    new_name = _starts(name)
    many = _counts(new_name) > 1
    asked = np.stack([key, place | MANY, name.view(np.int64), np.where(place & AGAIN, ASKED_AGAIN, ASKED)], axis=1)[many]
    place = place | np.where(many, MANY, 0)
    sent = np.stack([name.view(np.int64), context.view(np.int64), key, place], axis=1)[new_name]
    return np.concatenate([found, asked]), sent


def meet(table: np.ndarray) -> np.ndarray:
    """Results (key, place, name, kind) of all entries of some names.

    A context that occurs again settles its suffixes. Each context of a name with several
    asks for its suffixes to be compared, once, also where it is settled itself.
    """
    name, context, key, place = table[np.lexsort((table[:, 1], table[:, 0]))].T
    new_name, new_context = _starts(name), _starts(name, context)
    again = (_counts(new_context) > 1) | _any((place & AGAIN) > 0, new_context)
    found = again & ((place & AGAIN) == 0)
    told = _any((place & MANY) > 0, new_name)
    contexts = np.bincount(np.cumsum(new_name) - 1, new_context, minlength=1)[np.cumsum(new_name) - 1] if len(name) else name
    ask = new_context & ((place & MANY) == 0) & (told | (contexts > 1))
    place = (place & ~MANY) | np.where(told, MANY, 0)
    results = [np.stack([key, place, name, np.full(len(key), FOUND)], axis=1)[found]]
    results.append(np.stack([key, place, name, np.where(again, ASKED_AGAIN, ASKED)], axis=1)[ask])
    return np.concatenate(results)


def _packed(kind: int, block: np.ndarray, table: np.ndarray):
    import pyarrow as pa

    order = np.argsort(block, kind="stable")
    block, table = block[order], np.ascontiguousarray(table[order])
    start = np.flatnonzero(_starts(block)) if len(block) else np.zeros(0, dtype=int)
    ends = np.append(start[1:], len(block))
    cells = [table[a:b].tobytes() for a, b in zip(start, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(cells), kind, dtype=np.int32)), pa.array(block[start].astype(np.int32)), pa.array(cells, type=pa.binary())],
        names=["kind", "block", "entries"],
    )


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    """The task that each hash is dealt to."""
    return (mixed(h.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _tasks(spark: SparkSession, entries: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // ENTRIES_A_TASK))


def settled_or_asked(texts: DataFrame, tasks: int, length: int, reach: int) -> DataFrame:
    """(key, place, name, kind) for all sampled suffixes whose name occurs again."""

    def deal(batches):
        for batch in batches:
            keys, parts = batch.column(0).to_numpy(), []
            for part in slices(batch.column(1)):
                text, name, context, first, ahead, n = sampled(part, length, reach)
                parts.append((name, context, keys[part.first + text], _place(first, ahead, n)))
            done, sent = combine(*(np.concatenate(c) for c in zip(*parts)))
            yield _packed(1, _block(done[:, 0].copy(), tasks), done)
            yield _packed(0, _block(sent[:, 0].copy(), tasks), sent)

    def gather(batches):
        import pyarrow as pa

        cells: dict[int, list[np.ndarray]] = {0: [np.zeros((0, 4), dtype=np.int64)], 1: [np.zeros((0, 4), dtype=np.int64)]}
        for batch in batches:
            for kind, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                cells[kind].append(np.frombuffer(b, dtype=np.int64).reshape(-1, 4))
        out = np.concatenate([*cells[1], meet(np.concatenate(cells[0]))])
        yield pa.RecordBatch.from_arrays([pa.array(out[:, k].copy()) for k in range(4)], names=["key", "place", "name", "kind"])

    dealt = texts.mapInArrow(deal, "kind int, block int, entries binary").repartitionById(tasks, "block")
    return dealt.mapInArrow(gather, "key long, place long, name long, kind long")


def compared(texts: DataFrame, asked: DataFrame, tasks: int, length: int) -> DataFrame:
    """(key, place) of runs of suffixes, among those asked for, whose prefix occurs again.

    Suffixes of a name are dealt by name and offset from the sampled place, in steps;
    where a name has many contexts, by the prefix itself, so that none gathers in a task.
    """

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            heads, blocks, prefixes = [], [], []
            keys, lists = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for part in slices(batch.column(1)):
                hashes = Hashes(part.data)
                for t in range(part.last - part.first):
                    rows = lists[part.first + t]
                    place = np.array([r["place"] for r in rows], dtype=np.int64)
                    name = np.array([r["name"] for r in rows], dtype=np.int64)
                    open_ = np.array([r["kind"] == ASKED for r in rows])
                    first, ahead, n = _unpack(place)
                    which = np.repeat(np.arange(len(n)), n)
                    p = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[which]
                    at = p + part.at[t]
                    prefix = hashes.of(at, at + length)
                    single = (place[which] & MANY) > 0
                    step = (first[which] + ahead[which] - p) // STEP
                    dealt = np.where(single, prefix.view(np.int64), name[which] ^ (step * 0x5851F42D4C957F2D % 2**31))
                    new = _starts(which, step) | single
                    start = np.flatnonzero(new)
                    size = np.diff(np.append(start, len(which)))
                    heads.append(np.stack([np.full(len(start), keys[part.first + t]), p[start], size * 2 + open_[which[start]]], axis=1))
                    blocks.append(_block(dealt[start].copy(), tasks))
                    prefixes.append(prefix)
            if not heads:
                continue
            head, block, prefix = np.concatenate(heads), np.concatenate(blocks), np.concatenate(prefixes)
            size = head[:, 2] >> 1
            begin = np.cumsum(size) - size
            order = np.argsort(block, kind="stable")
            cut = np.flatnonzero(_starts(block[order]))
            names, h, s = [], [], []
            for a, b in zip(cut, np.append(cut[1:], len(order))):
                own = order[a:b]
                inside = np.repeat(begin[own] - np.cumsum(size[own]) + size[own], size[own]) + np.arange(size[own].sum())
                names.append(int(block[own[0]]))
                h.append(head[own].tobytes())
                s.append(prefix[inside].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, type=pa.int32()), pa.array(h, type=pa.binary()), pa.array(s, type=pa.binary())], names=["block", "heads", "prefixes"]
            )

    def compare(batches):
        import pyarrow as pa

        heads, prefixes = [np.zeros((0, 3), dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for batch in batches:
            heads += [np.frombuffer(b, dtype=np.int64).reshape(-1, 3) for b in batch.column(1).to_pylist()]
            prefixes += [np.frombuffer(b, dtype=np.uint64) for b in batch.column(2).to_pylist()]
        head, prefix = np.concatenate(heads), np.concatenate(prefixes)
        size = head[:, 2] >> 1
        which = np.repeat(np.arange(len(size)), size)
        p = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + head[which, 1]
        order = np.argsort(prefix, kind="stable")
        again = np.zeros(len(prefix), dtype=bool)
        same = prefix[order[1:]] == prefix[order[:-1]]
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        again &= (head[which, 2] & 1) > 0
        which, p = which[again], p[again]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (which[1:] != which[:-1]) | (p[1:] != p[:-1] + 1)
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(p)))
        place = _place(p[start], np.zeros(len(start), dtype=np.int64), n)
        yield pa.RecordBatch.from_arrays([pa.array(head[which[start], 0]), pa.array(place)], names=["key", "place"])

    lists = asked.groupBy("key").agg(F.collect_list(F.struct("place", "name", "kind")).alias("asked"))
    rows = texts.join(lists, "key").select("key", "text", "asked")
    dealt = rows.mapInArrow(deal, "block int, heads binary, prefixes binary").repartitionById(tasks, "block")
    return dealt.mapInArrow(compare, "key long, place long")


def repeats(texts: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """(key, place): runs of suffixes whose first ``length`` bytes also start elsewhere.

    ``texts`` has key, a 64-bit hash of the row, and text. Rows with the same key are alike.
    """
    spark = texts.sparkSession
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = _tasks(spark, 2 * size // reach)
    named = stored(settled_or_asked(texts, tasks, length, reach), "named-suffixes")
    asked = named.where(F.col("kind") != FOUND).drop_duplicates()
    more = compared(texts, asked, tasks, length)
    return named.where(F.col("kind") == FOUND).select("key", "place").unionByName(stored(more, "compared-suffixes"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start and end of each removed run, in
    order), kept (the remaining bytes).

    Every byte is removed that a string of ``length`` bytes covers which also starts
    anywhere else, the same text included. Texts are UTF-8 bytes, a null is empty, and
    rows that are equal in id and text are occurrences of their own.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = named.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    found = repeats(keyed.select("key", "text"), length)
    lists = found.groupBy("key").agg(F.collect_set("place").alias("places"))  # equal rows tell the same places

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            places, sizes, spans, kept = batch.column(2), [], [], []
            for part in slices(batch.column(1)):
                for t in range(part.last - part.first):
                    data = part.data[part.at[t] : part.at[t + 1]]
                    runs = np.zeros((0, 2), dtype=np.int64)
                    cell = places[part.first + t]
                    if cell.is_valid:
                        first, _, n = _unpack(np.unique(cell.values.to_numpy()))
                        last = np.maximum.accumulate(first + n - 1 + length)
                        new = np.concatenate([[True], first[1:] > last[:-1]])
                        start = np.flatnonzero(new)
                        runs = np.stack([first[start], last[np.append(start[1:], len(first)) - 1]], axis=1)
                    left = np.concatenate([[0], runs[:, 1]]), np.append(runs[:, 0], len(data))
                    sizes.append(len(data))
                    spans.append([{"start": a, "end": b} for a, b in runs.tolist()])
                    kept.append(b"".join(data[a:b].tobytes() for a, b in zip(*left)))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(spans, type=span), pa.array(kept, type=pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    rows = keyed.join(lists, "key", "left").select("doc_id", "text", "places")
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
