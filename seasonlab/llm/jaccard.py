"""Near-duplicate documents: an exact Jaccard join of shingle sets.

The incidence matrix of documents by shingles is multiplied with itself block by block:
columns (shingles) are dealt to blocks, and what a row can still reach there is compared
with the least overlap that its size asks for; rows that cannot reach it are dropped. The
rest is multiplied in tiles of a few hundred rows by a few hundred, whose pairs are
discarded by bounds from the sizes and from bit maps of the sets before overlaps are added up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from seasonlab.llm.common import free_name, stored
from seasonlab.llm.graph import components
from seasonlab.llm.textbytes import LOWER, WHITE, Slice, append_columns, mixed, slices, word_hashes

WORDS = 5
FREQUENT = 65_536  # most shingles that are put last in the order of all sets
TILE = 256  # documents on a side of a tile
BITS = 2_048
ENTRIES_A_TASK = 4_000_000
PACKED = "block int, entries binary"


def enough(overlap, x, y, similarity: int = 80):
    """Whether sets of x and y shingles with so many in common are linked."""
    return 100 * overlap >= similarity * (x + y - overlap)


def sets_of(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of all distinct shingles, sorted by text and shingle.

    Words are runs without white space, A-Z in lower case. A text of one to four words
    is one shingle, a text without words has none. Shingles are 64-bit hashes.
    """
    data = LOWER[part.data]
    s, e, text = Slice(part.first, part.last, data, part.at).words(WHITE)
    words = word_hashes(data, s, e)
    count = np.bincount(text, minlength=part.last - part.first)
    stops = np.cumsum(count)
    total = np.zeros(len(words), dtype=np.uint64)
    at = np.arange(len(words))
    for k in range(WORDS):
        factor = np.uint64(pow(0xD1342543DE82EF95, k + 1, 2**64))
        inside = at + k < stops[text]
        total[inside] += words[at[inside] + k] * factor
    length = np.minimum(count, WORDS)[text]
    starts = (at + WORDS <= stops[text]) | (at == (stops - count)[text])
    shingle = mixed(total + length.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))[starts]
    text = text[starts]
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    return text[new], shingle[new]


def digests_of(text: np.ndarray, shingle: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each set and a 64-bit digest of it; equal sets have equal digests."""
    size = np.bincount(text, minlength=n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    upto = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingle ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
    ends = np.cumsum(size)
    sums = upto[ends] - upto[ends - size]
    return size, mixed(sums + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def with_sets(docs: DataFrame, text_col: str, size: str = "n_shingles", digest: str = "digest") -> DataFrame:
    """Rows with size and digest of their set and, on the first row of each slice of
    texts, the shingles that occur in more than one text of the slice, with counts."""

    def work(parts: Iterable[Slice]) -> Iterator[list]:
        for part in parts:
            text, shingle = sets_of(part)
            n = part.last - part.first
            sizes, keys = digests_of(text, shingle, n)
            found, count = np.unique(shingle, return_counts=True)
            often = count > 1
            counted = np.stack([found[often].view(np.int64), count[often]], axis=1).tobytes()
            yield [sizes.tolist(), keys.tolist(), [counted] + [None] * (n - 1)]

    fields = [StructField(size, LongType()), StructField(digest, LongType()), StructField("often", BinaryType())]
    return append_columns(docs, text_col, fields, work)


def frequent_shingles(rows: DataFrame) -> np.ndarray:
    """Shingles of many texts, at most ``FREQUENT`` of them, sorted.

    They only decide which shingles come first in all sets; any choice gives the same links.
    """

    def unpack(batches):
        import pyarrow as pa

        for batch in batches:
            cells = [np.frombuffer(b, dtype=np.int64).reshape(-1, 2) for b in batch.column(0).to_pylist() if b]
            both = np.concatenate(cells) if cells else np.zeros((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["shingle", "n"])

    counts = rows.where("often IS NOT NULL").select("often").mapInArrow(unpack, "shingle long, n long")
    top = counts.groupBy("shingle").agg(F.sum("n").alias("n")).where("n >= 8").orderBy(F.desc("n"), "shingle").limit(FREQUENT)
    return np.sort(np.array([r.shingle for r in top.collect()], dtype=np.int64).view(np.uint64))


def ordered(shingle: np.ndarray, text: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Order that puts, in each text, frequent shingles last and hashes up."""
    late = np.zeros(len(shingle), dtype=bool)
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, shingle), len(frequent) - 1)] == shingle
    return np.lexsort((shingle, late, text))


def least_shared(n):
    """Shingles that two linked sets share within their first ``n // 5 + least_shared(n)``.

    Linked sets of x >= y shingles share 8/9 of their mean at least, which is 0.8 x or more,
    so each has at most n // 5 that the other lacks; among the first n // 5 + k of both, in
    one order for all sets, k are therefore shared, k being that of the smaller set.
    """
    return n // 10 + 1




def _tasks(spark: SparkSession, entries: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // ENTRIES_A_TASK))


def _block(key: np.ndarray, tasks: int) -> np.ndarray:
    return (mixed(key.view(np.uint64)) % np.uint64(8 * tasks)).astype(np.int64)


def _packed(block: np.ndarray, columns: list[np.ndarray]):
    """Entries as one row per block: its number and the packed columns."""
    import pyarrow as pa

    order = np.argsort(block, kind="stable")
    block = block[order]
    table = np.stack([c[order].view(np.int64) for c in columns], axis=1) if len(block) else np.zeros((0, len(columns)), dtype=np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, dtype=int)
    ends = np.append(cuts[1:], len(block))
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cuts].astype(np.int32)), pa.array([table[a:b].tobytes() for a, b in zip(cuts, ends)], type=pa.binary())],
        names=["block", "entries"],
    )


def _entries(batches, width: int) -> np.ndarray:
    """All entries of a task, sorted by their first column (the shingle)."""
    cells = [np.frombuffer(b, dtype=np.int64).reshape(-1, width) for batch in batches for b in batch.column(1).to_pylist()]
    table = np.concatenate(cells) if cells else np.zeros((0, width), dtype=np.int64)
    return table[np.argsort(table[:, 0], kind="stable")]


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values."""
    if not len(key):
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return start, np.diff(np.append(start, len(key)))


def candidates(docs: DataFrame, text_col: str, frequent: np.ndarray, entries: int) -> DataFrame:
    """Digests of the sets that share enough of their first shingles with others.

    Entries (shingle, digest) of the first shingles are dealt to blocks by shingle and
    packed, so that a task sends a row per block rather than one per entry. A block
    counts, for each set, the shingles that another set has as well.
    """
    spark = docs.sparkSession
    tasks = _tasks(spark, entries)
    sent = spark.sparkContext.broadcast(frequent)

    def deal(batches):
        for batch in batches:
            for part in slices(batch.column(0)):
                text, shingle = sets_of(part)
                n = part.last - part.first
                sizes, keys = digests_of(text, shingle, n)
                order = ordered(shingle, text, sent.value)
                text, shingle = text[order], shingle[order]
                place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = place < (sizes // 5 + least_shared(sizes))[text]
                once = np.zeros(n, dtype=bool)
                once[np.unique(keys, return_index=True)[1]] = True
                first &= once[text]
                text, shingle = text[first], shingle[first]
                yield _packed(_block(shingle, tasks), [shingle, keys[text], sizes[text].astype(np.int64)])

    def count(batches):
        table = _entries(batches, 3)
        order = np.lexsort((table[:, 1], table[:, 0]))
        table = table[order]
        if len(table):
            new = np.concatenate([[True], (table[1:, :2] != table[:-1, :2]).any(axis=1)])
            table = table[new]
        start, length = _runs(table[:, 0])
        shared = np.repeat(length > 1, length)
        key, at, n = np.unique(table[shared, 1], return_index=True, return_counts=True)
        yield _packed(_block(key, tasks), [key, table[shared, 2][at], n])

    def total(batches):
        import pyarrow as pa

        table = _entries(batches, 3)
        start, _ = _runs(table[:, 0])
        shared = np.add.reduceat(table[:, 2], start) if len(start) else np.zeros(0, dtype=np.int64)
        node, n = table[start, 0], table[start, 1]
        enough_shared = shared >= least_shared((4 * n + 4) // 5)  # of the smallest set that could be linked
        yield pa.RecordBatch.from_arrays([pa.array(node[enough_shared]), pa.array(n[enough_shared])], names=["node", "n"])

    blocks = docs.select(text_col).mapInArrow(deal, PACKED).repartition(tasks, "block")
    counts = blocks.mapInArrow(count, PACKED).repartition(tasks, "block")
    return counts.mapInArrow(total, "node long, n long")


def members(docs: DataFrame, id_col: str, text_col: str, chosen: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(node, n, members): the sets of the chosen digests, once each, in the common order.

    A digest is looked up in the rows that have its id and its text's hash, so rows that
    share an id, or have none, meet only the sets of their own text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("own", F.xxhash64("text"))
    same = F.col("id").eqNullSafe(F.col("low")) & (F.col("own") == F.col("print"))
    rows = named.join(chosen, same).select("node", "n", "text")

    def build(batches):
        import pyarrow as pa

        done: set[int] = set()  # copies of a row tell nothing more
        for batch in batches:
            wanted = batch.column(0).to_numpy()
            nodes, sizes_out, out = [], [], []
            for part in slices(batch.column(2)):
                text, shingle = sets_of(part)
                sizes, keys = digests_of(text, shingle, part.last - part.first)
                order = ordered(shingle, text, sent.value)
                ends = np.cumsum(sizes)
                for t in np.flatnonzero(keys == wanted[part.first : part.last]):
                    if int(keys[t]) in done:
                        continue
                    done.add(int(keys[t]))
                    nodes.append(int(keys[t]))
                    sizes_out.append(int(sizes[t]))
                    out.append(shingle[order][ends[t] - sizes[t] : ends[t]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, type=pa.int64()), pa.array(sizes_out, type=pa.int64()), pa.array(out, type=pa.binary())], names=["node", "n", "members"]
            )

    return rows.mapInArrow(build, "node long, n long, members binary").dropDuplicates(["node"])


def _first(rows: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """Entries of the first n // 5 + 1 shingles of each row, with ``columns``, by block."""

    def deal(batches):
        for batch in batches:
            cells = [batch.column(k).to_numpy() for k in range(len(columns))]
            own = [np.frombuffer(m, dtype=np.uint64) for m in batch.column(len(columns)).to_pylist()]
            at = np.repeat(np.arange(len(own)), [len(o) for o in own])
            shingle = np.concatenate(own) if own else np.zeros(0, dtype=np.uint64)
            yield _packed(_block(shingle, tasks), [shingle, *(c[at].astype(np.int64) for c in cells)])

    return rows.select(*columns, "first").mapInArrow(deal, PACKED).repartition(tasks, "block")


def leads(firsts: DataFrame, tasks: int) -> DataFrame:
    """(node, lead): the smallest node that shares a first shingle with the node, itself
    included, for nodes that share one at all; others are linked with nothing."""

    def smallest(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((value, key))
        start, _ = _runs(key[order])
        return key[order][start], value[order][start]

    def least(batches):
        table = _entries(batches, 2)
        start, length = _runs(table[:, 0])
        low = np.minimum.reduceat(table[:, 1], start) if len(start) else np.zeros(0, dtype=np.int64)
        shared = np.repeat(length > 1, length)
        node, low = smallest(table[shared, 1], np.repeat(low, length)[shared])
        yield _packed(_block(node, tasks), [node, low])

    def least_of_all(batches):
        import pyarrow as pa

        table = _entries(batches, 2)
        node, low = smallest(table[:, 0], table[:, 1])
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], names=["node", "lead"])

    blocks = _first(firsts, ["node"], tasks).mapInArrow(least, PACKED).repartition(tasks, "block")
    return blocks.mapInArrow(least_of_all, "node long, lead long")


class Forest:
    """Components of a tile's rows."""

    def __init__(self, start: np.ndarray):
        self.up: dict[int, int] = {int(c): int(c) for c in start}

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def bit_maps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``BITS`` bits for each set: a bit for every shingle, several may share one."""
    maps = np.zeros((len(sets), BITS // 8), dtype=np.uint8)
    for i, s in enumerate(sets):
        bit = (s % np.uint64(BITS)).astype(np.int64)
        np.bitwise_or.at(maps[i], bit >> 3, (1 << (bit & 7)).astype(np.uint8))
    return maps.view(np.uint64)


def links_in(nodes: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between ``left`` and ``right`` rows of a tile that join components.

    A pair is discarded if its rows are joined already, if the sizes alone exclude a
    link, or if the bits that one set has and the other lacks do: each stands for a
    shingle that is not shared. What is left is compared shingle by shingle.
    """
    size = np.array([len(s) for s in sets])
    maps, forest, out = bit_maps(sets), Forest(comps), []
    sets = [np.sort(s) for s in sets]
    for i in left.tolist():
        others = right[(right != i) & (comps[right] != comps[i])]
        others = others[enough(np.minimum(size[others], size[i]), size[others], size[i])]
        if not len(others):
            continue
        lacks = np.bitwise_count(maps[i][None] & ~maps[others]).sum(axis=1, dtype=np.int64)
        lacked = np.bitwise_count(maps[others] & ~maps[i][None]).sum(axis=1, dtype=np.int64)
        most = np.minimum(size[i] - lacks, size[others] - lacked)
        hopeful = np.flatnonzero(enough(most, size[others], size[i]))
        for k in hopeful[np.argsort(-most[hopeful], kind="stable")].tolist():
            j = int(others[k])
            if forest.find(int(comps[i])) == forest.find(int(comps[j])):
                continue
            at = np.minimum(np.searchsorted(sets[j], sets[i]), size[j] - 1)
            if enough(int((sets[j][at] == sets[i]).sum()), int(size[i]), int(size[j])):
                forest.join(int(comps[i]), int(comps[j]))
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def multiply(tiles: DataFrame, tasks: int) -> DataFrame:
    """Links (a, b) of all tiles; rows are (tile, side, node, component, members).

    Pairs are formed between sides 0 and 1, or within side 0 if a tile has no other. A
    tile has a few hundred rows at most, and a task holds one tile at a time.
    """

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        side = np.array([r[1] for r in rows])
        nodes, comps = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        sets = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        return links_in(nodes, comps, sets, left, right if len(right) else left)

    def run(batches):
        import pyarrow as pa

        held: list[tuple] = []
        found: list[tuple[int, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    found += solve(held)
                    held = []
                held.append(row)
        if held:
            found += solve(held)
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], type=pa.int64()) for k in range(2)], names=["a", "b"])

    dealt = tiles.select("tile", "side", "node", "component", "members").repartition(tasks, "tile").sortWithinPartitions("tile", "side", "node")
    return dealt.mapInArrow(run, "a long, b long")


def crossing(firsts: DataFrame, tasks: int) -> DataFrame:
    """(tile, side, node): rows of two blocks that share a first shingle but no component."""

    def pair(batches):
        import pyarrow as pa

        table = _entries(batches, 5)  # shingle, node, n, component, rows' block
        found: set[tuple[int, int, int]] = set()
        start, length = _runs(table[:, 0])
        for a, k in zip(start[length > 1].tolist(), length[length > 1].tolist()):
            run = table[a : a + k]
            if (run[:, 3] == run[0, 3]).all() or (run[:, 4] == run[0, 4]).all():
                continue
            run = run[np.argsort(run[:, 4], kind="stable")]
            at, count = _runs(run[:, 4])
            parts = [run[s : s + c] for s, c in zip(at, count)]
            for i, x in enumerate(parts):
                for y in parts[i + 1 :]:
                    if (x[:, 3] == x[0, 3]).all() and (y[:, 3] == x[0, 3]).all():
                        continue
                    if not enough(min(x[:, 2].max(), y[:, 2].max()), max(x[:, 2].min(), y[:, 2].min()), min(x[:, 2].max(), y[:, 2].max())):
                        continue
                    found.update((int(x[0, 4]), int(y[0, 4]), int(v)) for v in x[:, 1])
                    found.update((int(x[0, 4]), int(y[0, 4]), int(v)) for v in y[:, 1])
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=pa.int64()) for k in range(3)], names=["i", "j", "node"])

    blocks = _first(firsts, ["node", "n", "component", "part"], tasks)
    return blocks.mapInArrow(pair, "i long, j long, node long").distinct()


def linked_sets(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of all sets that are linked with another; ``rows`` has doc_id, n_shingles, digest, often, and print, the text's hash."""
    spark = docs.sparkSession
    frequent = frequent_shingles(rows)
    entries = rows.agg(F.coalesce(F.sum(F.expr("n_shingles div 5 + n_shingles div 10 + 2")), F.lit(0))).first()[0]
    low = F.min(F.struct("doc_id", "print")).alias("low")
    nodes = rows.where("n_shingles > 0").groupBy("digest").agg(low).select("digest", F.col("low.doc_id").alias("low"), F.col("low.print").alias("print"))
    chosen = stored(candidates(docs, text_col, frequent, entries), "near-candidates")
    chosen = chosen.join(nodes, F.col("node") == F.col("digest")).select("node", "n", "low", "print")
    sets = stored(members(docs, id_col, text_col, chosen, frequent), "near-sets")

    first = F.substring("members", F.lit(1), ((F.expr("n div 5") + 1) * 8).cast("int")).alias("first")
    firsts = sets.select("node", "n", first)
    tasks = _tasks(spark, firsts.agg(F.coalesce(F.sum(F.expr("n div 5 + 1")), F.lit(0))).first()[0])
    led = leads(firsts, tasks)
    groups = led.groupBy("lead").agg(F.count(F.lit(1)).alias("rows"))
    part = F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.expr(f"(rows + {TILE - 1}) div {TILE}")))
    placed = stored(led.join(groups, "lead").select("node", "lead", part.alias("part")), "near-places")

    own = placed.select(F.col("part").alias("tile"), "node").unionByName(placed.select(F.col("part").alias("tile"), F.col("lead").alias("node"))).distinct()
    diagonal = own.join(sets, "node").select("tile", F.lit(0).alias("side"), "node", F.col("node").alias("component"), "members")
    links = stored(multiply(diagonal, tasks), "near-links")

    joined = components(links)
    known = placed.join(joined, "node", "left").select("node", "part", F.coalesce("component", "node").alias("component"))
    known = stored(known, "near-known")
    across = crossing(firsts.join(known, "node"), tasks)
    sides = across.join(known, "node").join(sets, "node")
    tiles = sides.select(
        F.xxhash64("i", "j").alias("tile"), F.when(F.col("part") == F.col("i"), 0).otherwise(1).alias("side"), "node", "component", "members"
    )
    more = multiply(tiles, tasks)
    return components(links.unionByName(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when their sets of 5-word shingles have a Jaccard similarity of 0.8
    or more, decided in whole numbers; component_id is the smallest id that links reach.
    Equal sets are one row of the matrix, so copies are never paired. A null or wordless
    text has an empty set and is linked with nothing, a text of one to four words is one
    shingle, rows that share an id are in the component of their own text, and a null id
    counts as larger than any other.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(with_sets(named, "text").select("doc_id", "n_shingles", "digest", "often", F.xxhash64("text").alias("print")), "near-rows")
    labels = linked_sets(named, rows, "doc_id", "text")
    nodes = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("low"))
    whole = nodes.join(labels, F.col("digest") == F.col("node"), "left").select("digest", "low", F.coalesce("component", "digest").alias("component"))
    lowest = whole.groupBy("component").agg(F.min("low").alias("component_id"))
    named_sets = whole.join(lowest, "component").select(F.col("digest").alias("set"), "component_id")
    out = rows.join(named_sets, (F.col("digest") == F.col("set")) & (F.col("n_shingles") > 0), "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, of which each group of near duplicates keeps one.

    It is the one with the smallest id, a null id being the largest, then by its text's
    hash. Groups are of texts, whatever ids their rows share; rows without words all stay.
    """
    row = free_name(docs, "_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "near-numbered")
    named = numbered.select(F.col(row).alias("_row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    printed = with_sets(named, "text").select("_row", "doc_id", "n_shingles", "digest", "often", F.xxhash64("text").alias("print"))
    rows = stored(printed, "near-rows")
    labels = linked_sets(named, rows, "doc_id", "text")
    worded = F.col("n_shingles") > 0
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "print", "_row").alias("place")
    whole = rows.where(worded).groupBy("digest").agg(F.min(place).alias("place")).join(labels, F.col("digest") == F.col("node"), "left")
    first = whole.groupBy(F.coalesce("component", "digest").alias("of")).agg(F.min("place").alias("place"))
    kept = first.select("place._row").unionByName(rows.where(~worded).select("_row")).withColumnRenamed("_row", row)
    return numbered.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
