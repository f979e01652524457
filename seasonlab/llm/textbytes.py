"""Whole texts as numpy bytes: slices of Arrow columns, words and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 1 << 20  # texts worked on together; a longer text is a slice of its own
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 2**64)
_TABLE = np.random.default_rng(20_240_229).integers(1, 2**64, 256, dtype=np.uint64)

WHITE = np.ones(256, dtype=bool)  # bytes of [^\x20\x09-\x0D]
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LETTERS = np.zeros(256, dtype=bool)  # bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z are lower case
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP and its inverse, modulo 2**64, to the powers 0 .. n at least."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((STEP, BACK)):
            p = np.full(n + 1, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


class Hashes:
    """Hash of any stretch of bytes, in constant time each."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + length)


_NEAR = 64  # places in a word whose bytes have tabled values
_SEED = np.uint64(0x51ED270B8D5A3C29)


def _values(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mixed((place.astype(np.uint64) << np.uint64(8) | byte) * np.uint64(STEP) + _SEED)


_VALUES = _values(np.repeat(np.arange(_NEAR), 256), np.tile(np.arange(256, dtype=np.uint64), _NEAR))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of some words that do not overlap, in order.

    Every (place, byte) of a word has a value of its own, without relation to others'; a
    hash mixes their sum and the length. Unlike a polynomial's, these sums do not meet for
    words that are built from the same bytes in a regular order.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    byte = data[np.repeat(starts, sizes) + place].astype(np.uint64)
    value = _VALUES[np.minimum(place, _NEAR - 1) << 8 | byte.astype(np.int64)]
    far = np.flatnonzero(place >= _NEAR)
    value[far] = _values(place[far], byte[far])
    return mixed(np.add.reduceat(value, first) + sizes.astype(np.uint64) * np.uint64(STEP))


@dataclass
class Slice:
    """Texts ``first`` to ``last`` of a batch as one array of bytes; text i is data[at[i]:at[i + 1]]."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of every run of ``inside`` bytes; runs end with their text."""
        is_in = inside[self.data]
        starts = is_in.copy()
        starts[1:] &= ~is_in[:-1]
        ends = is_in.copy()
        ends[:-1] &= ~is_in[1:]
        cuts = self.at[(self.at > 0) & (self.at < len(self.data))]
        starts[cuts] |= is_in[cuts]
        ends[cuts - 1] |= is_in[cuts - 1]
        s = np.flatnonzero(starts)
        return s, np.flatnonzero(ends) + 1, np.searchsorted(self.at, s, side="right") - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """A text column in slices of about ``limit`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    plain = column.fill_null("" if pa.types.is_string(column.type) else b"").cast(pa.large_binary())
    n = len(plain)
    if not n:
        return
    _, at, data = plain.buffers()
    at = np.frombuffer(at, dtype=np.int64)[plain.offset : plain.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield Slice(first, last, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def append_columns(df: DataFrame, text: str, new: list[StructField], work: Callable[[Iterator[Slice]], Iterable[list]]) -> DataFrame:
    """Rows with new columns computed from their text in Arrow batches.

    ``work`` gets the slices of a batch and gives for each the new columns' values.
    """
    schema = StructType([*df.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        kinds = [target.field(i).type for i in range(len(df_names), len(target))]
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = list(work(slices(batch.column(df_names.index(text)))))
            made = [pa.concat_arrays([pa.array(p[k], type=kinds[k]) for p in parts]) for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*df_names, *[f.name for f in new]])

    df_names = df.columns
    return df.mapInArrow(run, schema)
