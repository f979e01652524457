"""Toxicity by non-negative positive-unlabelled learning, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from seasonlab.llm.common import held_out
from seasonlab.llm.textbytes import LETTERS, LOWER, Hashes, Slice, append_columns, slices

POSITIVE_ROWS = 2_000  # most confirmed rows that are learnt from
UNLABELLED_ROWS = 8_000  # most unlabelled rows
FEATURES = 1_024
LEAST_GAP = 3.5  # standard errors between the samples that a piece needs to be used
SLOTS = 1 << 22


def pieces(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of all words, their first four and five and last four bytes."""
    data = LOWER[part.data]
    s, e, text = Slice(part.first, part.last, data, part.at).words(LETTERS)
    if not len(s):
        return text, np.zeros(0, dtype=np.int64)
    hashes = Hashes(data)
    found = [hashes.of(s, e)]
    for k, (a, b) in enumerate(((s, np.minimum(e, s + 4)), (s, np.minimum(e, s + 5)), (np.maximum(s, e - 4), e)), 1):
        found.append(hashes.of(a, b) + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64))
    slot = (np.concatenate(found) >> np.uint64(64 - 22)).astype(np.int64)
    return np.tile(text, len(found)), slot


def _known(slots: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``slot`` are among the sorted ``slots``, and where."""
    if not len(slots):
        return np.zeros(len(slot), dtype=bool), np.zeros(len(slot), dtype=np.int64)
    at = np.minimum(np.searchsorted(slots, slot), len(slots) - 1)
    return slots[at] == slot, at


@dataclass
class Classifier:
    """A logistic model of which of the chosen pieces a text holds."""

    slots: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def scores(self, part: Slice) -> np.ndarray:
        n = part.last - part.first
        text, slot = pieces(part)
        hit, at = _known(self.slots, slot)
        wide = max(1, len(self.slots))
        pair = np.unique(text[hit] * wide + at[hit])
        logit = self.bias + np.bincount(pair // wide, self.weights[pair % wide], minlength=n)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk of the sigmoid loss by Adam.

    The risk of the negatives is that of the unlabelled rows less ``prior`` times that of
    the positives as negatives. Where it falls below zero the step goes the other way on
    that part, as the non-negative estimator has it, so that positives are not learnt by heart.
    """
    x = np.vstack([positive, unlabelled]).astype(np.float32)
    is_p = np.arange(len(x)) < len(positive)
    share_p, share_u = is_p / max(1, len(positive)), ~is_p / max(1, len(unlabelled))
    w = np.zeros(x.shape[1] + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = x @ w[:-1].astype(np.float32) + w[-1]
        q = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        slope = q * (1 - q)
        risk = (share_u - prior * share_p) @ q
        pull = (share_u - prior * share_p) * slope
        if risk >= 0:
            pull = pull - prior * share_p * slope
        else:
            pull = -pull
        g = np.append(x.T @ pull.astype(np.float32), pull.sum()) + decay * w * (np.arange(len(w)) < len(w) - 1)
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", toxic: str = "toxic") -> Classifier:
    """A classifier from confirmed toxic rows and unlabelled text, none of them held out.

    At most ``POSITIVE_ROWS`` and ``UNLABELLED_ROWS`` rows are learnt from, first by a
    hash of the id, then by one of the text; equal rows count once. Rows without an id are
    not learnt from. The class prior is the toxic share of all rows with a label that are
    not held out. Pieces are counted by rows in Spark and the ``FEATURES`` that differ
    most between the two samples are used. Without toxic rows every score is the prior.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = labels.select(F.col(label_id).cast("long").alias("id"), (F.col(toxic) == 1).alias("toxic"))
    known = known.where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    prior = known.agg(F.avg(F.col("toxic").cast("int"))).first()[0] or 0.0
    named = named.withColumn("own", F.xxhash64("text"))
    keys = named.select("id", "own").distinct()
    order = [F.xxhash64("id", F.lit(4)), F.col("id"), F.col("own")]
    marked = keys.join(known.where("toxic").select("id").distinct(), "id")
    p = marked.orderBy(*order).limit(POSITIVE_ROWS).select("id", "own", F.lit(1).alias("p"), F.lit(0).alias("u"))
    u = keys.orderBy(*order).limit(UNLABELLED_ROWS).select("id", "own", F.lit(0).alias("p"), F.lit(1).alias("u"))
    sample = F.broadcast(p.unionByName(u).groupBy("id", "own").agg(F.max("p").alias("p"), F.max("u").alias("u")))
    texts = named.join(sample, ["id", "own"]).dropDuplicates(["id", "own"]).select("id", "p", "u", "text")

    def rows_with(batches):
        import pyarrow as pa

        for batch in batches:
            out: list[np.ndarray] = []
            for part in slices(batch.column(3)):
                text, slot = pieces(part)
                pair = np.unique(text * SLOTS + slot)
                out.append(np.stack([pair // SLOTS + part.first, pair % SLOTS]))
            at, slot = np.concatenate(out, axis=1) if out else np.zeros((2, 0), dtype=np.int64)
            of = [batch.column(k).to_numpy(zero_copy_only=False)[at] for k in range(3)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, of), pa.array(slot)], names=["id", "p", "u", "slot"])

    held = texts.mapInArrow(rows_with, "id long, p int, u int, slot long")
    counts = held.groupBy("slot").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where("p > 1")
    n_p, n_u = (int(v or 0) for v in texts.agg(F.sum("p"), F.sum("u")).first())
    if not n_p or not n_u:
        return Classifier(np.zeros(0, dtype=np.int64), np.zeros(0), float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))))
    both = (F.col("p") + F.col("u")) / (n_p + n_u)
    gap = F.abs(F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-9)) * (1 / n_p + 1 / n_u))
    told = counts.withColumn("gap", gap).where(F.col("gap") >= LEAST_GAP).orderBy(F.desc("gap"), "slot").limit(FEATURES)
    slots = np.array(sorted(r.slot for r in told.collect()), dtype=np.int64)

    def chosen(batches):
        import pyarrow as pa

        for batch in batches:
            marks = []
            for part in slices(batch.column(3)):
                text, slot = pieces(part)
                hit, at = _known(slots, slot)
                own: list[set] = [set() for _ in range(part.last - part.first)]
                for t, k in np.unique(np.stack([text[hit], at[hit]]), axis=1).T.tolist():
                    own[t].add(k)
                marks += [sorted(o) for o in own]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(marks, type=pa.list_(pa.int32()))], names=["id", "p", "u", "marks"])

    rows = sorted(texts.mapInArrow(chosen, "id long, p int, u int, marks array<int>").collect(), key=lambda r: (r.id, r.marks))
    x = np.zeros((len(rows), len(slots)), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, r.marks] = 1
    weights, bias = fit(x[[r.p == 1 for r in rows]], x[[r.u == 1 for r in rows]], prior)
    return Classifier(slots, weights, bias)


def score(docs: DataFrame, classifier: Classifier, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns with a score from 0 to 1 of the whole text; empty texts too."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def work(parts: Iterable[Slice]) -> Iterator[list]:
        for part in parts:
            yield [sent.value.scores(part).tolist()]

    return append_columns(docs, text_col, [StructField(name, DoubleType())], work)


def toxicity(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 at ``least`` or above)."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = score(named, learn(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
