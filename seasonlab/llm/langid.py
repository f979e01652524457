"""Language identification by a small convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from seasonlab.llm.common import held_out
from seasonlab.llm.textbytes import Slice, append_columns, slices

WINDOW = 256  # bytes of a window
WIDTHS = (2, 3, 4)  # bytes that a filter sees
FILTERS = 8  # of each width
ROWS_A_LANGUAGE = 400  # most labelled rows of a language that are learnt from
DRAWN = 4  # times as many rows pass the hash threshold, on average
WINDOWS_A_ROW = 6
AT_ONCE = 32  # windows that are scored together
UNKNOWN = "und"


@dataclass
class Network:
    """Filters as tables by byte and place, then max pooling and a softmax layer."""

    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def __post_init__(self) -> None:
        """Tables by pairs of bytes: a filter of four bytes is two look-ups."""
        a, b = np.divmod(np.arange(65_536), 256)
        two, three, four = self.filters
        near = [two[0][a] + two[1][b], three[0][a] + three[1][b], four[0][a] + four[1][b]]
        self.near = np.ascontiguousarray(np.hstack(near), dtype=np.float32)
        self.far = np.ascontiguousarray(np.hstack([three[2][a], four[2][a] + four[3][b]]), dtype=np.float32)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax of each row of bytes (rows of ``WINDOW``, zero where text ends)."""
        out = np.empty((len(windows), len(self.languages)), dtype=np.float32)
        for at in range(0, len(windows), AT_ONCE):
            part = windows[at : at + AT_ONCE].astype(np.int32)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            reply = self.near[pairs[:, :-2]]
            reply[:, :, FILTERS:] += self.far[pairs[:, 2:]]
            pooled = np.maximum(reply.max(axis=1) + self.bias, 0)
            logits = pooled @ self.out + self.out_bias
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            out[at : at + AT_ONCE] = e / e.sum(axis=1, keepdims=True)
        return out


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 10) -> Network:
    """Adam on the cross-entropy; the gradient of max pooling reaches one place per filter."""
    rng = np.random.default_rng(seed)
    width = FILTERS * len(WIDTHS)
    params = [rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS]
    params += [np.zeros(width), rng.normal(0, 0.3, (width, len(languages))), np.zeros(len(languages))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    places = WINDOW - max(WIDTHS) + 1
    by_label = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(own, max(1, batch // len(languages))) for own in by_label if len(own)])
        x, y = windows[chosen].astype(np.int64), labels[chosen]
        tops, values = [], []
        for table, w in zip(params, WIDTHS):
            reply = sum(table[j][x[:, j : j + places]] for j in range(w))
            tops.append(reply.argmax(axis=1))
            values.append(np.take_along_axis(reply, tops[-1][:, None], axis=1)[:, 0])
        before = np.hstack(values) + params[-3]
        pooled = np.maximum(before, 0)
        logits = pooled @ params[-2] + params[-1]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = e / e.sum(axis=1, keepdims=True)
        error[np.arange(len(y)), y] -= 1
        error /= len(y)
        back = (error @ params[-2].T) * (before > 0)
        grads = []
        for k, w in enumerate(WIDTHS):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            g = np.zeros_like(params[k])
            for j in range(w):
                at = np.take_along_axis(x, tops[k] + j, axis=1)
                np.add.at(g[j], (at, np.arange(FILTERS)[None]), own)
            grads.append(g)
        grads += [back.sum(axis=0), pooled.T @ error, error.sum(axis=0)]
        for i, g in enumerate(grads):
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.001 * (g * g - second[i])
            params[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Network(languages, params[:3], params[-3].astype(np.float32), params[-2].astype(np.float32), params[-1].astype(np.float32))


def cut(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Every text in windows, the last filled with zeros, and the text of each window."""
    sizes = np.diff(part.at)
    count = np.maximum(1, -(-sizes // WINDOW))
    owner = np.repeat(np.arange(len(count)), count)
    flat = np.zeros(len(owner) * WINDOW, dtype=np.uint8)
    shift = (np.cumsum(count) - count) * WINDOW - part.at[:-1]
    flat[np.arange(len(part.data)) + np.repeat(shift, sizes)] = part.data
    return flat.reshape(-1, WINDOW), owner


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS_A_LANGUAGE) -> Network | None:
    """A network from rows with a language whose id is not held out; None without any.

    From each language at most ``rows`` rows are taken, by a hash of id and text; equal rows
    count once, and a null id is as good as any. A hash threshold leaves about four times as many as
    are wanted, so no task ranks a whole language. Of each row up to ``WINDOWS_A_ROW`` windows spread over its whole text.
    """
    known = docs.where(F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)) & F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("own"))
    named = known.select("lang", "id", "own").distinct().withColumn("turn", F.xxhash64("id", "own", F.lit(10)))
    counts = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    drawn = named.join(counts, "lang").where(F.pmod("turn", F.lit(2**30)) * F.col("n") < float(DRAWN * rows * 2**30))
    order = Window.partitionBy("lang").orderBy("turn", "id", "own")
    picked = drawn.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows)
    picked = picked.select(F.col("lang").alias("picked_lang"), F.col("id").alias("picked_id"), F.col("own").alias("picked_own"))
    same = F.col("id").eqNullSafe(F.col("picked_id")) & (F.col("lang") == F.col("picked_lang")) & (F.col("own") == F.col("picked_own"))
    texts = known.join(F.broadcast(picked), same).dropDuplicates(["lang", "id", "own"]).select("lang", "id", "text")

    def windows(batches):
        import pyarrow as pa

        for batch in batches:
            langs, ids, cells = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for part in slices(batch.column(2)):
                rows_of, owner = cut(part)
                ends = np.searchsorted(owner, np.arange(part.last - part.first + 1))
                for t in range(part.last - part.first):
                    at = np.unique(np.linspace(ends[t], ends[t + 1] - 1, WINDOWS_A_ROW).astype(int))
                    cells += [(langs[part.first + t], ids[part.first + t], int(i - ends[t]), rows_of[i].tobytes()) for i in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[k] for c in cells], type=kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                names=["lang", "id", "place", "bytes"],
            )

    found = texts.mapInArrow(windows, "lang string, id long, place long, bytes binary").collect()
    found = sorted(((r.lang, r.id, r.place, bytes(r.bytes)) for r in found), key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2], r[3]))
    if not found:
        return None
    languages = sorted({r[0] for r in found})
    x = np.stack([np.frombuffer(r[3], dtype=np.uint8) for r in found])
    return fit(x, np.array([languages.index(r[0]) for r in found]), languages)


def with_language(docs: DataFrame, network: Network | None, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns with the language of the whole text and its probability.

    Softmax outputs are averaged over all windows of a text. A text that is null or has
    no letter is ``und`` with the score 0; so is every text if nothing was learnt.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def work(parts: Iterable[Slice]) -> Iterator[list]:
        net = sent.value
        for part in parts:
            n = part.last - part.first
            if net is None:
                yield [[UNKNOWN] * n, [0.0] * n]
                continue
            rows, owner = cut(part)
            weight = np.maximum((rows != 0).sum(axis=1), 1)
            p = net.probabilities(rows).astype(np.float64) * weight[:, None]
            ends = np.searchsorted(owner, np.arange(n))
            mean = np.add.reduceat(p, ends, axis=0) / np.add.reduceat(weight, ends)[:, None]
            best = mean.argmax(axis=1)
            yield [[net.languages[k] for k in best], np.clip(mean[np.arange(n), best], 0, 1).tolist()]

    fields = [StructField(pred, StringType()), StructField(score, DoubleType())]
    lettered = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    out = append_columns(docs, text_col, fields, work)
    return out.withColumn(score, F.when(lettered, F.col(score)).otherwise(0.0)).withColumn(pred, F.when(lettered, F.col(pred)).otherwise(UNKNOWN))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    out = with_language(named.select("doc_id", "text"), learn(named))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.4, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text has a language with a score of ``least`` or more."""
    pred, score = "lang_pred", "lang_score"
    while pred in docs.columns or score in docs.columns:
        pred, score = f"_{pred}", f"_{score}"
    out = with_language(docs, learn(docs, text_col=text_col), text_col, pred, score)
    return out.where((F.col(pred) != UNKNOWN) & (F.col(score) >= least)).drop(pred, score)
