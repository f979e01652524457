"""Rows that share an id or have none, words built to collide, columns with the operators' names."""

from __future__ import annotations

import time
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonlab.llm.benchmark import contamination
from seasonlab.llm.jaccard import keep_one, near_duplicates
from seasonlab.llm.textbytes import word_hashes


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_of_a_regular_order_do_not_collide(spark, rows):
    """Such words have one polynomial hash modulo 2**64, whatever its base."""
    x, y = thue_morse(2_048, "a", "b"), thue_morse(2_048, "b", "a")
    data = np.frombuffer(f"{x} {y}".encode(), dtype=np.uint8)
    hashes = word_hashes(data, np.array([0, 2_049]), np.array([2_048, 4_097]))
    assert hashes[0] != hashes[1]
    docs = rows([(1, x), (2, y), (3, x)], "doc_id long, text string")
    assert Counter(tuple(r) for r in near_duplicates(docs).collect()) == Counter([(1, 1, 1), (2, 1, 2), (3, 1, 1)])
    found = contamination(docs, rows([(7, y)], "item_id long, text string")).collect()
    assert {r.doc_id: r.contaminated for r in found} == {1: False, 2: True, 3: False}


def test_hashes_of_words_are_of_their_bytes_alone():
    data = np.frombuffer(b"abc  abc x" + b"abc" * 100 + b" " + b"abc" * 100, dtype=np.uint8)
    s, e = np.array([0, 5, 9, 311]), np.array([3, 8, 310, 611])
    h = word_hashes(data, s, e)
    assert h[0] == h[1] and len(set(h.tolist())) == 3
    assert (word_hashes(data, s[:0], e[:0]) == np.zeros(0)).all()


def pairs(spark, n: int, id_):
    """n rows in pairs of near copies; ``id_`` makes the id column of the row number."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(39)), lambda k: F.concat(F.lit("w"), F.floor(F.col("id") / 2).cast("string"), F.lit("x"), k.cast("string"))))
    return spark.range(n).select(id_(F.col("id")).alias("doc_id"), F.concat_ws(" ", words, F.when(F.col("id") % 2 == 1, F.lit("end"))).alias("text"), F.col("id").alias("own"))


KINDS = {"null": lambda i: F.lit(None).cast("long"), "one": lambda i: F.lit(5).cast("long"), "a third": lambda i: F.when(i % 3 == 0, 7).when(i % 3 == 1, F.lit(None)).otherwise(i)}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_shared_ids_cost_no_more(spark, kind):
    def seconds(id_) -> float:
        start = time.monotonic()
        out = near_duplicates(pairs(spark, 4_000, id_))
        assert out.count() == 4_000 and out.where("n_shingles < 36").count() == 0
        return time.monotonic() - start

    seconds(lambda i: i)
    assert seconds(KINDS[kind]) < 3 * seconds(lambda i: i) + 5


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_one_of_each_pair_stays_whatever_the_ids(spark, kind):
    out = keep_one(pairs(spark, 600, KINDS[kind])).collect()
    assert Counter(r.own // 2 for r in out) == Counter(range(300))


def test_near_duplicates_of_shared_ids_equal_brute_force(spark, rows):
    words = " ".join(f"w{k}" for k in range(30))
    texts = [(1, words), (1, words + " a"), (None, words + " b"), (None, "z " * 9), (2, "z " * 9), (2, None), (None, None), (None, words), (1, words)]
    found = Counter(tuple(r) for r in near_duplicates(rows(texts, "doc_id long, text string")).collect())
    assert found == brute.near(texts)


def test_columns_with_the_names_of_helpers_come_back(spark, rows):
    from seasonlab.llm.mixing import repeat_to_mix

    names = ["_row", "_id", "_times", "_again", "__row", "print", "digest", "low"]
    data = [(i, f"some words of text {i} " * (i + 1), "s", *[77 + i] * len(names)) for i in range(6)]
    docs = rows(data, "doc_id long, text string, source string, " + ", ".join(f"{n} long" for n in names))
    for out in (keep_one(docs), repeat_to_mix(docs)):
        assert out.columns == docs.columns
        assert all(set(r[3:]) == {77 + r.doc_id} for r in out.collect())


def test_samples_are_bounded_in_rows(spark, monkeypatch):
    """A third of the rows has one id, a third none; what is learnt from stays bounded."""
    import seasonlab.llm.langid as lang
    import seasonlab.llm.toxicity as tox

    i = F.col("id")
    docs = spark.range(6_000).select(
        F.when(i % 3 == 0, 1).when(i % 3 == 1, i).alias("doc_id"),
        F.concat(F.when(i % 2 == 0, "the house is on the hill ").otherwise("das haus ist auf dem berg "), i.cast("string")).alias("text"),
        F.when(i % 2 == 0, "en").otherwise("de").alias("lang"),
    )
    sizes = []
    fit = lang.fit
    monkeypatch.setattr(lang, "fit", lambda x, y, names: sizes.append(Counter(y.tolist())) or fit(x, y, names))
    assert lang.learn(docs, rows=50) is not None
    assert sizes == [Counter({0: 50, 1: 50})]

    monkeypatch.setattr(tox, "POSITIVE_ROWS", 40)
    monkeypatch.setattr(tox, "UNLABELLED_ROWS", 60)
    seen = []
    real = np.zeros
    monkeypatch.setattr(tox.np, "zeros", lambda shape, *a, **k: seen.append(shape) or real(shape, *a, **k))
    tox.learn(docs, spark.range(0, 6_000, 5).select(i.alias("doc_id"), F.lit(1).alias("toxic")), "doc_id", "text", "doc_id", "toxic")
    assert max(s[0] for s in seen if isinstance(s, tuple) and len(s) == 2) <= 100


def test_rows_in_the_order_of_slots_are_evenly_mixed(spark):
    """Any stretch of the schedule holds each source's share of words, but for a few blocks."""
    from seasonlab.llm.mixing import mix

    i = F.col("id")
    docs = spark.range(9_000).select(i.alias("doc_id"), F.when(i % 9 == 0, "a").when(i % 3 == 0, "b").otherwise("c").alias("source"), F.repeat(F.lit("w "), 20).alias("text"))
    out = mix(docs, block=64).where("taken > 0").orderBy("slot", "doc_id").collect()
    target = {r.source_size: r.target for r in out}
    whole = sum(target.values())
    assert len(target) == 3 and out[0].slot >= 0
    for first in range(0, len(out) // 2, 500):  # repeats come later than first takings
        part = out[first : first + 1_000]
        words = sum(r.size for r in part)
        for size, t in target.items():
            if t < size:  # a source that is not repeated
                assert abs(sum(r.size for r in part if r.source_size == size) - words * t / whole) < 0.1 * words + 300
