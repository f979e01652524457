"""Prefix counts against the tokenizer's own library."""

from __future__ import annotations

import json
import random

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from odd_tables import odd  # noqa: F401  (fixture)

from seasonlab.llm.queries import QUERIES
from seasonlab.llm.tokens import PrefixCounter, chars_within, prefix_counts, tokens_of_prefix

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return PrefixCounter(file.read())


def sizes(library, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


PARTS = [" ", "  ", "\n", "\t", "\r\n", " ", "　", "'", "ll", "'re", "'ve", "'ll", "'s", "a", "the", " the", "b", "xx", "é", "ß", "语", "😀", "Ж", "w", "1", "23", "!", "...", "==", "<|endoftext|>", "<|endof", "|>"]


def test_every_prefix_equals_the_library(library, counter):
    """Runs of white space, shortened words and special tokens, cut at every character."""
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 14))) for _ in range(1_200)]
    for text, steps in zip(texts, counter.steps(texts)):
        assert steps.cumsum().tolist() == sizes(library, [text[: k + 1] for k in range(len(text))]), text


def test_every_code_point_is_cut_as_by_the_library(library, counter):
    probes = ["a" + chr(c) + "1 " + chr(c) + chr(c) + "!" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    assert [int(s.sum()) for s in counter.steps(probes)] == sizes(library, probes)


def test_long_pieces_equal_the_library(library, counter):
    rng = random.Random(2)
    texts = ["x" * 5_000, "=" * 700, " " * 900, "\n" * 300 + "a", "语" * 400, "".join(rng.choice("abcdef") for _ in range(3_000)), "ab" * 2_000]
    texts += ["".join(rng.choice("etaoin") for _ in range(rng.randrange(60, 70))) for _ in range(200)]
    assert [int(s.sum()) for s in counter.steps(texts)] == sizes(library, texts)


def test_a_small_memory_changes_nothing(library, monkeypatch):
    import seasonlab.llm.tokens as t

    monkeypatch.setattr(t, "CACHE_PIECES", 50)
    with open(PATH, encoding="utf-8") as file:
        small = PrefixCounter(file.read())
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    assert [int(s.sum()) for k in range(0, len(texts), 7) for s in small.steps(texts[k : k + 7])] == sizes(library, texts)


def test_query_equals_the_library(spark, odd, library):  # noqa: F811
    for folder in (odd, "/root/testdata/sf0.001"):
        docs = [(i, t or "") for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()]
        want = sorted(((i or -1), len(t.encode()), n, n > 512) for (i, t), n in zip(docs, sizes(library, [t for _, t in docs])))
        got = QUERIES["op12_token_counts"](spark, folder).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
        assert all(r.chars_within_512 == len(t) for t, r in zip([t for _, t in docs], got) if not r.over_limit) or folder == odd


def test_questions_are_answered_from_what_is_stored(spark, rows, library, tmp_path):
    docs = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' LIMIT 12").fetchall()] + ["", None, "a  b" * 40]
    made = prefix_counts(rows([(i, t, i % 3) for i, t in enumerate(docs)], "doc_id long, text string, steps long"), PATH)
    made.drop("text").write.parquet(str(tmp_path / "steps"))
    kept = spark.read.parquet(str(tmp_path / "steps"))
    for budget in (-1, 0, 1, 7, 100):
        asked = kept.select("doc_id", chars_within(F.lit(budget)).alias("c"), tokens_of_prefix(F.lit(budget)).alias("t"))
        for r in asked.collect():
            text = docs[r.doc_id] or ""
            counts = [0, *sizes(library, [text[: k + 1] for k in range(min(len(text), 900))])]
            if len(text) <= 900 or r.c < 800:
                assert r.c == (max(k for k, n in enumerate(counts) if n <= budget) if budget >= 0 else 0)
            assert r.t == counts[min(max(budget, 0), len(text))]
    nulls = kept.select(chars_within(F.lit(None).cast("long")).alias("c"), tokens_of_prefix(F.lit(None).cast("long")).alias("t")).distinct()
    assert [tuple(r) for r in nulls.collect()] == [(None, None)]


def test_other_tokenizers_are_refused():
    with open(PATH, encoding="utf-8") as file:
        told = json.load(file)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": told["model"] | {"byte_fallback": True}}):
        with pytest.raises(ValueError):
            PrefixCounter(json.dumps(told | change))
