"""Small tables with odd rows, and empty ones."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "stone river lamp green window carry under paper light song north field voice table early storm glass quiet road apple".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_documents() -> list[dict]:
    """Nulls, empty, short and long texts, copies, near copies, repeats, ties, equal rows."""
    rng = random.Random(7)
    base, passage, long = prose(rng, 120), prose(rng, 70), prose(rng, 9_000)
    texts = [None, None, "", "", " \t\n", "one", "One", "two words", "a b c d", "A b  c\nd", "%%% ### éè ß"]
    texts += [base, base, base + " tail1 tail2", base.upper(), " ".join(base.split()[:100])]
    for k in range(30):  # a large group of near copies of different degree
        words = base.split()
        for _ in range(k % 6):
            words[rng.randrange(len(words))] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [prose(rng, 60) + " " + passage + " " + prose(rng, 60) for _ in range(15)]
    texts += [long, long + " end", prose(rng, 50) + long[:2_000], "x" * 1_500, "ab" * 700, "x" * 400, "x" * 399]
    texts += [prose(rng, rng.randrange(1, 200)) for _ in range(40)]
    sources, langs = ["s1", "s2", "sé", None, ""], ["en", None, "fr"]
    rows = [{"doc_id": i, "text": t, "lang": langs[i % 3], "source": sources[i % 5]} for i, t in enumerate(texts)]
    rows += [dict(rows[11]), dict(rows[20])]  # equal rows
    rows.append({"doc_id": None, "text": base, "lang": None, "source": "s1"})
    rows.append({"doc_id": None, "text": None, "lang": None, "source": None})
    for i, r in enumerate(rows):
        r |= {"n_chars": len(r["text"] or ""), "size": i, "shard": "x", "key": i, "node": i, "score": 0.5, "block": i, "n": i, "row": i, "src": 1}
    return rows


DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("size", pa.int64()), ("shard", pa.string())]
    + [("key", pa.int64()), ("node", pa.int64()), ("score", pa.float64()), ("block", pa.int64()), ("n", pa.int64()), ("row", pa.int64()), ("src", pa.int64())]
)


def odd_items(rows: list[dict]) -> list[dict]:
    words = rows[11]["text"].split()
    texts = [None, "", "one", "two Words", " ".join(words[5:25]), " ".join(words[20:60]), " ".join(words[5:25]), "not there at all", "Éè x"]
    items = [{"item_id": 10 * i, "text": t} for i, t in enumerate(texts)]
    return items + [{"item_id": 40, "text": "one"}, {"item_id": None, "text": "one"}]


def odd_embeddings() -> list[dict]:
    """Null, empty, short, long and non-finite vectors, copies, a hot vector, equal and null ids."""
    rng = random.Random(3)
    vectors = [[rng.uniform(-1, 1) * (k + 1) for k in range(6)] for _ in range(60)]
    vectors += [vectors[5]] * 30 + [[v + 1e-6 for v in vectors[7]]]
    vectors += [None, [], [1.0], [0.5] * 7, [None] * 6, [0.1, None, 0, 0, 0, 0], [float("nan")] * 6, [float("inf"), 0, 0, 0, 0, 0], [1e30] + [0.0] * 5]
    rows = [{"vec_id": None if i % 17 == 3 else i // 2, "embedding": v, "label": i % 3, "_x": i, "n": i, "component": i} for i, v in enumerate(vectors)]
    return [*rows, dict(rows[8])]


def write_tables(folder: str, rows: list[dict], items: list[dict]) -> str:
    labels = [{"doc_id": r["doc_id"], "quality": 1, "toxic": k % 4 // 3} for k, r in enumerate(rows)] + [{"doc_id": None, "quality": None, "toxic": None}]
    page = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Head</h1><p>Some text, with  words.\n And more &amp; more.</p></article><footer>End</footer></body></html>"
    pages = [{"page_id": 1, "url": "u1", "html": page}, {"page_id": 2, "url": None, "html": None}, {"page_id": None, "url": "u3", "html": ""}, {"page_id": 1, "url": "u1", "html": page}]
    kinds = {
        "documents": (rows, DOCUMENTS),
        "benchmark": (items, pa.schema([("item_id", pa.int64()), ("text", pa.string())])),
        "labels": (labels if rows else [], pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])),
        "pages": (pages if rows else [], pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])),
        "embeddings": (odd_embeddings() if rows else [], pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32()), ("_x", pa.int64()), ("n", pa.int64()), ("component", pa.int64())])),
    }
    for name, (data, schema) in kinds.items():
        pq.write_table(pa.Table.from_pylist(data, schema=schema), f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    rows = odd_documents()
    return write_tables(str(tmp_path_factory.mktemp("odd")), rows, odd_items(rows))


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write_tables(str(tmp_path_factory.mktemp("empty")), [], [])
