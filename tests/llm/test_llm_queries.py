"""Every text query on odd rows, on empty tables and against SQL or a plain version."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from functools import reduce

import brute
import duckdb
import pytest

from odd_tables import empty, odd  # noqa: F401  (fixtures)
from oracle import compare, connect

import corpus_pipeline
from seasonlab.llm.queries import ORACLES, QUERIES

NAMES = sorted(QUERIES)
SMALL = "/root/testdata/sf0.001"


def documents(folder: str, columns: str = "doc_id, text") -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/documents.parquet'").fetchall()


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL) is None


@pytest.mark.parametrize("name", [*NAMES, "pipeline"])
def test_empty_tables_give_no_rows(spark, empty, name):
    assert corpus_pipeline.QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("op5_html_field", "op11_whitening")])
def test_one_row_per_document(spark, odd, name):
    ids = Counter(r.doc_id for r in QUERIES[name](spark, odd).select("doc_id").collect())
    assert ids == Counter(i for i, _ in documents(odd))


def test_near_duplicates_equal_brute_force(spark, odd):
    assert rows_of(QUERIES["op1_jaccard_join"](spark, odd)) == brute.near(documents(odd))


def test_repeats_equal_brute_force(spark, odd):
    assert rows_of(QUERIES["op2_suffix_repeats"](spark, odd)) == brute.repeats(documents(odd))


@pytest.mark.parametrize("parts", [1, 9])
def test_repeats_do_not_depend_on_batches(spark, odd, parts):
    from seasonlab.llm.suffixes import without_repeats

    docs = spark.read.parquet(f"{odd}/documents.parquet").repartition(parts)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, 5)
    try:
        found = without_repeats(docs, length=450).collect()
    finally:
        spark.conf.unset(batch)
    want = [(r[0], r[1], r[2], r[3]) for r in brute.repeats(documents(odd), 450).elements()]
    assert Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) for r in found) == Counter(want)


def test_contamination_equals_brute_force(spark, odd):
    items = duckdb.sql(f"SELECT item_id, text FROM '{odd}/benchmark.parquet'").fetchall()
    assert rows_of(QUERIES["op8_benchmark_suffixes"](spark, odd)) == brute.contaminated(documents(odd), items)


def test_benchmark_in_several_blocks(spark, odd, monkeypatch):
    import seasonlab.llm.benchmark as b

    monkeypatch.setattr(b, "BLOCK_WORDS", 15)
    items = duckdb.sql(f"SELECT item_id, text FROM '{odd}/benchmark.parquet'").fetchall()
    assert rows_of(QUERIES["op8_benchmark_suffixes"](spark, odd)) == brute.contaminated(documents(odd), items)


def test_longest_matches_tell_where(spark, rows):
    from seasonlab.llm.benchmark import longest_matches

    item = " ".join(f"w{i}" for i in range(25))
    docs = rows([(1, "x y " + item + " z"), (2, " ".join(f"w{i}" for i in range(3, 15))), (3, "w1 w2")], "doc_id long, text string")
    found = longest_matches(docs, rows([(7, item)], "item_id long, text string")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 2, "7", 25), (2, 0, "7", 12)]


def test_exact_copies_equal_brute_force(spark, odd):
    import hashlib

    groups = defaultdict(list)
    for i, t in documents(odd):
        groups[t or ""].append(i)
    found = defaultdict(list)
    for r in QUERIES["op9_exact_duplicates"](spark, odd).collect():
        found[r.text_sha256].append(r)
    assert len(found) == len(groups)
    for text, ids in groups.items():
        own = found[hashlib.sha256(text.encode()).hexdigest()]
        keep = max((i for i in ids if i is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [keep]


def test_frequent_digests_are_bounded_and_hold_the_hot_one(spark):
    from seasonlab.llm.exact import frequent_digests

    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS digest")
    found = frequent_digests(rows, heavy=128, counters=64)
    assert found.count() <= 128
    assert found.join(spark.sql("SELECT xxhash64('hot') AS print"), "print").count() == 1


def test_shards(spark, odd):
    found = QUERIES["op6_sampled_splitters"](spark, odd).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in documents(odd))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)} and {r.shard for r in found} <= set(range(16))
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_even_where_a_third_is_one_text(spark):
    from seasonlab.llm.shards import shard_by_size

    docs = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, repeat('hot ', 20), repeat(CAST(id AS STRING), CAST(id % 17 AS INT))) AS text")
    found = shard_by_size(docs, 16)
    sums = [r[0] for r in found.groupBy("shard").agg({"size": "sum"}).select("sum(size)").collect()]
    assert len(sums) == 16 and max(sums) < 1.02 * min(sums)
    assert rows_of(found) == rows_of(shard_by_size(docs.repartition(7), 16))


def test_mix_on_odd_rows(spark, odd):
    found = QUERIES["op3_mix_sources"](spark, odd).collect()
    size = {s: 0 for s in ("s1", "s2", "sé", None, "")}
    for s, t in documents(odd, "source, text"):
        size[s] += len(brute.WHITE.findall(t or ""))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, left, target = 1.5 * sum(size.values()), set(size), {}
    while True:
        level = (goal - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= over
    target |= {s: level * weight[s] for s in left}
    assert {round(r.target, 6) for r in found} == {round(t, 6) for t in target.values()}
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    taken = defaultdict(int)
    for r in found:
        taken[r.target] += r.taken
    assert all(abs(t - n) <= 0.5 for t, n in taken.items())


def test_mix_reruns_agree(spark, odd):
    from seasonlab.llm.mixing import mix

    docs = spark.read.parquet(f"{odd}/documents.parquet")
    assert rows_of(mix(docs, block=16)) == rows_of(mix(docs.repartition(5), block=16))


def test_schedule_is_even_in_every_stretch(spark):
    """Any run of slots holds each source's share of it, but for a few slots."""
    from seasonlab.llm.mixing import GOLDEN

    hits = [(0.5 + n * GOLDEN) % 1 < 0.3 for n in range(3_000)]
    assert all(abs(sum(hits[a : a + 500]) - 150) < 6 for a in range(0, 2_500, 100))


def test_fuzzy_lines_equal_brute_force(spark, rows):
    import re

    line = "the quick brown fox jumps over the lazy dog and runs through the deep dark forest until the night falls on the quiet hills of the north"
    texts = [(3, f"{line}\nalpha beta"), (1, f"{line.upper()}!!\n\n{line}s"), (2, "x\nx\n---\n---"), (4, None), (None, "alpha beta"), (5, "alpha, BETA?\ngamma")]
    from seasonlab.llm.lines import fuzzy_lines

    found = Counter((r.doc_id, r.n_lines, r.n_kept, tuple(r.kept)) for r in fuzzy_lines(rows(texts, "doc_id long, text string")).collect())
    norm = {}
    for doc, text in texts:
        for no, one in enumerate((text or "").split("\n")):
            norm[doc, no] = " ".join(re.sub("[^a-z0-9]+", " ", one.lower()).split())
    different = sorted({n for n in norm.values() if n})
    groups = brute.Groups(len(different))
    for i, a in enumerate(different):
        for j in range(i):
            b = different[j]
            if brute.distance(a, b) <= 0.2 * max(len(a), len(b)):
                groups.join(i, j)
    seen, kept = set(), defaultdict(list)
    for (doc, no), n in sorted(norm.items(), key=lambda kv: (kv[0][0] is not None, kv[0][0] or 0, kv[0][1])):
        g = groups.find(different.index(n)) if n else None
        if g is None or g not in seen:
            kept[doc].append(no)
        seen.add(g)
    assert found == Counter((d, len((t or "").split("\n")), len(kept[d]), tuple(kept[d])) for d, t in texts)


def test_lines_of_many_words_are_printed(spark, rows):
    from seasonlab.llm.lines import fuzzy_lines

    texts = [(1, " ".join(f"w{i}" for i in range(100_000))), (2, "same " * 100_000), (3, "same " * 100_000 + "\nend")]
    found = Counter((r.doc_id, r.n_lines, tuple(r.kept)) for r in fuzzy_lines(rows(texts, "doc_id long, text string")).collect())
    assert found == Counter([(1, 1, (0,)), (2, 1, (0,)), (3, 2, (1,))])


def test_near_lines_are_found_by_edit_similarity_alone(spark, rows):
    """Every line and a copy with one letter more, one word in ten or in five replaced, in documents of their own."""
    import random

    from seasonlab.llm.lines import fuzzy_lines

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    texts, linked = [], []
    for k, n in enumerate([1, 2, 6, 10, 20, 34, 60] * 30):
        own = [word() for _ in range(n)]
        other = list(own)
        if k % 3 and n >= 10:
            for at in rng.sample(range(n), n // 10 if k % 3 == 1 else n // 5):
                other[at] = word()
        else:
            other[rng.randrange(n)] += "e"
        texts += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(other))]
        linked.append(brute.distance(texts[-2][1], texts[-1][1]) <= 0.2 * max(len(t) for _, t in texts[-2:]))
    kept = {r.doc_id: r.n_kept for r in fuzzy_lines(rows(texts, "doc_id long, text string")).collect()}
    found = [kept[2 * k + 1] == 0 for k in range(len(linked))]
    assert not any(f and not w for f, w in zip(found, linked))
    assert sum(found) >= 0.97 * sum(linked) > 180


def test_keys_of_a_single_line_are_not_kept(spark, rows, monkeypatch):
    """Of lines unlike each other and one pair of like ones, the pair's keys alone are compared again."""
    import random

    from seasonlab.llm import lines

    rng = random.Random(3)
    texts = [(k, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(20))) for k in range(40)]
    texts.append((40, texts[0][1] + "s"))
    tables, stored = {}, lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, name: tables.setdefault(name, stored(df, name)))
    kept = {r.doc_id: r.n_kept for r in lines.fuzzy_lines(rows(texts, "doc_id long, text string")).collect()}
    assert kept == {k: int(k < 40) for k in range(41)}
    shared = tables["shared-keys"]
    assert shared.groupBy("key").count().where("count < 2").isEmpty() and shared.select("line").distinct().count() == 2


def test_unlike_short_lines_are_not_compared(spark, rows, monkeypatch):
    """Short lines that share a beginning, and so keys, are told apart by their letters before their texts are joined."""
    from seasonlab.llm import lines

    ends = ["".join(a + b for b in "qzxjvkwy") + a * 12 for a in "abcdefghilmnoprstu"]
    texts = [(k, f"the same {end}") for k, end in enumerate(ends)] + [(90, f"the same {ends[0]}s"), (91, f"the sane {ends[3]}")]
    compared, alike = [], lines.alike
    monkeypatch.setattr(lines, "alike", lambda pairs, kept: compared.append(pairs.select("a", "b").collect()) or alike(pairs, kept))
    kept = {r.doc_id: r.n_kept for r in lines.fuzzy_lines(rows(texts, "doc_id long, text string")).collect()}
    assert kept == {k: int(k < 90) for k, _ in texts}
    assert 2 <= sum(map(len, compared)) < 20


def test_letters_rule_out_no_line_that_can_link(spark, rows):
    """Random edits of short lines, as many as similarity allows, and the bound by letters with them."""
    import random

    from pyspark.sql import functions as F

    from seasonlab.llm import lines

    rng = random.Random(5)
    letters = "etaoinsrhqzé ß1"
    pairs = []
    for n in range(1, 60):
        x = [rng.choice(letters) for _ in range(n)]
        y = list(x)
        for _ in range(n // 5):
            at, what = rng.randrange(len(y)), rng.choice("sid")
            y[at : at + (what != "i")] = [rng.choice(letters)] if what != "d" else []
        pairs.append(("".join(x), "".join(y)))
    df = rows([(x, y) for x, y in pairs if 5 * brute.distance(x, y) <= max(len(x), len(y))], "x string, y string")
    side = lambda c, p: [F.length(c).alias(f"size{p}"), F.lit(0).cast("long").alias(f"print{p}"), *[w.alias(f"w{k}{p}") for k, w in enumerate(lines.letter_bag(c))]]
    found = df.select(*side("x", ""), *side("y", "_b")).select(lines.near().alias("near")).collect()
    assert len(found) > 40 and all(r.near for r in found)


def test_stretches_of_long_lines_are_those_of_the_whole_line(spark, rows):
    """Rows of stretches, cut out of pieces, give the least hashes and the print that one list of them gives."""
    import random

    from pyspark.sql import functions as F

    from seasonlab.llm import lines

    rng = random.Random(8)
    texts = [(k, "".join(rng.choice(letters) for _ in range(n))) for k, (n, letters) in enumerate([(6, "ab"), (37, "abc "), (38, "éab"), (63, "abcdef"), (64, "ß日a "), (500, "abcdefgh "), (5_000, "añ日bcdefgh ")])]
    df = rows(texts, "line long, norm string").withColumn("size", F.length("norm"))
    whole = df.withColumn("found", lines.hashes("norm", lines.GRAM)).withColumn("long", lines.least_hashes("found"))
    print_of = lambda long: reduce(lambda bits, m: bits | (m & 1) << ((m % 2**64) >> 58), long, 0)
    signed = lambda bits: bits - 2**64 if bits >= 2**63 else bits
    assert {(r.line, r.size, tuple(r.long), r.print) for r in lines.least_of_stretches(df).collect()} == {(r.line, r.size, tuple(r.long), signed(print_of(r.long))) for r in whole.collect()}


def test_joins_by_line_leave_texts_in_place(spark, rows, capsys):
    """Texts dealt by line are not shuffled when a join or a grouping by line reads them, and no name stays in the catalog."""
    from pyspark.sql import functions as F

    from seasonlab.llm import lines

    texts = lines.dealt(rows([(k, f"text {k}" * 9, 60) for k in range(50)], "line long, norm string, size int"), "line-texts", "line")
    assert texts.count() == 50 and not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_texts")]
    texts.hint("merge").join(texts.groupBy(F.col("line").alias("at")).count().hint("merge"), F.col("line") == F.col("at")).explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    lines.least_of_stretches(texts).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_normal_lines(spark, rows):
    from pyspark.sql import functions as F

    from seasonlab.llm.lines import normal

    lines = ["", " ", "--", "A  b", "-A!b-", "\tÉÀ ß\u00a0x\x00", "ΑΣ ΑΣ", "a\r", None]
    want = ["", "", "", "a b", "a b", "éà ß\u00a0x", "ας ας", "a", None]
    assert [r.n for r in rows([(x,) for x in lines], "x string").select(normal(F.col("x")).alias("n")).collect()] == want


def test_components_of_a_chain_and_a_star(spark, rows):
    from seasonlab.llm.graph import components

    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    found = dict(tuple(r) for r in components(rows(links, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def held(i) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(documents(sf, "doc_id, lang"))
    found = QUERIES["op10_language"](spark, sf).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in found)
    out = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out]
    assert sum(out) >= 0.95 * len(out) > 0


def test_language_of_odd_rows(spark, odd):
    texts = documents(odd)
    found = QUERIES["op10_language"](spark, odd).collect()
    lettered = Counter((i, any(c.isalpha() for c in t or "")) for i, t in texts)
    assert Counter((r.doc_id, r.lang_pred != "und") for r in found) == lettered
    assert {r.lang_pred for r in found} <= {"en", "fr", "und"}


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    found = QUERIES["op4_toxicity"](spark, sf).collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    out = [(r.predicted, toxic[r.doc_id]) for r in found if r.held_out and r.doc_id in toxic]
    assert sum(p == t for p, t in out) >= 0.9 * len(out)


def test_labels_of_held_out_rows_are_not_learnt(spark, odd):
    """Other labels on held-out rows change no score."""
    from pyspark.sql import functions as F

    from seasonlab.llm.common import held_out
    from seasonlab.llm.toxicity import toxicity

    docs, labels = (spark.read.parquet(f"{odd}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows_of(toxicity(docs, labels)) == rows_of(toxicity(docs, turned))


def test_pages(spark, odd):
    found = rows_of(QUERIES["op5_html_field"](spark, odd))
    text = "Head\nSome text, with words. And more & more."
    assert found == Counter({(1, "u1", text, len(text)): 2, (2, None, "", 0): 1, (None, "u3", "", 0): 1})


def test_pages_equal_the_article(spark):
    import html
    import re

    sf = "/root/testdata/sf0.001"
    found = {r.page_id: r.text for r in QUERIES["op5_html_field"](spark, sf).collect()}
    for page, source in duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall():
        inside = re.search("<article>(.*)</article>", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inside.replace("<b>", "").replace("</b>", ""))]
        assert found[page] == "\n".join(p for p in parts if p)


def test_pages_learn_from_the_few_that_are_labelled(spark, rows):
    """One page in forty tells its parts, fewer than any sample of all pages would hold."""
    from seasonlab.llm.pages import learn

    page = "<nav><a>Home</a></nav><{0}><p>Some text, with words.</p></{0}><footer>End</footer>"
    data = [(i, page.format("article" if i % 40 == 0 else "div")) for i in range(200)]
    data += [(None, None), (1_000, None), (1_001, "<!-- <article> --><p>x</p>")]
    pages = rows(data, "page_id long, html string")
    few = learn(pages, rows=5)
    assert few.weights.any() and (few.weights == learn(pages.where("page_id % 40 = 0 AND page_id < 1000"), rows=5).weights).all()


def test_pages_without_labels_keep_their_text(spark, rows):
    from seasonlab.llm.pages import extract_pages

    pages = rows([(1, "u", "<div>One.</div><div>Two.</div>"), (2, "u", None)], "page_id long, url string, html string")
    assert rows_of(extract_pages(pages)) == Counter({(1, "u", "One.\nTwo.", 9): 1, (2, "u", "", 0): 1})


def test_one_of_each_group_stays_whatever_ids_rows_share(spark, rows):
    from seasonlab.llm.jaccard import keep_one

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    data = [(1, a), (1, b), (1, ""), (2, b + " end"), (2, c), (None, d), (None, d), (None, d + " end"), (3, None)]
    found = rows_of(keep_one(rows(data, "doc_id long, text string")))
    by_text = {t for _, t in found}
    assert {(1, a), (1, b), (1, ""), (2, c), (3, None)} <= set(found) and len(found) == 6
    assert len(by_text & {d, d + " end"}) == 1 and (2, b + " end") not in found


def test_blocks_of_broken_markup():
    from seasonlab.llm.pages import blocks_of

    page = "a<p>one <b>two<p>three<!-- x --><br>four<script>var p='</p>'</script><ul><li>x<li>y</ul></div>z &lt;b&gt;<p>5 < 6 &nbsp;&#233;<textarea"
    assert [b.text for b in blocks_of(page)] == ["a", "one two", "three four", "x", "y", "z <b>", "5 < 6 é<textarea"]
    assert blocks_of("") == [] and [b.tags[-1] for b in blocks_of("<ul><li>x<li>y</ul>")] == ["li", "li"]


def test_pipeline_stages_keep_and_drop(spark):
    """Each stage against a plain version of its own input."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near", "benchmark", "mixing", "sharding"]
    out = stages["language"](spark, docs, sf)
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = stages["near"](spark, out, sf)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, n, c in brute.near([(r.doc_id, r.text) for r in out.collect()]) if d == c}
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    clean = stages["benchmark"](spark, kept, sf)
    want = {r[0] for r in brute.contaminated([(r.doc_id, r.text) for r in kept.collect()], items) if not r[-1]}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want
    mixed = stages["mixing"](spark, clean, sf)
    assert mixed.columns == docs.columns and max(Counter(r.doc_id for r in mixed.collect()).values()) == 2
    shards = stages["sharding"](spark, mixed, sf)
    assert Counter(r.doc_id for r in shards.collect()) == Counter(r.doc_id for r in mixed.collect())


def test_pipeline_stages_on_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, odd)
        assert name == "sharding" or out.columns == docs.columns
        out.collect()
