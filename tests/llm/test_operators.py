"""Decontamination (1), mixing (4), sharding (7), top-k (10) and the pipeline."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import decontaminate, language, mixing, queries, sharding, topk
from skyloom.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOW))


def plain_verdict(text, items):
    words = plain_words(text)
    hit, ids = set(), set()
    for item, other in items:
        own = plain_words(other)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                ids |= {str(item)} if item is not None else set()
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.fixture(scope="module")
def items(corpus):
    return [(10, corpus[-3][1]), (9, "THE, and-of thing!"), (2, None), (3, "..."), (4, "ümlaut 日本語 text"), (4, corpus[1][1]), (None, "river"), (100, " ".join(corpus[5][1].split()[:14]))]


@pytest.mark.parametrize("max_bytes", [decontaminate.AUTOMATON_BYTES, 200])
def test_decontamination_equals_brute_force(spark, docs, corpus, items, max_bytes):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.verdicts(decontaminate.scan(docs, bench, max_bytes=max_bytes)).collect()
    want = [(str(r[0]), *plain_verdict(r[1], items)) for r in corpus]
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found)
    assert got == sorted(want)
    clean = decontaminate.drop_contaminated(docs, bench, max_bytes=max_bytes)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(g[0] for g in got if not g[-1])


def test_size_of_the_benchmark_does_not_matter(spark, docs, corpus, items, monkeypatch):
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [corpus[5][1], "quite clean", corpus[1][1]]
    more = docs.unionByName(spark.createDataFrame([(i, t, None, None, None) for i in (None, 7777) for t in texts], docs.schema))
    monkeypatch.setattr(decontaminate, "HELD_BYTES", 2000)
    found = [sorted(repr(r) for r in decontaminate.scan(more, bench, max_bytes=b).collect()) for b in (1 << 20, 200)]
    assert len(found[0]) == len(corpus) + 6 and found[0] == found[1]
    clean = [sorted(repr(r) for r in decontaminate.drop_contaminated(more, bench, max_bytes=b).collect()) for b in (1 << 20, 200)]
    assert clean[0] == clean[1] and sum("quite clean" in r for r in clean[1]) == 2 and not any("doc_id=7777" in r and texts[0] in r for r in clean[1])


def test_offsets_lead_to_the_original():
    text = "Quoth: «Ünder, the—Green» tree, and more of it."
    machine = decontaminate.Automaton([("1", "the GREEN tree".encode()), ("2", b"of it")])
    ((words, hit, ids, spans),) = decontaminate.scan_texts([text.encode()], [machine])
    assert plain_words(text)[hit[0]] in text.lower() and ids == ["2"] and words == len(plain_words(text))
    assert [text.encode()[s["start"] : s["end"]].decode() for s in spans] == ["of it"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), max_size=8), st.lists(st.lists(st.integers(0, 4), max_size=40), max_size=5), st.integers(1, 6), st.sampled_from([1, 3, 256]))
def test_automaton_finds_every_window(items, texts, n, lane):
    join = lambda x: " ".join(f"w{i}" for i in x)
    machine = decontaminate.Automaton([(str(i), join(t).encode()) for i, t in enumerate(items)], n)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontaminate, "LANE", lane)
        found = decontaminate.scan_texts([join(t).encode() for t in texts], [machine])
    for (size, hit, ids, _), text in zip(found, texts, strict=True):
        want, own = set(), set()
        for i, item in enumerate(items):
            k = min(n, len(item))
            for a in range(len(text) - k + 1 if k else 0):
                if any(text[a : a + k] == item[b : b + k] for b in range(len(item) - k + 1)):
                    want |= set(range(a, a + k))
                    own.add(str(i))
        assert (size, hit, ids) == (len(text), sorted(want), sorted(own))


def test_decontamination_edges(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.verdicts(decontaminate.scan(docs, none)).collect()} == {0}
    assert decontaminate.scan(no_docs, none).collect() == [] and decontaminate.drop_contaminated(docs, none).count() == docs.count()
    clash = docs.withColumns({"n_words": F.lit("x"), "items": F.lit(1)})
    assert decontaminate.scan(clash, none).count() == docs.count()


# --- mixing -------------------------------------------------------------------


def test_copies_follow_the_rates(spark):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"))
    got = mixing.counted(rows).groupBy("source").agg(F.avg("mix_count").alias("mean"), F.var_samp("mix_count").alias("var"), F.first("mix_rate").alias("rate"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.rate * r.n for r in got) == pytest.approx(30_000)
    for r in got:
        assert abs(r["mean"] - r.rate) < 5 * (r.rate / r.n) ** 0.5 and r["var"] == pytest.approx(r.rate, rel=0.15)


def test_given_weights_and_large_means(spark):
    rows = spark.createDataFrame([(i, "a" if i < 40 else None) for i in range(400)], "doc_id long, source string")
    got = {r.source: r for r in mixing.counted(rows, {"a": 9.0}).groupBy("source").agg(F.avg("mix_count").alias("mean"), F.first("mix_rate").alias("rate")).collect()}
    assert got["a"].rate == pytest.approx(10) and got[None].rate == 0 and got[None]["mean"] == 0
    big = mixing.counted(spark.createDataFrame([(i, "a" if i < 20 else "b") for i in range(8000)], "doc_id long, source string"), {"a": 1.0})
    mean = big.where("source = 'a'").agg(F.avg("mix_count")).first()[0]
    assert mean == pytest.approx(400, rel=0.05)


def test_mixing_edges(docs, no_docs):
    mixed = mixing.mix(docs.withColumn("mix_key", F.lit("x")))
    counts = {str(r.doc_id): r.mix_count for r in mixing.counted(docs).collect()}
    got = {}
    for r in mixed.collect():
        got.setdefault(str(r.doc_id), []).append(r.mix_copy)
    assert all(max(v) == counts[k] for k, v in got.items()) and set(got) == {k for k, v in counts.items() if v}
    assert mixing.mix(no_docs).collect() == []
    own = docs.withColumns({"mix_key": F.lit("x"), "mix_source": F.lit("y"), "mix_cdf": F.lit("z"), "mix_copy": F.lit(0)})
    plain = mixing.mix(own, marks=False)
    assert plain.columns == own.columns and {(r.mix_key, r.mix_source, r.mix_cdf, r.mix_copy) for r in plain.collect()} == {("x", "y", "z", 0)}
    assert plain.count() == mixed.count() and mixing.mix(own).where("mix_source = 'y' and mix_copy > 0").count() == mixed.count()
    keys = [r.mix_key for r in mixed.collect()]
    assert keys != sorted(keys) or len(keys) < 2 or mixed.rdd.getNumPartitions() == 1


def test_many_sources_are_joined_by_shuffle(docs, monkeypatch):
    want = sorted(map(str, mixing.counted(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(map(str, mixing.counted(docs).collect())) == want


# --- sharding -----------------------------------------------------------------


@pytest.mark.parametrize(("shards", "sample"), [(24, 64), (5, 3), (1, 8)])
def test_shards_equal_brute_force(docs, corpus, shards, sample):
    got = sharding.shard(docs, shards, sample).collect()
    total = sum(r.shard_bytes for r in got)
    assert sorted((str(r.doc_id), r.shard_bytes, r.shard_crc) for r in got) == sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in corpus)
    digest = lambda t: -1 if t is None else int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    key = lambda r: (digest(r.text), sharding._NULL if r.doc_id is None else r.doc_id)
    below, order = 0, sorted(got, key=lambda r: (key(r), r.shard, r.shard_slot))
    for r in order:
        assert r.shard == below * shards // total
        below += r.shard_bytes
    for s in {r.shard for r in got}:
        assert sorted(r.shard_slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        mine = [r for r in order if r.shard == s]
        assert [key(r) for r in sorted(mine, key=lambda r: r.shard_slot)] == [key(r) for r in mine]


def test_many_copies_of_one_text_are_split(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    fine = sharding._shard(rows, 24, 64, 20).groupBy("shard_range").count().agg(F.max("count")).first()[0]
    assert fine <= 60  # no range holds a shard's copies at once
    whole, cut = (sorted(map(tuple, sharding.shard(rows, range_rows=n).select("doc_id", "shard", "shard_slot").collect())) for n in (200_000, 20))
    assert whole == cut
    sizes = sharding.shard(rows).groupBy("shard").agg(F.sum("shard_bytes").alias("b")).collect()
    assert len(sizes) == 24 and max(r.b for r in sizes) - min(r.b for r in sizes) < 40


@pytest.mark.parametrize("ids", ["null", "one"])
def test_rows_that_are_alike_are_dealt_to_all_shards(spark, ids):
    """Half of all rows have one text and one id, or none: the law holds, and no task numbers all of them."""
    same = F.lit(None if ids == "null" else 5).cast("long")
    rows = spark.range(4000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, same).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, "the same text").otherwise(F.col("id").cast("string")).alias("text"), F.col("id").alias("own"))
    got = sharding.shard(rows, range_rows=100).collect()
    assert sorted(r.own for r in got) == list(range(4000))
    total = sum(r.shard_bytes for r in got)
    for s in range(24):
        mine = [r for r in got if r.shard == s]
        assert abs(sum(r.shard_bytes for r in mine) - total / 24) < 22 and sorted(r.shard_slot for r in mine) == list(range(len(mine)))
    sizes = sharding._placed(rows, 24, 64, 100)[0].groupBy("shard_range", "shard_part").count().agg(F.max("count")).first()[0]
    assert sizes <= 260  # of 2000 rows that are alike, those of one partition


def test_only_rows_that_are_alike(spark):
    one = spark.createDataFrame([(7, "x")] * 500 + [(None, None)] * 100, "doc_id long, text string").repartition(5)
    got = sharding.shard(one).collect()
    counts = [sum(r.shard == s for r in got) for s in range(24)]
    sizes = [sum(r.shard_bytes for r in got if r.shard == s) for s in range(24)]
    assert sum(counts) == 600 and max(sizes) - min(sizes) < 18


def test_largest_ids_are_sharded(spark):
    last = (1 << 63) - 1
    rows = spark.createDataFrame([(last, "x")] * 200 + [(last - 1, "x")] * 3 + [(-last - 1, "y"), (None, None)], "doc_id long, text string")
    got = sharding.shard(rows, sample=8).collect()
    sizes = [sum(r.shard_bytes for r in got if r.shard == s) for s in range(24)]
    assert len(got) == 205 and max(sizes) - min(sizes) < 18


def test_sharding_keeps_other_columns(docs):
    clash = docs.withColumns({"shard_hash": F.lit("a"), "shard_base": F.lit("b"), "c0": F.lit("c"), "shard_slot": F.lit("d")})
    got = sharding.shard(clash).collect()
    assert {(r.shard_hash, r.shard_base, r.c0) for r in got} == {("a", "b", "c")} and {type(r.shard_slot) for r in got} == {int}


def test_sharding_edges(no_docs, docs):
    assert sharding.shard(no_docs).collect() == []
    assert sharding.shard(docs.withColumn("shard", F.lit("x"))).count() == docs.count()


# --- top-k --------------------------------------------------------------------


@pytest.mark.parametrize(("rows", "queries_"), [(1 << 15, 1 << 10), (37, 3)])
def test_top_k_equals_brute_force(spark, rows, queries_):
    dice = np.random.default_rng(2)
    vectors = [(int(i) * 5, (dice.normal(size=40) + (1 if i % 3 else 4 * dice.normal())).tolist()) for i in range(200)]
    vectors += [(150, [-x for x in vectors[30][1]]), (155, [1.0] * 40)]  # other vectors of known ids
    vectors += [(1001, vectors[3][1]), (1002, vectors[3][1]), (1050, vectors[3][1]), (2000, None), (None, [1.0]), (2050, [1.0]), (2100, [None, 3.0]), vectors[10]]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<double>, distance string")
    got = sorted((r.query_id, r["rank"], r.neighbour_id, r.distance) for r in topk.top_k(df, k=4, shard_rows=rows, block_queries=queries_).collect())
    codes = {}
    for i, v in vectors:
        if i is not None and v is not None:
            code = sum(1 << b for b, x in enumerate(v) if x is not None and x > 0)
            codes[i] = min(codes.get(i, code), code, key=lambda c: c.to_bytes(8, "little"))
    want = []
    for q in sorted(codes):
        if q % 50 == 0:
            near = sorted(((codes[q] ^ c).bit_count(), i) for i, c in codes.items() if i != q)[:4]
            want += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    assert got == want


def test_each_shard_is_indexed_once_and_only_queries_are_copied(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 50)
    dice = np.random.default_rng(3)
    vectors = spark.createDataFrame([(i, dice.normal(size=32).tolist()) for i in range(400)], "vec_id long, embedding array<double>").repartition(3)
    plan = topk.top_k(vectors, every=10, block_queries=7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Join" not in plan
    few, many = (sorted(map(tuple, topk.top_k(vectors, every=10, shard_rows=n, block_queries=7).collect())) for n in (1 << 18, 30))
    assert few == many and len(few) == 400


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(50, [1.0])], schema)).collect() == []
    two = topk.top_k(spark.createDataFrame([(50, [1.0]), (51, [-1.0])], schema)).collect()
    assert [(r.query_id, r.neighbour_id, r.distance) for r in two] == [(50, 51, 1)]


# --- registered queries and the pipeline ----------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, duck, data_dir, name):
    clean = lambda rows, names: sorted(repr(tuple(r[names.index(c)] for c in sorted(names))) for r in rows)
    found = queries.QUERIES[name](spark, data_dir)
    want = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert clean([tuple(r) for r in found.collect()], found.columns) == clean(want.fetchall(), names)


@pytest.mark.parametrize("name", ["op1_decontaminate", "op5_language_id", "op6_suffix_trees", "op7_histogram_shards", "op8_simhash", "op9_suffix_arrays", "op2_kneser_ney", "op3_masked_lm"])
def test_queries_cover_all_documents(spark, data_dir, name):
    found = queries.QUERIES[name](spark, data_dir).select("doc_id").collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in table(spark, data_dir, "documents").select("doc_id").collect())


def plain_poisson(doc_id, rate):
    """Copies of a document: the inverse of the Poisson distribution at a hashed number."""
    u = int(hashlib.md5(f"{mixing.SEED}:0:{doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
    n, p, total = 0, math.exp(-rate), math.exp(-rate)
    while u >= total:
        n += 1
        p *= rate / n
        total += p
    return n


def test_pipeline_equals_its_stages_by_brute_force(spark, data_dir):
    from tests.llm.test_models import plain_language
    from tests.llm.test_near_duplicates import plain_components, plain_fingerprint

    found = corpus_pipeline.run(spark, data_dir).collect()
    docs = table(spark, data_dir, "documents").orderBy("doc_id").collect()
    model = language.fit(table(spark, data_dir, "documents"))
    labels = [plain_language(r.text, model) for r in docs]
    left = [r for r, (label, score) in zip(docs, labels, strict=True) if label != "und" and score >= 0.5]
    least = plain_components([plain_fingerprint(r.text) for r in left], [r.doc_id for r in left])
    left = [r for r, c in zip(left, least, strict=True) if r.doc_id == c]
    items = [(r.item_id, r.text) for r in table(spark, data_dir, "benchmark").collect()]
    left = [r for r in left if not plain_verdict(r.text, items)[-1]]
    sources = Counter(r.source for r in left)
    weights = {s: n**mixing.TEMPERATURE for s, n in sources.items()}
    counts = {r.doc_id: plain_poisson(r.doc_id, weights[r.source] * len(left) / sum(weights.values()) / sources[r.source]) for r in left}
    want = sorted(i for i, n in counts.items() for _ in range(n))
    assert sorted(r.doc_id for r in found) == want
    assert {r.doc_id: r.text for r in found} == {r.doc_id: r.text for r in left if counts[r.doc_id]}
    order = sorted(found, key=lambda r: (int(hashlib.md5(r.text.encode()).hexdigest()[:15], 16), r.doc_id, r.shard, r.shard_slot))
    below, total = 0, sum(r.shard_bytes for r in found)
    for r in order:
        assert r.shard == below * sharding.SHARDS // total and r.shard_bytes == len(r.text.encode()) + 8
        below += r.shard_bytes
    for s in {r.shard for r in found}:
        assert sorted(r.shard_slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_pipeline_keeps_clashing_columns_and_leaves_one_folder(spark, docs, tmp_path):
    extra = {"_key": F.lit("a"), "_n": F.lit("b"), "mix_key": F.lit("c"), "mix_source": F.lit("d"), "shard_hash": F.lit("e"), "fp": F.lit("f"), "c0": F.lit("g"), "_stays": F.lit("h")}
    docs.withColumns(extra).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() and found.select(*extra).distinct().collect() == [tuple("abcdefgh")]
    (folder,) = {f.rsplit("/", 2)[0] for f in found.inputFiles()}
    assert os.listdir(folder.removeprefix("file://").removeprefix("file:")) == ["4-histogram_sharding"]


def test_pipeline_on_awkward_rows(spark, docs, no_docs, tmp_path):
    bench = spark.createDataFrame([(1, None)], "item_id long, text string")
    for k, rows in enumerate((docs, no_docs)):
        folder = str(tmp_path / str(k))
        rows.write.parquet(f"{folder}/documents.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert set(docs.columns) <= set(found.columns) and (found.count() > 0) == (k == 0)


def test_random_texts_round_trip_through_words():
    dice = random.Random(3)
    for _ in range(200):
        text = "".join(chr(dice.choice([*range(1, 0x180), 0x2028, 0x1F600, 0x20])) for _ in range(30))
        assert [w.decode() for w in decontaminate.words_of(text.encode())] == plain_words(text)
