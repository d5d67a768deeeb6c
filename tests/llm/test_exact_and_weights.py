"""Importance resampling (11), whitening (12) and exact dedup (13) against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.llm import exact, importance, queries, whitening

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans(exact.UPPER, exact.LOWER)


def key(row):
    return str(tuple(row))


def equal_to_sql(spark, duck, data_dir, name):
    found = queries.QUERIES[name](spark, data_dir).toArrow()
    wanted = duck.sql(queries.ORACLE_SQL[name]).to_arrow_table()
    columns = sorted(found.column_names)
    assert columns == sorted(wanted.column_names)
    rows = lambda t: sorted(str([r[c] for c in columns]) for r in t.to_pylist())
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_exact_dedup"])
def test_queries_equal_their_sql(spark, duck, data_dir, name):
    equal_to_sql(spark, duck, data_dir, name)


# --- exact dedup ----------------------------------------------------------


def plain_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOW)].append(r[0])
    out = []
    for text, ids in groups.items():
        best = max(ids, key=lambda i: -(1 << 70) if i is None else i)
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for i in ids:
            out.append((i, best, len(ids), i == best and left > 0, sha))
            left -= i == best
    return sorted(map(key, out))


@pytest.mark.parametrize("limits", [{}, {"filter_rows": 7}, {"hot_rows": 1}, {"filter_rows": 20, "hot_rows": 2}])
def test_exact_dedup_equals_brute_force(spark, docs, corpus, limits):
    found = exact.verdicts(docs, **limits)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(key, found.collect())) == plain_groups(corpus)


def test_case_of_a_to_z_only_and_texts_of_any_length(spark):
    long = "Straße " * 400_000
    rows = [(1, "ABC é"), (2, "abc é"), (3, "abc É"), (4, long), (5, long.replace("S", "s")), (6, long + "x"), (7, " abc é"), (8, None), (9, "")]
    found = exact.verdicts(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(key, found.collect())) == plain_groups(rows)


def test_kept_rows_carry_columns_that_clash(spark, docs, corpus):
    extra = docs.withColumns({"keep_id": F.lit("own"), "_h": F.lit(1), "kept": F.lit(None).cast("int"), "c0": F.lit(2), "_row": F.lit(3)})
    kept = exact.deduplicated(extra)
    assert kept.columns == extra.columns and kept.dtypes == extra.dtypes
    rows = kept.collect()
    assert {(r["keep_id"], r["_h"], r["kept"], r["c0"], r["_row"]) for r in rows} == {("own", 1, None, 2, 3)}
    assert len(rows) == len({(r[1] or "").translate(LOW) for r in corpus})
    marked = exact.mark(extra)
    assert len(marked.columns) == len(set(marked.columns))


def test_exact_dedup_of_nothing(spark, no_docs):
    assert exact.verdicts(no_docs).collect() == [] and exact.deduplicated(no_docs).collect() == []


def test_hot_copies_with_and_without_ids(spark):
    rows = spark.range(3000, numPartitions=6).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") < 1500, F.lit("Hot text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    found = exact.verdicts(rows, hot_rows=100).cache()
    assert found.count() == 3000 and found.where("kept").count() == 1501
    hot = found.where("group_size > 1")
    assert hot.count() == 1500 and hot.select("keep_id").distinct().collect()[0][0] == 1499
    none = exact.verdicts(rows.withColumn("doc_id", F.lit(None).cast("long")), hot_rows=100)
    assert none.where("kept").count() == 1501


def test_only_possibly_repeated_rows_meet(spark):
    """Nearly all single rows fail the filter, and no repeated row does, wherever its copies lie."""
    rows = spark.range(20_000, numPartitions=5).select((F.xxhash64("id").bitwiseAND(F.lit((1 << 60) - 1))).alias("_h"))
    copies = rows.limit(100).repartition(1)
    tested, count = exact._tested(rows.unionByName(copies), exact.FILTER_ROWS)
    found = tested.groupBy("_h").agg(F.count(F.lit(1)).alias("n"), F.max("_possible").alias("yes"), F.min("_possible").alias("all"))
    assert count == 20_100
    assert found.where("n > 1 and not all").count() == 0
    assert found.where("n = 1 and yes").count() < 60


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 60) - 1), max_size=30), min_size=1, max_size=4), st.integers(1, 6))
def test_planes_miss_no_repeat(tasks, words):
    tasks = [t + tasks[0][:2] for t in tasks]
    once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for hashes in tasks:
        own = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        exact._set(*own, exact._places(np.array(hashes, np.int64), words))
        twice |= own[1] | (once & own[0])
        once |= own[0]
    counts = Counter(h for t in tasks for h in t)
    assert np.all(exact._holds(twice, exact._places(np.array([h for h, n in counts.items() if n > 1], np.int64), words)))


# --- whitening ------------------------------------------------------------


def plain_whitening(rows, most):
    """Usable rows, n and their exact deviations, and the covariance's eigenvalues and components."""
    width = max((len(v) for _, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)), default=0)
    used = [(i, v) for i, v in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * Fraction(float(c))) + 100_000 for c in v] for _, v in used]
    n = len(x)
    sums = [sum(r[k] for r in x) for k in range(width)]
    deviations = [sum((n * r[k] - sums[k]) ** 2 for k in range(width)) for r in x]
    covariance = [[Fraction(sum((n * r[a] - sums[a]) * (n * r[b] - sums[b]) for r in x), n**3) for b in range(width)] for a in range(width)]
    values, vectors = np.linalg.eigh(np.array(covariance, np.float64)) if n else (np.zeros(0), np.zeros((0, 0)))
    centred = np.array([[float(Fraction(n * r[k] - sums[k], n)) for k in range(width)] for r in x], np.float64)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return [i for i, _ in used], deviations, values, (centred @ vectors) / np.sqrt(values) if n else None, float(sum(covariance[a][a] for a in range(width)))


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12])
def test_whitening_equals_brute_force(spark, scale):
    dice = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in dice.normal(0, [1, 2, 3, 0.5, 0.1], 5) * scale]) for i in range(80)]
    rows += [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [1.0]), (105, []), rows[0], (None, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ids, deviations, values, whitened, trace = plain_whitening(rows, 3)
    found, told = whitening.whiten(df, most=3)
    got = found.collect()
    assert told["n"] == 82 == len(got)
    want = sorted((str(i), d) for i, d in zip(ids, deviations, strict=True))
    assert sorted((str(r.vec_id), int(r.deviation)) for r in got) == want
    assert np.allclose(told["explained"], values / trace, rtol=1e-9)
    assert told["identity_error"] < 1e-9
    by_id = {str(i): w for i, w in zip(ids, whitened, strict=True)}
    own = np.array([r.whitened for r in got])
    other = np.array([by_id[str(r.vec_id)] for r in got])
    signs = np.sign((own * other).sum(axis=0))
    assert np.allclose(own, other * signs, rtol=1e-7, atol=1e-7)


def test_whitening_query_shape(spark, data_dir):
    found = queries.op12_whiten(spark, data_dir).cache()
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n = spark.read.parquet(f"{data_dir}/embeddings.parquet").count()
    assert found.count() == 8 * n and found.select("n").distinct().collect() == [(n,)]
    explained = [r[0] for r in found.select("component", "explained").distinct().orderBy("component").select("explained").collect()]
    assert len(explained) == 8 and explained == sorted(explained, reverse=True)
    assert found.agg(F.max("identity_error")).first()[0] < 1e-9


def test_whitening_does_not_hang_on_partitions(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/embeddings.parquet")
    a, b = (whitening.whiten(table.repartition(k))[1] for k in (1, 7))
    assert np.array_equal(a["values"], b["values"]) and a["n"] == b["n"]


def test_whitening_of_what_does_not_vary(spark):
    schema = "vec_id long, embedding array<float>, whitened int, c0 string"
    flat = spark.createDataFrame([(i, [1.0, float(i), 2.0 * i], 5, "own") for i in range(6)], schema)
    found, told = whitening.whiten(flat)
    rows = found.collect()
    assert all(r.whitened[0] is not None and r.whitened[1] is None and r.whitened[2] is None and r.c0 == "own" for r in rows)
    assert abs(told["explained"][0] - 1) < 1e-9 and told["identity_error"] < 1e-9
    one = whitening.verdicts(flat.limit(1)).collect()
    assert len(one) == 3 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.identity_error is None for r in one)
    assert whitening.verdicts(flat.limit(0)).collect() == []
    assert whitening.verdicts(flat.select("vec_id", F.lit(None).cast("array<float>").alias("embedding"))).collect() == []


def test_huge_entries_have_a_defined_result(spark):
    df = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 3.0])], "vec_id long, embedding array<double>")
    found = whitening.verdicts(df).collect()
    assert len(found) == 6 and all(r.deviation is None for r in found if r.vec_id < 3)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 62), 1 << 62), min_size=3, max_size=3), max_size=12), st.integers(0, 60))
def test_products_are_exact(rows, shift):
    y = np.array([[v >> shift for v in r] for r in rows], np.int64).reshape(-1, 3)
    found = whitening.exact_products(y)
    assert [[int(v) for v in r] for r in found] == [[sum(int(r[a]) * int(r[b]) for r in y) for b in range(3)] for a in range(3)]


# --- importance resampling ------------------------------------------------


def plain_features(text, runs):
    words = WORD.findall((text or "").translate(LOW))
    return Counter(" ".join(words[i : i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)), len(words)


def plain_scores(rows, items, runs=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = [plain_features(r[1], runs) for r in rows]
    s, t = Counter(), Counter()
    for found, _ in own:
        for f, c in found.items():
            s[bucket(f)] += c
    for text in items:
        for f, c in plain_features(text, runs)[0].items():
            t[bucket(f)] += c
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
    out = []
    for r, (found, words) in zip(rows, own, strict=True):
        n = sum(found.values())
        weight = sum(c * gain(bucket(f)) for f, c in found.items()) // n if n else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((o for o in out if o[4] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("runs, percent, small", [(1, 10, False), (1, 50, True), (3, 30, True)])
def test_resampling_equals_brute_force(spark, docs, corpus, monkeypatch, runs, percent, small):
    if small:  # pieces, batches, parts and the memory of hashes all end in the midst of the corpus
        for name, value in {"PIECE": 50, "BATCH_ROWS": 5, "PART_BATCHES": 2, "REMEMBERED": 40}.items():
            monkeypatch.setattr(importance, name, value)
    items = ["The river and a stone", None, "", corpus[4][1], "ümlaut 日本語 text"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    found = importance.resample(docs, target, runs=runs, percent=percent).collect()
    every, drawn = plain_scores(corpus, items, runs, percent=percent)
    assert sorted(key((r.doc_id, r.n_features, r.weight, r.score)) for r in found) == sorted(key(o[:4]) for o in every)
    ranked = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(o[0], o[3]) for o in drawn]


def test_hot_ties_are_ranked_without_gaps(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.range(2000, numPartitions=5).select(F.when(F.col("id") >= 1200, F.col("id")).alias("doc_id"), F.lit(text).alias("text"))
    found = importance.resample(docs, spark.createDataFrame([(text,)], "text string"), percent=80).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 1601))
    scores = [r.score for r in sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])]
    assert scores == sorted(scores, reverse=True)


def test_resampling_of_nothing_and_towards_nothing(spark, docs, no_docs, corpus):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(no_docs, empty).collect() == []
    found = importance.resample(docs, empty).collect()
    every, drawn = plain_scores(corpus, [])
    assert sorted(key((r.doc_id, r.score)) for r in found) == sorted(key((o[0], o[3])) for o in every)
    assert sum(r["rank"] is not None for r in found) == len(drawn)


def test_drawn_rows_keep_their_columns(spark, docs, corpus):
    extra = docs.withColumns({"rank": F.lit("own"), "_id": F.lit(1), "batch": F.lit(2)})
    rows = importance.drawn(extra, docs.select("text"), percent=50)
    assert rows.columns == extra.columns
    ids = {o[0] for o in plain_scores(corpus, [r[1] for r in corpus], percent=50)[1]}
    assert sorted(str(r.doc_id) for r in rows.collect()) == sorted(str(r[0]) for r in corpus if r[0] in ids)


def test_a_bucket_of_every_document_is_dealt_to_parts(spark, monkeypatch):
    """Posting lists of one bucket lie in many groups, each of few batches."""
    monkeypatch.setattr(importance, "BATCH_ROWS", 10)
    docs = spark.range(400, numPartitions=4).select(F.col("id").alias("doc_id"), F.lit("the the the").alias("text"))
    lists = importance.postings(docs).where("range >= 0").select("batch")
    assert lists.count() == lists.distinct().count() == 40
