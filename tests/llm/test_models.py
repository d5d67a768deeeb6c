"""Language ID (5), Kneser-Ney (2) and masked LM scoring (3)."""

import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyloom.llm import kneser_ney, language, lm_scoring
from skyloom.llm.common import table, unpack
from skyloom.llm.suffix_trees import word_hashes


# --- language ---------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    dice = np.random.default_rng(0)
    k, text = 3, np.array([0, 0, 0, 1, 2, 2])
    emission, move, start = dice.normal(size=(6, k)), dice.normal(size=(k, k)), dice.normal(size=k)
    p, moves, starts = language.forward_backward(emission.astype(np.float32), text, move, start, pairs=True)
    want, want_moves, want_starts = np.zeros((6, k)), np.zeros((k, k)), np.zeros(k)
    for t in range(3):
        own = np.flatnonzero(text == t)
        paths = [()]
        for _ in own:
            paths = [(*q, j) for q in paths for j in range(k)]
        weight = np.array([math.exp(start[q[0]] + sum(emission[i, j] for i, j in zip(own, q, strict=True)) + sum(move[a, b] for a, b in zip(q, q[1:], strict=False))) for q in paths])
        weight /= weight.sum()
        for q, w in zip(paths, weight, strict=True):
            want_starts[q[0]] += w
            for i, j in zip(own, q, strict=True):
                want[i, j] += w
            for a, b in zip(q, q[1:], strict=False):
                want_moves[a, b] += w
    assert np.allclose(p, want, atol=1e-5) and np.allclose(moves, want_moves, atol=1e-4) and np.allclose(starts, want_starts, atol=1e-4)


def plain_language(text, model):
    """Label and score of one text by log-space forward-backward over dictionaries of a word's byte n-grams."""
    low = text.lower().encode() if text and any(c.isalpha() for c in text) else b""
    words = [w for w in low.translate(language._KEEP).split(b" ") if w]
    if not words or not model.labels:
        return "und", 0.0
    emission = []
    for w in words:
        one = language.words_of([w])
        (row,) = model.lexicon_rows(one.code)
        padded = b" " + w + b" "
        total = model.lexical[row].astype(np.float64)
        for k in (2, 3, 4):
            for i in range(len(padded) - k + 1):
                h = (int.from_bytes(padded[i : i + k], "big") ^ (0x9E3779B9 * k % (1 << 32))) * 0x85EBCA6B % (1 << 32)
                h = ((h ^ (h >> 13)) * 0xC2B2AE35 % (1 << 32)) >> 16
                total = total + model.grams[h]
        emission.append(total)
    a, b = [model.start + emission[0]], [np.zeros(len(model.labels))]
    for e in emission[1:]:
        a.append(e + np.logaddexp.reduce(a[-1][:, None] + model.move, axis=0))
    for e in emission[:0:-1]:
        b.append(np.logaddexp.reduce(model.move + e + b[-1], axis=1))
    both = np.array(a) + np.array(b[::-1])
    share = np.exp(both - np.logaddexp.reduce(both, axis=1, keepdims=True)).sum(axis=0) / len(words)
    return model.labels[int(share.argmax())], float(share.max())


def test_identify_equals_brute_force(spark, docs, corpus, data_dir):
    model = language.fit(docs)
    got = defaultdict(list)
    for r in language.identify(docs, model).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    for doc, text, *_ in corpus:
        label, score = plain_language(text, model)
        assert any(g[0] == label and g[1] == pytest.approx(score, abs=2e-3) for g in got[doc])


@pytest.mark.parametrize("lane, at_once", [(1, 3), (4, 1), (7, 2), (64, 64)])
def test_lanes_equal_one_pass(lane, at_once):
    """The transfer products join lanes of a text to the probabilities of the whole."""
    dice = np.random.default_rng(lane)
    for n in (1, 5, 28, 65):
        emission = (3 * dice.normal(size=(n, 4))).astype(np.float32)
        model = language.Model(list("abcd"), np.zeros((1, 4)), np.zeros(0), np.zeros((1, 4)), (2 * dice.normal(size=(4, 4))).astype(np.float32), dice.normal(size=4).astype(np.float32))
        whole, _, _ = language.forward_backward(emission, np.zeros(n, int), model.move, model.start)
        assert language.long_share(emission, model, lane, at_once) == pytest.approx(whole.sum(axis=0), abs=1e-4)


def test_long_texts_equal_brute_force(docs, corpus, monkeypatch):
    model = language.fit(docs)
    for name, value in {"LONG_BYTES": 60, "LANE": 5, "LANES": 3, "FEATURE_BYTES": 50}.items():
        monkeypatch.setattr(language, name, value)
    labels, scores = language.predict([r[1] for r in corpus], model)
    for (_, text, *_), label, score in zip(corpus, labels, scores, strict=True):
        want, share = plain_language(text, model)
        assert label == want and score == pytest.approx(share, abs=2e-3)


def test_one_long_text_takes_no_longer_than_many_short_ones(docs, corpus):
    model = language.fit(docs)
    text = " ".join(r[1] for r in corpus if r[1]) + " "
    long = text * (4_000_000 // len(text))
    times = {}
    for name, texts in (("short", [text[:10_000]] * (len(long) // 10_000)), ("long", [long])) * 2:
        began = time.process_time()
        language.predict(texts, model)
        times[name] = time.process_time() - began
    assert times["long"] < 2.5 * times["short"]


def test_features_belong_to_their_words():
    alone = [language.words_of([w]) for w in (b"the", b"maison")]
    both = language.words_of([b"the, maison", b"", b"the"])
    assert both.text.tolist() == [0, 0, 2] and both.code[0] == both.code[2] == alone[0].code[0] and both.code[1] == alone[1].code[0]
    model = language.Model(["a", "b"], np.random.default_rng(1).normal(size=(language.BUCKETS + 1, 2)).astype(np.float32), np.zeros(0, np.uint64), np.zeros((1, 2), np.float32), np.zeros((2, 2)), np.zeros(2))
    model.grams[-1] = 0
    one = [model.emissions(w, np.zeros(1, int))[0] for w in alone]
    got = model.emissions(both, np.zeros(3, int))
    assert np.allclose(got, [one[0], one[1], one[0]], atol=1e-5)


def test_code_switching_is_labelled_by_word(spark, data_dir):
    docs = table(spark, data_dir, "documents")
    model = language.fit(docs)
    assert np.trace(model.move) > model.move.sum() - np.trace(model.move)  # languages persist
    texts = {r.lang: r.text for r in docs.where("lang in ('en', 'fr')").where(language.held_out()).orderBy(F.desc("n_chars")).limit(40).collect()}
    words = {k: v.split()[:40] for k, v in texts.items()}
    mixed = " ".join(words["en"] + words["fr"])
    labels = [max(p, key=p.get) for _, p in language.label_words(mixed, model)]
    half = len([w for w, _ in language.label_words(" ".join(words["en"]), model)])
    assert np.mean([x == "en" for x in labels[:half]]) > 0.9 and np.mean([x == "fr" for x in labels[half:]]) > 0.9


def test_held_out_accuracy(spark, data_dir):
    docs = table(spark, data_dir, "documents")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    assert np.mean([r.lang_pred == r.lang for r in found if r.held_out]) > 0.95


def test_language_edges(spark, docs, no_docs, corpus):
    got = {}
    for r in language.identify(docs).collect():
        got.setdefault(r.doc_id, r)
    for doc in (500, 501, 502, 503):
        assert (got[doc].lang_pred, got[doc].score) == ("und", 0.0)
    assert got[None].held_out is False and got[504].lang_pred == "en"
    assert language.identify(no_docs).collect() == [] and language.keep_identified(no_docs).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    kept = language.keep_identified(docs.withColumn("score", F.lit(1)))
    assert "score" in kept.columns and not {500, 501, 502, 503} & {r.doc_id for r in kept.collect()}


def test_pieces_do_not_matter(docs, monkeypatch):
    model = language.fit(docs)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    whole = language.predict(texts, model)
    monkeypatch.setattr(language, "PIECE_BYTES", 300)
    monkeypatch.setattr(language, "FEATURE_BYTES", 100)
    parts = language.predict(texts, model)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1], atol=1e-4)


# --- Kneser-Ney -------------------------------------------------------------


def plain_kneser_ney(texts, order):
    """log p of a text by dictionaries."""
    pad = b" " * (order - 1)
    counts = {order: Counter(bytes((pad + t)[i : i + order]) for t in texts for i in range(len(t)))}
    for m in range(order - 1, 1, -1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
    single = Counter(g[1:] for g in counts[2])
    taken = {m: kneser_ney.discounts(np.array([sum(c == j for c in counts[m].values()) for j in (1, 2, 3, 4)])) for m in counts}
    context = {m: defaultdict(list) for m in counts}
    for m, grams in counts.items():
        for g, c in grams.items():
            context[m][g[:-1]].append(c)
    total = sum(single.values())
    alone = kneser_ney.discounts(np.array([sum(c == j for c in single.values()) for j in (1, 2, 3, 4)]))

    def p(g):
        m = len(g)
        if m == 1:
            own = [single[g]] if single[g] else []
            return (sum(c - alone[min(c, 3) - 1] for c in own) + sum(alone[min(c, 3) - 1] for c in single.values()) / 256) / total if total else 1 / 256
        own = context[m][g[:-1]]
        below = p(g[1:])
        if not own:
            return below
        d = taken[m]
        c = counts[m][g]
        free = sum(d[min(x, 3) - 1] for x in own)
        return (max(c - (d[min(c, 3) - 1] if c else 0), 0) + free * below) / sum(own)

    return lambda t: sum(math.log(p((pad + t)[i : i + order])) for i in range(len(t)))


def test_orders_beyond_the_key_are_refused(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for order in (2, 8):
        with pytest.raises(ValueError, match="order"):
            kneser_ney.classify(docs, labels, order=order)


def test_many_short_texts_at_every_order(spark):
    texts = [f"text {i} of many" for i in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for order in (6, 7):
        models = kneser_ney.model_shards(docs.where("doc_id < 40"), order, shards=3)
        got = {r.doc_id: r.log_probability for r in kneser_ney.log_likelihoods(docs, models, order, shards=3).collect()}
        log = plain_kneser_ney([t.encode() for t in texts[:40]], order)
        assert len(got) == 700 and all(got[i] == pytest.approx(log(texts[i].encode()), rel=1e-6) for i in range(0, 700, 7))


@pytest.mark.parametrize("order", [3, 4, 5])
def test_probabilities_equal_plain_model(spark, docs, corpus, order):
    trusted = [(r[1] or "").encode() for r in corpus[:30]]
    models = kneser_ney.model_shards(docs.sparkSession.createDataFrame([(t.decode(),) for t in trusted], "text string"), order, shards=5)
    got = {r.doc_id: r for r in kneser_ney.log_likelihoods(docs, models, order, shards=5).collect()}
    log = plain_kneser_ney(trusted, order)
    seen = defaultdict(lambda: [0, 0.0])
    for doc, text, *_ in corpus:
        raw = (text or "").encode()
        seen[doc][0] += len(raw)
        seen[doc][1] += log(raw)
    for doc, (n, want) in seen.items():
        if n:
            assert got[doc].n_bytes == n and got[doc].log_probability == pytest.approx(want, rel=1e-6)
        else:
            assert doc not in got


def test_probabilities_sum_to_one(spark):
    texts = [b"abracadabra " * 5, b"the cat sat"]
    models = kneser_ney.model_shards(spark.createDataFrame([(t.decode(),) for t in texts], "text string"), 4, shards=3)
    ends = [(i, bytes(b"abr" + bytes([i])).decode("latin-1")) for i in range(128)]
    got = kneser_ney.log_likelihoods(spark.createDataFrame([(i, t) for i, t in ends] + [(-1, "abr")], "doc_id long, text string"), models, 4, shards=3).collect()
    log = {r.doc_id: r.log_probability for r in got}
    assert sum(math.exp(log[i] - log[-1]) for i in range(128)) == pytest.approx(0.5, abs=0.5) and sum(math.exp(log[i] - log[-1]) for i in range(128)) <= 1.0 + 1e-9


def test_junk_scores_worse_than_trusted_text(spark, data_dir):
    docs, labels = table(spark, data_dir, "documents"), table(spark, data_dir, "labels")
    found = kneser_ney.classify(docs, labels).join(labels, "doc_id").collect()
    good = [r.perplexity for r in found if r.quality == 1 and r.toxic == 0]
    junk = [r.perplexity for r in found if r.quality == 0]
    assert np.median(junk) > np.median(good)
    assert np.mean([r.keep for r in found if r.quality == 1]) > 0.85


def test_classifier_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(i * 3, 1, 0) for i in range(40)] + [(500, 1, 0), (None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = kneser_ney.classify(docs.withColumn("perplexity", F.lit(1)), labels).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == docs.select("doc_id").distinct().count()
    assert by_id[500].perplexity is None and by_id[500].keep is False and by_id[501].keep is False
    assert by_id[None].n_bytes > 0 and by_id[None].perplexity > 1 and by_id[None].keep is (by_id[None].perplexity <= by_id[None].threshold)
    assert kneser_ney.classify(no_docs, labels).collect() == []
    none = kneser_ney.classify(docs, labels.where("false"))
    assert all(r.perplexity == pytest.approx(256) for r in none.collect() if r.perplexity is not None)


def test_thresholds_use_all_trusted_documents(spark):
    dice = random.Random(8)
    rows = [(i, "".join(dice.choice("abcde ") for _ in range(30)), "en" if i % 10 else "fr") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    trained = {r.doc_id for r in kneser_ney.trusted_ids(labels, 60, known=docs.select("doc_id", "lang")).collect()}
    assert 30 < len(trained) < 90 and len({i for i in trained if i % 10 == 0}) > 15
    found = kneser_ney.classify(docs, labels, max_trusted=60).collect()
    for lang in ("en", "fr"):
        own = sorted(r.perplexity for r in found if r.lang == lang and r.doc_id not in trained)
        assert {r.threshold for r in found if r.lang == lang} == {own[math.ceil(0.99 * len(own)) - 1]}
    assert kneser_ney.language_quota([(270.0, 1), (30.0, 1)], 60) == 30 and kneser_ney.language_quota([(4.0, 2), (90.0, 1)], 20) == 12


def test_all_trusted_documents_are_counted_and_set_the_thresholds(spark):
    dice = random.Random(5)
    text = lambda: "".join(dice.choice("abcdeé ") for _ in range(dice.randint(3, 25)))
    rows = [(i, text(), ("en", "fr", None)[min(2, i % 9)] if i % 4 else "en") for i in range(120)]
    rows += [(4, text(), "en"), (4, text(), "en"), (None, text(), "en"), (200, None, "en"), (201, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    good = {i for i in range(120) if i % 5 < 3} | {4, 200, 201}
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(4, 1, None), (5, 1, 0), (3, 0, 0), (999, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    fold = dict(zip(sorted(good), kneser_ney.folds_of(pa.array(sorted(good), pa.int64()), kneser_ney.SEED).tolist(), strict=True))
    assert set(fold.values()) == set(range(kneser_ney.FOLDS))
    plain = {f: plain_kneser_ney([(t or "").encode() for i, t, _ in rows if i in good and fold[i] != f], 4) for f in (None, *fold.values())}
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append((t or "").encode())
    found = {r.doc_id: r for r in kneser_ney.classify(docs, labels).collect()}
    assert found.keys() == texts.keys()
    for i, own in texts.items():
        size = sum(map(len, own))
        if size:
            log = plain[fold.get(i)]
            assert found[i].perplexity == pytest.approx(math.exp(-sum(map(log, own)) / size), rel=1e-6)
        else:
            assert found[i].perplexity is None and found[i].keep is False
    for lang in ("en", "fr", None):
        own = sorted(r.perplexity for r in found.values() if r.doc_id in good and r.perplexity and lang in (r.lang, None))
        assert {r.threshold for r in found.values() if r.lang == lang} == {own[math.ceil(0.99 * len(own)) - 1]}


def test_no_bound_on_trusted_documents(spark):
    docs = spark.range(45_000).selectExpr("id as doc_id", "cast(id as string) as text")
    trusted = docs.where("doc_id % 10 < 9").select("doc_id")
    want = docs.where("doc_id % 10 < 9").agg(F.sum(F.octet_length("text"))).first()[0]
    for bits in (kneser_ney.FILTER_BITS, 1 << 12):  # the second lets every document through
        texts = kneser_ney.trusted_texts(docs, trusted, bits)
        assert texts.count() == 40_500
    blobs = kneser_ney.model_shards(texts, 4, shards=3).select("blob").collect()
    assert sum(unpack(bytes(r.blob)).column("n").to_numpy().sum() for r in blobs) == want


def test_counts_of_many_parts_are_added_up():
    parts = kneser_ney.Tally()
    dice = np.random.default_rng(3)
    keys = dice.integers(0, 1 << 18, 1 << 20).astype(np.uint64)
    for own in np.split(keys, 8):
        parts.add(*np.unique(own, return_counts=True))
    assert parts.held <= 1 << 18
    want = np.unique(keys, return_counts=True)
    assert all((a == b).all() for a, b in zip(parts.counts(), want, strict=True))


# --- masked language model ----------------------------------------------------


def test_gradients():
    dice = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm_scoring.fresh(2).items()}
    near, word = dice.integers(0, lm_scoring.VOCABULARY + 1, (4, 6)), dice.integers(0, lm_scoring.VOCABULARY, 6)
    loss = lambda q: -lm_scoring.log_probabilities(q, near, word).mean()
    sums = {k: np.full(v.shape, 1.0) for k, v in p.items()}
    before = {k: v.copy() for k, v in p.items()}
    lm_scoring.gradient_step(p, sums, near, word, rate=1e-9)
    for name in ("kind", "bias", "word", "near", "word_bias", "kind_bias"):
        g = (before[name] - p[name]) * np.sqrt(sums[name]) / 1e-9
        spot = tuple(np.unravel_index(np.abs(g).argmax(), g.shape))
        up, down = ({k: v.copy() for k, v in before.items()} for _ in range(2))
        up[name][spot] += 1e-5
        down[name][spot] -= 1e-5
        assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(g[spot], rel=1e-3)


def test_probabilities_of_all_words_sum_to_one():
    p = lm_scoring.fresh()
    near = np.full((2 * lm_scoring.SIDE, lm_scoring.VOCABULARY), 7)
    assert np.exp(lm_scoring.log_probabilities(p, near, np.arange(lm_scoring.VOCABULARY))).sum() == pytest.approx(1, abs=1e-4)


def test_neighbours_stay_in_their_text():
    word, text = np.array([1, 2, 3, 4]), np.array([0, 0, 0, 1])
    none = lm_scoring.VOCABULARY
    assert lm_scoring.neighbours(word, text, np.array([0, 2, 3]), 2).T.tolist() == [[none, none, 2, 3], [1, 2, none, none], [none] * 4]


def counts_of(docs):
    return lm_scoring.word_counts(lm_scoring.counted(*lm_scoring.lanes(docs)))


def test_training_helps_and_scores_add_up(spark, data_dir, docs, no_docs, corpus):
    real = table(spark, data_dir, "documents").where("lang = 'en'")
    frequent = lm_scoring.frequent_words(counts_of(real))
    texts = [r.text.encode() for r in real.limit(30).collect()]
    untrained = lm_scoring.score_texts(texts, lm_scoring.fresh(), frequent)
    trained = lm_scoring.score_texts(texts, lm_scoring.train(lm_scoring.lanes(real)[0], frequent, masked=0.5), frequent)
    assert trained[1].sum() > untrained[1].sum() and untrained[0].tolist() == [len(t.split()) for t in texts]
    alone = [lm_scoring.score_texts([t], lm_scoring.fresh(), frequent)[1][0] for t in texts]
    assert np.allclose(alone, untrained[1], rtol=1e-4)
    got = {r.doc_id: r for r in lm_scoring.score(docs).collect()}
    assert got[500].n_words == 0 and got[500].pseudo_log_likelihood == 0 and got[500].mean_log_probability is None
    assert got[504].n_words == 6000 and got[504].mean_log_probability < 0 and got[None].n_words == 30
    assert lm_scoring.score(no_docs).collect() == []


def test_frequent_words(spark):
    text = "a a a b b c " * 3
    found = lm_scoring.frequent_words(counts_of(spark.createDataFrame([(1, text), (2, None), (3, "A")], "doc_id long, text string")))
    codes = word_hashes(np.frombuffer(b"a b c", np.uint8))[1]
    assert {int(c): int(i) for c, i in found} == {int(c): i for i, c in enumerate(codes)}


def test_scores_do_not_hang_on_partitions(docs):
    clash = docs.withColumns({"n_words": F.lit("x"), "part": F.lit(1), "lane": F.lit(2)})
    few, many = (lm_scoring.score(d, block_bytes=3000, fan=fan).collect() for d, fan in ((docs.coalesce(1), 1024), (clash.repartition(7), 3)))
    key = lambda r: (str(r.doc_id), r.n_words, r.pseudo_log_likelihood)
    few, many = sorted(map(key, few)), sorted(map(key, many))
    assert [r[:2] for r in few] == [r[:2] for r in many] and np.allclose([r[2] for r in few], [r[2] for r in many], rtol=1e-6, atol=1e-4)


def test_scores_equal_brute_force_for_a_given_model(docs, corpus):
    """Untrained parameters, a word at a time: whole softmaxes, counts by a Counter."""
    p, side, half = lm_scoring.fresh(), lm_scoring.SIDE, lm_scoring.VOCABULARY // 2
    words = [(r[1] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split() for r in corpus]
    code = {w: int(word_hashes(np.frombuffer(w, np.uint8))[1][0]) for own in words for w in own}
    counts = Counter(code[w] for own in words for w in own)
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    top = sorted(counts, key=lambda c: (-counts[c], signed(c)))[:half]
    number = {c: top.index(c) if c in top else half + c % half for c in counts}
    bucket, once = Counter(), Counter()
    for c, n in counts.items():
        if number[c] >= half:
            bucket[c % half] += n
            once[c % half] += n == 1
    log_softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    got = defaultdict(list)
    for r in lm_scoring.score(docs, rounds=0, block_bytes=3000).collect():
        got[r.doc_id].append(r.pseudo_log_likelihood)
    for row, own in list(zip(corpus, words, strict=True))[:70]:
        own, want = [code[w] for w in own][:200], 0.0
        if len(own) == 200:
            continue
        for i, c in enumerate(own):
            total = p["bias"].astype(np.float64)
            for j, step in enumerate([*range(-side, 0), *range(1, side + 1)]):
                if 0 <= i + step < len(own):
                    total = total + p["near"][j][number[own[i + step]]]
            h = np.tanh(total)
            kind, place = divmod(number[c], lm_scoring.WITHIN)
            want += log_softmax(h @ p["kind"] + p["kind_bias"])[kind] + log_softmax(h @ p["word"][kind] + p["word_bias"][kind])[place]
            if number[c] >= half:
                want += math.log(counts[c] / (bucket[c % half] + max(once[c % half], 1)))
        assert any(g == pytest.approx(want, rel=1e-4, abs=1e-3) for g in got[row[0]])


def test_words_of_a_bucket_have_their_own_probabilities(spark):
    half = lm_scoring.VOCABULARY // 2
    names = [f"w{i}" for i in range(4000)]
    codes = [int(c) for c in word_hashes(np.frombuffer(" ".join(names).encode(), np.uint8))[1]]
    by_bucket = defaultdict(list)
    for name, code in zip(names[half:], codes[half:], strict=True):
        by_bucket[code % half].append(name)
    often, twice, once = next(v for v in by_bucket.values() if len(v) >= 3)[:3]
    texts = [" ".join(names[:half])] * 30 + [often] * 20 + [twice] * 2 + [once]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in lm_scoring.score(docs).collect()}
    assert len(found) == len(texts) and all(r.n_words == len(texts[i].split()) for i, r in found.items())
    log = {texts[i]: r.pseudo_log_likelihood for i, r in found.items()}
    assert log[often] - log[once] == pytest.approx(math.log(20), abs=1e-4) and log[often] - log[twice] == pytest.approx(math.log(10), abs=1e-4)
    # 23 occurrences, and one of an unknown word
    counts = counts_of(docs)
    totals = lm_scoring.bucket_totals(counts, lm_scoring.frequent_words(counts))
    assert sorted(totals.tolist())[-2:] == [1, 24]


def test_sample_of_trusted_documents(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4000)], "doc_id long, quality int, toxic int")
    n = kneser_ney.trusted_ids(labels, max_trusted=500).count()
    assert 350 < n < 650
    random.seed(0)
