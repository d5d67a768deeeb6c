import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, names, radius=3):
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    least = {}
    for i, n in enumerate(names):
        if n is not None:
            least[find(i)] = min(least.get(find(i), n), n)
    return [least.get(find(i)) for i in range(len(prints))]


@pytest.mark.parametrize(("split", "task"), [(simhash.SPLIT, simhash.TASK), (2, 1)])
def test_components_equal_brute_force(docs, corpus, split, task):
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.verdicts(simhash.near_duplicates(docs, split=split, task=task)).collect())
    prints = [plain_fingerprint(t) for _, t, *_ in corpus]
    want = plain_components(prints, [r[0] for r in corpus])
    assert got == sorted((str(r[0]), f"{p:016x}", str(c)) for r, p, c in zip(corpus, prints, want, strict=True))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 63), st.integers(0, 63), st.integers(0, 63)), min_size=1, max_size=60), st.sampled_from([3, 4096]))
def test_bk_trees_find_all_pairs(seeds, split):
    base = [0x0123456789ABCDEF, 0xFFFF0000FFFF0000, 0x5555AAAA5555AAAA, 0]
    codes = np.array(sorted({base[s] ^ (1 << a) ^ (1 << b) ^ (1 << c) for s, a, b, c in seeds}), np.uint64)
    part = np.zeros(len(codes), np.int64)
    tree = simhash.BKForest(codes, part)
    near = {(i, j) for i in range(len(codes)) for j in range(len(codes)) if i != j and int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert {(int(a), int(b)) for x, y in tree.within(np.arange(len(codes)), 3) for a, b in zip(x, y, strict=True)} == near
    # routed by slices, with small and large groups
    slices = np.concatenate([(codes >> np.uint64(16 * k)) & np.uint64(0xFFFF) | np.uint64(k << 32) for k in range(4)]).astype(np.int64)
    node = np.tile(np.arange(len(codes)), 4)
    u, v = simhash.local_edges(slices, np.tile(codes, 4), node, 3, split)
    label = list(range(len(codes)))
    for _ in codes:
        for a, b in zip(u.tolist(), v.tolist(), strict=True):
            label[a] = label[b] = min(label[a], label[b])
    assert label == plain_components([int(c) for c in codes], list(range(len(codes))))


def test_heavy_slices_lose_no_link(spark):
    base = 0x0F0F0F0F0F0F0F0F
    codes = sorted({base ^ (1 << a) ^ (1 << b) ^ (1 << (c * 7 % 64)) for a in range(0, 64, 5) for b in range(0, 64, 9) for c in range(3)})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    nodes = spark.createDataFrame(list(zip(signed, range(len(codes)), strict=True)), "fp long, node long")
    for task in (5, 1 << 20):
        got = {r.node: r.component for r in simhash.components(simhash.links(nodes, task=task)).collect()}
        want = plain_components(codes, list(range(len(codes))))
        assert [got.get(i, i) for i in range(len(codes))] == want


def test_long_chains_meet(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100)], "u long, v long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_keep_first_and_edges(docs, no_docs, corpus):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    found = simhash.near_duplicates(docs).where("component is not null").select("component").distinct()
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(r.component for r in found.collect())
    assert ids.count(None) == 1  # alone
    assert simhash.keep_first(no_docs).collect() == [] and simhash.near_duplicates(no_docs).collect() == []
    clash = docs.withColumns({"fp": F.lit(1), "node": F.lit(2), "component": F.lit(3), "part": F.lit(0)})
    assert sorted(map(str, simhash.near_duplicates(clash).collect())) == sorted(map(str, simhash.near_duplicates(docs).collect()))


def plain_kept(rows):
    """Rows that keep_first leaves, by brute force; repeated ids are one document."""
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                ids = rows[i][0] is not None and rows[j][0] is not None
                if prints[i] == prints[j] or ids and (rows[i][0] == rows[j][0] or (prints[i] ^ prints[j]).bit_count() <= 3):
                    label[i] = label[j] = min(label[i], label[j])
    kept = []
    for group in set(label):
        own = [r for r, g in zip(rows, label, strict=True) if g == group]
        named = [r for r in own if r[0] is not None]
        least = min((r[0] for r in named), default=None)
        kept.append((least, {r[1] for r in own if r[0] == least}))
    return kept


@pytest.mark.parametrize("few", [simhash.FEW, 0])
def test_one_row_of_each_group_stays(spark, few):
    a, b, c = "one two three four five six", "quite another text of seven words", "and a third one that is alone"
    rows = [(5, a), (5, b), (9, b), (7, a), (3, c), (3, c), (None, a), (None, "only without an id here at all"), (None, "only without an id here at all"), (None, "and another such text without an id"), (11, None), (12, ""), (None, " ")]
    df = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, _n string").repartition(3)
    got = simhash.keep_first(df, few=few)
    assert got.columns == df.columns
    found = sorted((str(r.doc_id), r.text, r._n) for r in got.collect())
    want = plain_kept(rows)
    assert len(found) == len(want)
    for i, texts in want:
        (own,) = [f for f in found if f[0] == str(i) and f[1] in texts] if i is not None else [next(f for f in found if f[0] == "None" and f[1] in texts)]
        assert own
    assert found == sorted((str(r.doc_id), r.text, r._n) for r in simhash.keep_first(df.repartition(7), few=few).collect())


@pytest.mark.parametrize("text", [None, "", "one", "One two", "a b c", "a b c d " * 200, "é Ü x"])
def test_fingerprints(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_rows_without_ids_of_one_text_are_dealt(spark, monkeypatch):
    """A fingerprint that most rows have, all of them without an id, is joined in parts; none is lost."""
    parts = []
    real = simhash._labelled

    def seen(rows, *more, **named):
        parts.append(rows.where("doc_id is null").select((F.pmod("_deal", F.lit(50))).alias("p")).groupBy("p").count().agg(F.count("p"), F.max("count")).first())
        return real(rows, *more, **named)

    monkeypatch.setattr(simhash, "_labelled", seen)
    docs = spark.range(3000, numPartitions=6).select(F.when(F.col("id") >= 2500, F.col("id")).alias("doc_id"), F.when(F.col("id") < 2500, "one text that all of these have").otherwise(F.concat(F.lit("other words of row number "), "id", F.lit(" x"), F.col("id") * 7)).alias("text"))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == 3000 and sum(r.component is None for r in found) == 2500
    assert parts[0][0] == 50 and parts[0][1] < 100
