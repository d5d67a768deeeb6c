"""Suffix trees (6) and suffix arrays (9) against brute force, whole and part by part."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.llm import blocks, repeats, suffix_arrays, suffix_trees
from skyloom.llm.blocks import LAST
from skyloom.llm.repeats import Occurrences, rolled

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(corpus, units, length, within):
    """Removed units of each row; rows of one doc_id are one document."""
    first = {}
    listed = []
    for doc, text, *_ in corpus:
        u = units((text or "").encode())
        listed.append((LAST if doc is None else doc, u))
    for doc, u in listed:
        for a in range(len(u) - length + 1):
            key = tuple(u[a : a + length])
            first[key] = min(first.get(key, (doc, a)), (doc, a))
    out = []
    for doc, u in listed:
        gone = set()
        for a in range(len(u) - length + 1):
            d, s = first[tuple(u[a : a + length])]
            if d < doc or within and d == doc and s < a:
                gone.update(range(a, a + length))
        out.append(gone)
    return out


@pytest.mark.parametrize(("length", "hot"), [(13, 50_000), (5, 50_000), (13, 2), (5, 4)])
def test_suffix_trees_equal_brute_force(docs, corpus, length, hot):
    found = suffix_trees.remove_repeats(docs, length=length, gram=min(5, length - 1), limit=40, hot=hot)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect())
    want = []
    for (doc, text, *_), gone in zip(corpus, brute(corpus, WORD.findall, length, False), strict=True):
        words = WORD.findall((text or "").encode())
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((-1 if doc is None else doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


@pytest.mark.parametrize(("length", "gram", "hot"), [(100, 32, 50_000), (30, 9, 50_000), (100, 32, 3), (30, 9, 8)])
def test_suffix_arrays_equal_brute_force(docs, corpus, length, gram, hot):
    found = suffix_arrays.remove_repeats(docs, length=length, gram=gram, shard_bytes=700, hot=hot)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found.collect())
    want = []
    for (doc, text, *_), gone in zip(corpus, brute(corpus, lambda b: b, length, True), strict=True):
        raw = (text or "").encode()
        kept = bytes(b for i, b in enumerate(raw) if i not in gone)
        spans = sum(i - 1 not in gone for i in gone)
        want.append((-1 if doc is None else doc, len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


@pytest.mark.parametrize(("block_bytes", "fan"), [(2000, 1024), (2000, 2), (300, 5)])
def test_small_blocks_and_two_hops(docs, block_bytes, fan):
    for op, size in ((suffix_trees, 9), (suffix_arrays, 60)):
        want = sorted(map(str, op.remove_repeats(docs, length=size, hot=20).collect()))
        assert sorted(map(str, op.remove_repeats(docs, length=size, hot=20, block_bytes=block_bytes, fan=fan).collect())) == want


def test_every_removal_comes_from_the_suffix_structure(docs, monkeypatch):
    """With a structure that finds nothing, nothing goes, not even exact copies."""

    def blind(*_):
        def solve(seen):
            context = np.repeat(np.arange(len(seen.text)), seen.count)
            window = np.arange(seen.count.sum()) - np.repeat(np.cumsum(seen.count) - seen.count, seen.count)
            yield context, window, np.full(len(context), LAST), np.full(len(context), LAST)

        return solve

    for op in (suffix_trees, suffix_arrays):
        assert sum(r.n_removed for r in op.remove_repeats(docs).collect()) > 0
        monkeypatch.setattr(op, "solver", blind)
        assert sum(r.n_removed for r in op.remove_repeats(docs).collect()) == 0


@pytest.mark.parametrize(("parts", "fan"), [(40, 1024), (40, 3), (41, 8), (1, 1)])
def test_messages_arrive(spark, parts, fan):
    exchange = blocks.Exchange(parts, ("u8", "text"), fan)

    def send(key, rows):
        home = key[0].as_py()
        to = np.arange(0, parts, 1 + home % 3)
        return exchange.rows([*exchange.kept(1, home, [np.array([home])]), *exchange.sent([to.astype(np.uint64) * 7, [b"%d>%d" % (home, t) for t in to]], to, home, home)])

    def read(key, rows):
        home = key[0].as_py()
        origin, number, text = exchange.opened(rows)
        assert all(number == home * 7) and blocks.notes_of(rows, 1, ("i8",))[0].tolist() == [home]
        return blocks.table([(home, 0, t) for t in text], blocks._schema("part int, lane int, blob binary"))

    sent = spark.range(parts).selectExpr("cast(id as int) part").groupBy("part").applyInArrow(send, blocks.SENT)
    got = exchange.delivered(sent).groupBy("part").applyInArrow(read, "part int, lane int, blob binary").collect()
    want = [(t, b"%d>%d" % (h, t)) for h in range(parts) for t in range(0, parts, 1 + h % 3)]
    assert sorted((r.part, bytes(r.blob)) for r in got) == sorted(want)
    if fan < parts:
        assert sent.where("kind = 0").groupBy("home").count().agg(F.max("count")).first()[0] <= exchange.step


def test_empty_tables_and_other_columns(docs, no_docs):
    for op in (suffix_trees, suffix_arrays):
        assert op.remove_repeats(no_docs).collect() == []
        clash = docs.withColumns({"n_words": F.lit(1), "part": F.lit(2), "blob": F.lit(3), "n_removed": F.lit("x")})
        assert sorted(map(str, op.remove_repeats(clash).collect())) == sorted(map(str, op.remove_repeats(docs).collect()))


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300).map(lambda b: bytes(x % 3 for x in b)), st.integers(8, 40))
def test_suffix_array_and_prefixes(raw, depth):
    text = np.frombuffer(raw, np.uint8)
    sa = suffix_arrays.suffix_array(text, depth)
    cut = [raw[i : i + depth].ljust(depth, b"\0") for i in sa]
    assert sorted(sa.tolist()) == list(range(len(raw))) and cut == sorted(cut)

    def shared(a, b):
        n = 0
        while n < depth and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    got = suffix_arrays.common_prefixes(text, sa, depth).tolist()
    assert got == [0] + [shared(a, b) for a, b in zip(sa[1:], sa[:-1], strict=True)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=4, max_size=30), min_size=1, max_size=12), st.integers(1, 30))
def test_suffix_tree_solver(texts, limit):
    length = 4
    seen = Occurrences(np.zeros(len(texts), np.uint64), np.arange(len(texts)), np.zeros(len(texts), np.int64), np.array([len(t) - length + 1 for t in texts]), [b" ".join(b"w%d" % w for w in t) for t in texts])
    got = {(c, w) for found in suffix_trees.solver(length, limit)(seen) for c, w, d, _ in zip(*(x.tolist() for x in found), strict=True) if d < c}
    first = {}
    for i, t in enumerate(texts):
        for a in range(len(t) - length + 1):
            first.setdefault(tuple(t[a : a + length]), i)
    assert got == {(i, a) for i, t in enumerate(texts) for a in range(len(t) - length + 1) if first[tuple(t[a : a + length])] < i}


def test_tree_nodes():
    tree = suffix_trees.SuffixTree([0, 2, 3, 1, 0, 4])
    assert sorted(tree.nodes) == [(1, 0, 4), (2, 0, 3), (3, 1, 3), (4, 4, 6)] and tree.deep(3) == [(1, 3), (4, 6)]


@pytest.mark.parametrize("window", [1, 2, 13, 64, 90])
def test_positions_beyond_their_bits(window, monkeypatch):
    dice = np.random.default_rng(window)
    grams = dice.integers(0, 1 << 63, 3000, dtype=np.uint64)
    grams[2000:2500] = grams[100:600]
    valid = dice.random(3000) < 0.95
    want = repeats.gram_anchors(grams, window, valid)
    monkeypatch.setattr(repeats, "_POSITION", np.uint64((1 << 8) - 1))
    got = repeats.gram_anchors(grams, window, valid)
    assert all((a == b).all() for a, b in zip(got, want, strict=True))
    least = [grams[i : i + window].min() for i in range(3000 - window + 1)]
    assert all((grams[:0] if n == 0 else np.array(least[s : s + n]) == a).all() for s, n, a in zip(*got, strict=True))


def test_hashes_by_value():
    dice = random.Random(1)
    values = np.array([dice.randrange(5) for _ in range(400)], np.uint64)
    for size in (1, 5, 9, 32):
        h = rolled(values, size)
        groups = {}
        for i in range(len(values) - size + 1):
            groups.setdefault(tuple(values[i : i + size].tolist()), set()).add(int(h[i]))
        assert len(h) == len(values) - size + 1 and all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)
    text = "one two  one\tthrée two one".encode()
    start, code = suffix_trees.word_hashes(np.frombuffer(text, np.uint8))
    words = WORD.findall(text)
    assert len(start) == len(words) and [words.index(w) for w in words] == [code.tolist().index(c) for c in code.tolist()]
