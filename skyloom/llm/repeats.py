"""Distributed search for repeated windows, shared by the two substring operators.

A window is a fixed number of consecutive units (bytes or words) of one
document.  The least hash of the window's short grams is its anchor: equal
windows have equal anchors, and neighbouring windows mostly share one, so few
anchors stand for all windows.  Documents are dealt into packed blocks (see
``blocks``) and then

1. every block sends its distinct anchors to the anchors' buckets;
2. a bucket returns to each block those that occur elsewhere too;
3. a block sends, for each such anchor, the contexts that its windows cover,
   equal ones once, with the earliest place, and notes where the others lie;
4. a bucket puts each different context, with its earliest place, into the
   operator's suffix structure, whose nodes tell where each window starts
   first, and returns these places to the blocks;
5. a block compares each of its occurrences with them and finishes its
   documents.

A passage of a third of all documents costs one entry a block.  Where its
surroundings differ everywhere, its anchor would gather all of them: an anchor
with more than ``hot`` occurrences has its windows sent one by one to buckets
of their own hashes instead.  Rows that repeat a doc_id count as one document
whose parts all start at 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from skyloom.llm.blocks import BLOCK_BYTES, FAN, LAST, SENT, Exchange, block_count, documents, in_blocks, notes_of, table
from skyloom.llm.common import mix64, text_volume

#: Occurrences of an anchor that one bucket takes.
HOT = 50_000
#: Text whose arrays are worked on at once; a longer document is one piece.
PIECE_BYTES = 192 << 10
_POSITION = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1


@dataclass
class Occurrences:
    """Different contexts in order of their anchors; each covers ``count`` windows and first begins at (doc, start)."""

    anchor: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    text: list[bytes]


@dataclass
class Method:
    """What an operator brings to the search."""

    #: texts -> (document, start, windows, anchor) of each context
    contexts: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    #: text -> function (start, windows) -> context
    slicer: Callable[[bytes], Callable[[int, int], bytes]]
    #: different contexts -> (context, window, document, start) arrays: where each window of whole contexts starts first
    solve: Callable[[Occurrences], Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]
    #: text, [(start, windows)] -> result columns
    finish: Callable[[bytes, list[tuple[int, int]]], tuple]
    #: a window of the same document that starts earlier counts as well
    within: bool
    names: tuple[str, ...]
    types: tuple[pa.DataType, ...]
    ddl: str


def _least(grams: np.ndarray, window: int) -> np.ndarray:
    """Position of the least gram of each window, by overlapping parts whose positions fit the low bits."""
    parts, step = [], int(_POSITION) + 2 - window
    for low in range(0, len(grams) - window + 1, step):
        own = grams[low : low + step + window - 1]
        least = (own & ~_POSITION) | np.arange(len(own), dtype=np.uint64)
        size = 1
        while 2 * size <= window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < window:
            least = np.minimum(least[: size - window], least[window - size :])
        parts.append((least & _POSITION).astype(np.int64) + low)
    return np.concatenate(parts)


def gram_anchors(grams: np.ndarray, window: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) of each run of valid windows with one anchor.

    grams: hashes of the grams that start at each unit; window: grams in a
    window; valid: whether a window starts at the unit.  The leftmost of equal
    least hashes counts, so equal windows choose alike.
    """
    if len(grams) < window:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    at = np.flatnonzero(valid[: len(grams) - window + 1])
    chosen = _least(grams, window)[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), grams[chosen[first]]


def rolled(values: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes, modulo 2^64, of each run of ``size`` values."""
    power, have, out, done = _BASE, 1, None, 0
    chunk = values
    while True:
        if size & have:
            if out is None:
                out, done = chunk, have
            else:  # chunk before out
                n = len(values) - done - have + 1
                out = chunk[:n] * np.uint64(pow(_BASE, done, 1 << 64)) + out[have : have + n]
                done += have
        if 2 * have > size:
            return mix64(out)
        chunk = chunk[:-have] * np.uint64(power) + chunk[have:]
        power = power * power % (1 << 64)
        have *= 2


def _pieces(texts: list[bytes]) -> Iterable[tuple[int, list[bytes]]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > PIECE_BYTES:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _all_contexts(texts: list[bytes], method: Method):
    """Contexts of all texts, with the text's position as document."""
    found = [
        (doc + first, start, count, anchor)
        for first, part in _pieces(texts)
        for doc, start, count, anchor in [method.contexts(part)]
    ]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def first_runs(context: np.ndarray, window: np.ndarray, doc: np.ndarray, start: np.ndarray, within: bool) -> tuple[np.ndarray, ...]:
    """Sorted windows as runs (context, window, windows, document, start) that lie side by side where they start first too."""
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (doc[1:] != doc[:-1])
    if within:
        new[1:] |= start[1:] != start[:-1] + 1
    first = np.flatnonzero(new)
    return context[first], window[first], np.diff(np.append(first, len(context))), doc[first], start[first]


def matched(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (position in keys, position in sorted_keys) of equal keys."""
    low, high = (np.searchsorted(sorted_keys, keys, side=side) for side in ("left", "right"))
    n = high - low
    return np.repeat(np.arange(len(keys)), n), np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())


def _earlier(first: tuple[np.ndarray, np.ndarray], own: tuple[np.ndarray, np.ndarray], within: bool) -> np.ndarray:
    """Whether the first place comes before the own one, in another document or, ``within``, in the same."""
    less = first[0] < own[0]
    return less | (first[0] == own[0]) & (first[1] < own[1]) if within else less


ANCHORS, SHARED = ("u8", "u4"), ("u8", "?")
#: Anchor, earliest document and start, windows, number in the block, whether it occurs there more often, text.
CONTEXTS = ("u8", "i8", "i4", "i4", "i4", "?", "text")
#: Number of the context in the block, row and start of an occurrence.
PLACES = ("i4", "i4", "i4")
#: Number of the context, first window, windows, document and start where they start first.
FIRSTS = ("i4", "i4", "i4", "i8", "i4")


def removed_windows(docs: DataFrame, method: Method, hot: int = HOT, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id and the columns that method.finish returns."""
    _, volume = text_volume(docs)
    parts = block_count(volume, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), block_bytes)
    anchors_, shared_, contexts_, firsts_ = (Exchange(parts, kinds, fan) for kinds in (ANCHORS, SHARED, CONTEXTS, FIRSTS))

    def send_anchors(key, block):
        home = key[0].as_py()
        _, texts = documents(b.as_py() for b in block.column("blob"))
        anchor, times = np.unique(_all_contexts(texts, method)[3], return_counts=True)
        return anchors_.rows(anchors_.sent([anchor, times.astype(np.uint32)], anchor % np.uint64(parts), home, home))

    def shared_anchors(key, got):
        origin, anchor, n = anchors_.opened(got)
        if not len(anchor):
            return shared_.rows([])
        order = np.argsort(anchor, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]]))
        total = np.empty(len(order), np.int64)
        total[order] = np.repeat(np.add.reduceat(n[order].astype(np.int64), first), np.diff(np.append(first, len(order))))
        chosen = np.flatnonzero(total > 1)
        return shared_.rows(shared_.sent([anchor[chosen], total[chosen] > hot], origin[chosen], 0, key[0].as_py()))

    def send_contexts(key, block, got):
        if not block.num_rows or not got.num_rows:
            return contexts_.rows([])
        home = key[0].as_py()
        ids, texts = documents(b.as_py() for b in block.column("blob"))
        _, known, common = shared_.opened(got)
        order = np.argsort(known)
        known, common = known[order], common[order]
        doc, start, count, anchor = _all_contexts(texts, method)
        at = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
        there = np.flatnonzero(known[at] == anchor)
        alone = common[at[there]]  # windows of common anchors go one by one
        each = np.where(alone, count[there], 1)
        step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        there, alone = np.repeat(there, each), np.repeat(alone, each)
        doc, start, count, anchor = doc[there], start[there] + step, np.where(alone, 1, count[there]), anchor[there]
        number = np.array([LAST if i is None else i for i in ids], np.int64)
        order = np.lexsort((start, number[doc]))
        doc, start, count, anchor, alone = (x[order] for x in (doc, start, count, anchor, alone))
        first: dict[tuple[bytes, int], int] = {}
        keep, text = [], []
        which = np.empty(len(doc), np.int32)
        cut, last = None, -1
        single = alone.tolist()
        for i, (d, s, n) in enumerate(zip(doc.tolist(), start.tolist(), count.tolist(), strict=True)):
            if d != last:
                cut, last = method.slicer(texts[d]), d
            context = cut(s, n)
            which[i] = k = first.setdefault((context, n), len(keep))
            if k == len(keep):  # contexts are in order of doc_id and start
                if single[i]:
                    anchor[i] = xxhash.xxh64_intdigest(context)
                keep.append(i)
                text.append(context)
        keep = np.array(keep, np.int64)
        often = np.bincount(which, minlength=len(keep)) > 1
        columns = [anchor[keep], number[doc[keep]], start[keep].astype(np.int32), count[keep].astype(np.int32), np.arange(len(keep), dtype=np.int32), often, text]
        order = np.argsort(which, kind="stable")
        places = [x[order].astype(np.int32) for x in (which, doc, start)]
        return contexts_.rows([*contexts_.kept(1, home, places), *contexts_.sent(columns, anchor[keep] % np.uint64(parts), home, home)])

    def find_firsts(key, got):
        """Where the windows of a bucket's contexts start first; the blocks' notes pass through."""
        home = key[0].as_py()
        rows = [(home // firsts_.step, home // firsts_.step, 1, home, b.as_py()) for b, k in zip(got.column("blob"), got.column("kind").to_pylist(), strict=True) if k]
        origin, anchor, doc, start, count, number, often, text = contexts_.opened(got)
        if not text:
            return firsts_.rows(rows)
        order = np.lexsort((start, doc))
        first: dict[tuple[bytes, int], int] = {}
        same = np.empty(len(order), np.int64)
        for i, n in zip(order.tolist(), count[order].tolist(), strict=True):
            same[i] = first.setdefault((text[i], n), i)
        lead = np.flatnonzero(same == np.arange(len(same)))
        lead = lead[np.argsort(anchor[lead], kind="stable")]
        rank = np.empty(len(same), np.int64)
        rank[lead] = np.arange(len(lead))
        group = rank[same]
        by_group = np.argsort(group, kind="stable")
        seen = Occurrences(anchor[lead], doc[lead], start[lead].astype(np.int64), count[lead].astype(np.int64), [text[i] for i in lead.tolist()])
        out = []
        for context, window, at_doc, at_start in method.solve(seen):
            context, window, width, at_doc, at_start = first_runs(context, window, at_doc, at_start, method.within)
            run, own = matched(context, group[by_group])
            own = by_group[own]
            told = often[own] | _earlier((at_doc[run], at_start[run]), (doc[own], start[own] + window[run]), method.within)
            run, own = run[told], own[told]
            out.append([origin[own], number[own], window[run], width[run], at_doc[run], at_start[run]])
        to, *columns = (np.concatenate(x) for x in zip(*out, strict=True))
        columns = [c.astype(k) for c, k in zip(columns, FIRSTS, strict=True)]
        return firsts_.rows([*rows, *firsts_.sent(columns, to, 0, home)])

    result_type = pa.schema([("doc_id", pa.int64()), *zip(method.names, method.types, strict=True)])

    def finish(key, block, got):
        ids, texts = documents(b.as_py() for b in block.column("blob"))
        own = np.array([LAST if i is None else i for i in ids], np.int64)
        spans: dict[int, list[tuple[int, int]]] = {}
        which, row, start = notes_of(got, 1, PLACES)
        _, number, window, width, doc, at = firsts_.opened(got)
        run, place = matched(number, which)
        begin = start[place] + window[run]
        late = _earlier((doc[run], at[run]), (own[row[place]], begin), method.within)
        for r, s, n in zip(row[place[late]].tolist(), begin[late].tolist(), width[run[late]].tolist(), strict=True):
            spans.setdefault(r, []).append((s, n))
        return table([(i, *method.finish(t, spans.get(k, []))) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], result_type)

    blocks = in_blocks(docs, parts)
    shared = shared_.delivered(anchors_.delivered(blocks.groupBy("part").applyInArrow(send_anchors, SENT)).groupBy("part").applyInArrow(shared_anchors, SENT))
    contexts = contexts_.delivered(blocks.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(send_contexts, SENT))
    firsts = firsts_.delivered(contexts.groupBy("part").applyInArrow(find_firsts, SENT))
    return blocks.groupBy("part").cogroup(firsts.groupBy("part")).applyInArrow(finish, f"doc_id long, {method.ddl}")
