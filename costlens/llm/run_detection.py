"""Periodic runs of words by a Kruskal forest over suffixes, in descending LCP order.

The words of a document get ranks by prefix doubling, which yields the suffix order
and, for neighbours in it, the longest common prefix (LCP). The edges between
neighbours are then taken in order of falling LCP. Each unites two classes of
suffixes (union-find, the smaller into the larger), and a class keeps its positions
in order; where a position moves in, it is compared with the position before and the
one after it. Two newly adjacent positions at a distance of at most the LCP start a
repetition with that distance as its period: words ``i .. i + distance + LCP - 1``.
A seed that the word to its left would extend is passed over, since the run has
another seed further left; of seeds with one extent the smallest period stays, as a
larger one is a multiple of it. Edges with an LCP under half the shortest wanted run
cannot seed one and are left out.

A run is a stretch of words with smallest period q and at least ``max(shortest, 2 q)``
words that no word at either end extends. Documents are independent, so nothing is
shuffled; a task takes documents in groups of about ``GROUP_WORDS`` words. One document
needs about 250 bytes a word, so a text of a million words takes 250 MB of a worker.

Null, empty or blank text: no words, no runs and the empty collapsed text. Texts of any
length are taken whole. Rows repeated or without an id: each gives a row of its own. Two
runs of equal length are both reported. Empty table: no rows. Other columns, whatever
their names, are ignored."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from costlens.llm.common import text_of

#: Words that a task ranks together (one document at least).
GROUP_WORDS = 400_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
_DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``symbols`` in order, and for each the power of two at which
    it parted from the one before it: their LCP lies in [parted, 2 parted)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    head = np.ones(n, bool)
    head[1:] = ranked[1:] != ranked[:-1]
    parted = np.zeros(n, np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    slots = np.flatnonzero(~(head & np.append(head[1:], True)))  # places in classes of several
    h = 1
    while len(slots):
        at = order[slots]
        after = at + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[at]
        by = np.argsort(first * (n + 1) + second + 1, kind="stable")
        at, first, second = at[by], first[by], second[by]
        order[slots] = at
        same = np.zeros(len(slots), bool)  # as the one before, by 2 h symbols
        same[1:] = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
        cut = np.zeros(len(slots), bool)  # as the one before by h symbols, not by 2 h
        cut[1:] = (first[1:] == first[:-1]) & ~same[1:]
        parted[slots[cut]] = h
        rank[at] = slots[np.maximum.accumulate(np.where(same, 0, np.arange(len(slots))))]
        slots = slots[same | np.append(same[1:], False)]
        h *= 2
    return order, parted


def common_prefixes(symbols: np.ndarray, order: np.ndarray, parted: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(lcp, position, other) of the neighbours in ``order`` with an LCP of ``least``
    or more, found in text order, where an LCP falls by one a step at most."""
    places = np.flatnonzero(parted * 2 > least)
    if not len(places):
        return []
    at, other, known = order[places], order[places - 1], parted[places]
    by = np.argsort(at, kind="stable")
    s, n, out = symbols.tolist(), len(symbols), []
    last, size = -2, 0
    for i, j, low in zip(at[by].tolist(), other[by].tolist(), known[by].tolist()):
        size = max(low, size - 1 if i == last + 1 else 0)
        while i + size < n and j + size < n and s[i + size] == s[j + size]:
            size += 1
        last = i
        if size >= least:
            out.append((size, i, j))
    return out


def seeds(edges: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(earlier, later, lcp) of positions that become neighbours in a class no further
    apart than the LCP at which their classes meet."""
    edges = sorted(edges, reverse=True)
    parent: dict[int, int] = {}
    sets: dict[int, list[int]] = {}
    for _, i, j in edges:
        for x in (i, j):
            if x not in parent:
                parent[x] = x
                sets[x] = [x]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for lcp, i, j in edges:
        big, small = root(i), root(j)
        if len(sets[big]) < len(sets[small]):
            big, small = small, big
        parent[small] = big
        held, moved = sets[big], sets.pop(small)
        before = -1
        for p, after in zip(moved, [*moved[1:], None]):
            k = bisect_left(held, p)
            if k and held[k - 1] != before and p - held[k - 1] <= lcp:
                yield held[k - 1], p, lcp
            if k < len(held) and held[k] - p <= lcp and (after is None or held[k] < after):
                yield p, held[k], lcp
            held.insert(k, p)
            before = p


def runs(symbols: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    order, parted = suffix_order(symbols)
    found: dict[tuple[int, int], int] = {}
    for i, j, lcp in seeds(common_prefixes(symbols, order, parted, (shortest + 1) // 2)):
        if i and symbols[i - 1] == symbols[j - 1]:
            continue
        length, period = lcp + j - i, j - i
        if length >= shortest:
            found[i, length] = min(period, found.get((i, length), period))
    return sorted(((i, n, q) for (i, n), q in found.items()), key=lambda x: (x[0], x[2]))


def _group(ids: list, texts: list[list[bytes]], shortest: int) -> pa.RecordBatch:
    words = [w for t in texts for w in t]
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    spans: list[list[dict]] = [[] for _ in texts]
    keep = np.ones(len(words), bool)
    if words:
        codes, stock = pd.factorize(np.fromiter(words, object, len(words)))
        document = np.repeat(np.arange(len(texts)), sizes)
        # a symbol belongs to one document: no common prefix goes from one to another
        for start, length, period in runs(document * len(stock) + codes, shortest):
            d = int(document[start])
            spans[d].append({"start": start - int(starts[d]), "length": length, "period": period})
            keep[start + period:start + length] = False
    collapsed = []
    for k, t in enumerate(texts):
        if spans[k]:
            t = [w for w, stays in zip(t, keep[starts[k]:ends[k]].tolist()) if stays]
        collapsed.append(b" ".join(t).decode())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.array(spans, pa.list_(RUN)), pa.array(collapsed, pa.string())], schema=OUT)


def _find(shortest: int):
    def run(batches):
        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = t.as_buffer().to_pybytes().split()  # at ASCII white space alone
                if ids and held + len(words) > GROUP_WORDS:
                    yield _group(ids, texts, shortest)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(words)
                held += len(words)
        if ids:
            yield _group(ids, texts, shortest)
    return run


def find(docs: DataFrame, shortest: int = 12) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start, then period)
    and the text collapsed: without the words that a run holds after its first period,
    the others joined by one space."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return rows.mapInArrow(_find(shortest), _DDL)
