"""Differencing, run detection and whitening against brute force, and odd rows."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.llm import differencing, registry, run_detection, whitening

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- sharding ----------------------------------------------------------------

def plain_differencing(sizes, k):
    """Karmarkar-Karp over whole tuples, without blocks, classes or heaps."""
    parts = [[(s, [i])] + [(0, [])] * (k - 1) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[-1][0] - p[0][0])
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, b[::-1])), key=lambda x: -x[0]))
    return sorted(s for s, _ in parts[0])


def spread(sizes, slots, before):
    sums = np.array(before)
    np.add.at(sums, slots, sizes)
    return int(sums.max() - sums.min())


@pytest.mark.parametrize("n, k", [(1, 3), (2, 2), (9, 2), (30, 4), (60, 5)])
def test_differencing_is_karmarkar_karp(n, k):
    rnd = random.Random(n)
    sizes = np.array(sorted((rnd.randint(1, 10**6) for _ in range(n)), reverse=True))
    slots = differencing.difference(sizes, np.zeros(k, np.int64))
    sums = np.zeros(k, np.int64)
    np.add.at(sums, slots, sizes)
    assert sorted(sums.tolist()) == plain_differencing(sizes.tolist(), k)


def test_differencing_evens_what_was_there():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(16, 5000, 2000))[::-1]
    before = rng.integers(0, 60_000, 40)
    assert spread(sizes, differencing.difference(sizes, before), before) < 16


def shards_of(rows):
    sums, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    return sums


def test_shards_of_the_documents(spark):
    docs = registry.table(spark, SF, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = registry.op11_kk_shards(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 16, crc32(t.encode())) for i, t in texts.items()}
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)} and len(rows) == len(texts)
    sums = shards_of(rows)
    groups = Counter()
    for t in texts.values():
        groups[t] += len(t.encode()) + 16
    plain = plain_differencing(list(groups.values()), 40)
    assert max(sums.values()) <= plain[-1] * 1.01


def test_shards_in_many_blocks_and_classes(spark, monkeypatch):
    monkeypatch.setattr(differencing, "BLOCK", 100)
    rnd = random.Random(8)
    rows = [(i, "x" * int(rnd.paretovariate(1.1) * 20) + str(i), None, None, 0) for i in range(3000)]
    rows += [(3000 + i, "y" * 50_000 + str(i), None, None, 0) for i in range(3)] + [(4000 + i, "hot" * 100, None, None, 0) for i in range(1500)]
    got = differencing.assign(spark.createDataFrame(rows, DOCS).repartition(7), shards=8).collect()
    sums = shards_of(got)
    hot = 1500 * 316
    assert max(sums.values()) == hot and len(got) == len(rows)  # the hot group alone in its shard
    others = sorted(sums.values())[:-1]
    assert others[-1] - others[0] < 2000 and sum(others) == sum(len(r[1]) + 16 for r in rows) - hot


def test_shards_of_odd_rows(spark):
    odd = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (None, "é", None, None, 1), (None, "é", None, None, 1), (5, "z" * 100_000, None, None, 0), (5, "z" * 100_000, None, None, 0)]
    docs = spark.createDataFrame(odd, DOCS).withColumns({"shard": F.lit("x"), "slot": F.lit(1), "digest": F.lit(2), "task": F.lit(None), "n": F.lit(0)})
    rows = differencing.assign(docs, shards=3).collect()
    shards_of(rows)
    assert Counter((r.doc_id, r.size, r.group_rows) for r in rows) == Counter([(1, 16, 2), (2, 16, 2), (None, 18, 2), (None, 18, 2), (5, 100_016, 2), (5, 100_016, 2)])
    assert {r.text_crc32 for r in rows if r.doc_id in (1, 2)} == {0}
    assert differencing.assign(docs.limit(0)).collect() == []


# --- periodic runs -----------------------------------------------------------

def plain_runs(w, shortest):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(shortest, 2 * q):
                out.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        n = rnd.randint(0, 90)
        w = [rnd.randrange(rnd.choice([1, 2, 3, 6])) for _ in range(n)]
        if n and rnd.random() < 0.5:
            a, p = rnd.randrange(n), rnd.randint(1, 20)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        for shortest in (2, 7, 12):
            assert run_detection.runs(np.array(w, np.int64), shortest) == plain_runs(w, shortest)


def expected_runs(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w, 12)
    drop = {x for s, m, q in runs for x in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
    return (doc_id, len(runs), *top, digest, sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_runs_of_the_documents(spark, monkeypatch):
    monkeypatch.setattr(run_detection, "GROUP_WORDS", 3000)
    docs = registry.table(spark, SF, "documents").filter(F.length("text") < 8000).collect()
    want = {r.doc_id: expected_runs(r.doc_id, r.text) for r in docs}
    rows = [tuple(r) for r in registry.op12_periodic_runs(spark, SF).collect()]
    assert {r[0]: r for r in rows if r[0] in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 5


def test_runs_of_odd_rows(spark):
    hot = "a b c " * 4 + "\x1c\x85 x y"
    odd = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, hot), (4, hot), (None, "w " * 20000), (6, "ab " * 11), (7, "é\r\n" * 12)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in odd], DOCS).withColumns({"runs": F.lit(1), "collapsed": F.lit("c"), "w": F.lit(2), "start": F.lit(None)})
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in run_detection.find(docs).collect()]
    tail = "\x1c\x85 x y"
    assert Counter(map(repr, got)) == Counter(map(repr, [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 14, [(0, 12, 3)], "a b c " + tail), (4, 14, [(0, 12, 3)], "a b c " + tail),
        (None, 20000, [(0, 20000, 1)], "w"), (6, 11, [], " ".join(["ab"] * 11)), (7, 12, [(0, 12, 1)], "é")]))
    assert run_detection.find(docs.limit(0)).collect() == []
    assert registry.repeated(docs.filter("doc_id is null")).first().text == "w " * 20000


# --- whitening ---------------------------------------------------------------

@pytest.mark.parametrize("values", [[9, 7, 5, 3, 2, 1.5, 1, 0.5, 0.2, 0.1], [5] * 12 + [1] * 20, [3] * 30, [1e6, 1e6 * (1 - 1e-9), 4, 4, 4, 1e-3], [2, 1, 0, 0, 0], [1e-9] * 3])
def test_components_are_eigenvectors(values):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.components(v, 8)
    want = np.sort([y for y in values if y])[::-1][:8]
    assert np.abs(e - want).max() <= 1e-13 * want[0] and np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ x - x * e).max() <= 1e-13 * want[0]
    for s in (want[0] * 1.1, want.mean() * 1.0001, want[-1] * 0.3):
        assert whitening.above(v, s) == sum(y > s for y in values)


def expected_whitening(vectors, wanted=8):
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    dev = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    off = np.array([[(n * r[i] - s[i]) / n for i in range(d)] for r in x])
    e, q = np.linalg.eigh(off.T @ off / n)
    e, q = e[::-1][:wanted], q[:, ::-1][:, :wanted]
    return dev, off @ q / np.sqrt(e), e / (off.T @ off / n).trace()


def test_whitening_of_the_embeddings(spark):
    table = {r.vec_id: r.embedding for r in registry.table(spark, SF, "embeddings").collect()}
    ids = sorted(table)
    dev, white, explained = expected_whitening([table[i] for i in ids])
    rows = registry.op13_feast_whitening(spark, SF).collect()
    assert len(rows) == 8 * len(ids) and {r.n for r in rows} == {len(ids)}
    place = {i: k for k, i in enumerate(ids)}
    assert all(r.deviation == dev[place[r.vec_id]] for r in rows)
    got = np.zeros_like(white)
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-8
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    kind = "vec_id long, embedding array<float>, component int, n string, v string"
    nan, inf = float("nan"), float("inf")
    rnd = random.Random(2)
    good = [(i, [rnd.gauss(0, 1), rnd.gauss(5, 2), 3.0], 7, "x", "y") for i in range(40)]
    odd = [(None, [0.0, 1.0, 3.0], 0, "", ""), (3, [1.0, 1.0, 3.0], 0, "", ""), (3, [1.0, 1.0, 3.0], 0, "", "")]
    bad = [(90, None, 0, "", ""), (91, [None, 1.0, 2.0], 0, "", ""), (92, [nan, 1.0, 2.0], 0, "", ""), (93, [1.0, -inf, 2.0], 0, "", ""), (94, [1.0, 2.0], 0, "", ""), (95, [], 0, "", "")]
    rows = whitening.whiten(spark.createDataFrame(good + odd + bad, kind).repartition(3)).collect()
    assert Counter(r.vec_id for r in rows) == Counter([r[0] for r in good + odd] * 2)  # the third dimension is constant
    assert rows[0].identity_error < 1e-9
    dev, white, _ = expected_whitening([r[1] for r in good + odd], 2)
    assert Counter(r.deviation for r in rows) == Counter(dev * 2)
    for rest in (bad, good[:1], [good[0]] * 5, []):
        assert whitening.whiten(spark.createDataFrame(rest, kind)).collect() == []


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(x), 1.0 * i]) for i, x in enumerate([3e38, -3e38, 0, 5, 1e12, 7e11])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.deviation for r in got} <= {None} and {r.vec_id for r in got} == set(range(6)) and got[0].identity_error < 1e-4
