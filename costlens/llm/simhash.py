"""SimHash near-duplicates through pivot distance tables.

Fingerprint: 64 bits over the shingles of a whole text (words [^\\x20\\x09-\\x0D]+,
A-Z lower-cased, repeats included); a bit is 1 if set in over half of the shingles'
XXH64 (UTF-8, seed 42). Fewer words than a shingle: the whole sequence is the one
shingle; no words: fingerprint zero, which links like any other.

Links: two fingerprints with at most ``max_bits`` differing bits. The 64 bits are
cut in ``max_bits + 3`` blocks; a linked pair agrees on at least three of them, so
distinct fingerprints meet under the keys of all block triples. For those that meet,
a pivot table holds the Hamming distances to ``PIVOTS`` fixed reference
fingerprints. By the triangle inequality a pair whose coordinates differ by more
than ``max_bits`` somewhere is no link; it is discarded on the table alone, and the
survivors are verified on the bits. A task reports a spanning forest of the links
it finds, never all pairs of a group. A key under which more than ``BLOCK``
fingerprints meet is dealt to one task per pair of its blocks.

Components: alternating large-star and small-star rounds on the forest edges, each
round cut to the shared folder. component_id is the smallest doc_id reachable.

Null text counts as empty. Rows with one doc_id count as one document. A row with
a null doc_id takes the component of its fingerprint and names none itself. Empty
table: no rows. Repeated rows give repeated rows."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from costlens.llm.common import cut, fresh, text_of

#: Reference fingerprints in the pivot table.
PIVOTS = 32
#: Fingerprints of one key that a task compares at once.
BLOCK = 4096
_CHUNK = 65_536


def fingerprint(text: str, n: int = 4) -> int:
    """The unsigned fingerprint of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(n, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), _CHUNK):
        h = np.array([xxh64_intdigest(line[a:b], 42) for a, b in zip(starts[i : i + _CHUNK], ends[i : i + _CHUNK], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every row."""
    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b["text"].to_pylist()), np.uint64, b.num_rows).view(np.int64)
            yield pa.record_batch([b["doc_id"], pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _masks(max_bits: int) -> list[int]:
    """A mask for each triple of blocks, as signed longs."""
    blocks = max_bits + 3
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [x - (1 << 64) if x >> 63 else x for x in (sum(c) for c in itertools.combinations(one, 3))]


def _pivots() -> np.ndarray:
    return np.array([xxh64_intdigest(i.to_bytes(4, "little"), 7) for i in range(PIVOTS)], np.uint64)


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of the component of each of ``n`` nodes under the links a-b."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root != root[root]).any():
            root = root[root]
    return root


def _compare(fp: np.ndarray, left: np.ndarray, right: np.ndarray, near: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs left-right are links: pivot table first, then the bits."""
    alive = np.arange(len(left))
    for column in near:
        alive = alive[np.abs(column[left[alive]] - column[right[alive]]) <= max_bits]
        if not len(alive):
            return alive
    return alive[np.bitwise_count(fp[left[alive]] ^ fp[right[alive]]) <= max_bits]


def _table(fp: np.ndarray) -> np.ndarray:
    return np.array([np.bitwise_count(fp ^ p).astype(np.int16) for p in _pivots()]).reshape(PIVOTS, len(fp))


def _forest(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between rows with one key; rows are sorted by key."""
    near, root = _table(fp), np.arange(len(fp))
    live, step = np.arange(len(fp)), 1
    while True:
        live = live[live + step < len(fp)]
        live = live[key[live] == key[live + step]]
        if not len(live):
            break
        found = live[_compare(fp, live, live + step, near, max_bits)]
        found = found[root[found] != root[found + step]]
        if len(found):
            root = roots(np.concatenate((np.arange(len(fp)), found)), np.concatenate((root, found + step)), len(fp))
        step += 1
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return linked, root[linked]


MET = "kind string, key long, mask int, block int, a long, b long"


def _met(kind, key=None, mask=None, block=None, a=None, b=None):
    n = len(a)
    full = lambda x, t: pa.array(np.full(n, 0 if x is None else x) if np.ndim(x) == 0 else x, t)
    return pa.record_batch([pa.array([kind] * n, pa.string()), full(key, pa.int64()), full(mask, pa.int32()), full(block, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "key", "mask", "block", "a", "b"])


def _meet(max_bits: int):
    """Links of the keys that fit a block, and the rows of the larger keys by block;
    batches come sorted by mask and key. A key is passed on as soon as it outgrows a
    block, so a task holds a block and a batch at most."""
    def later(mask, key, fp, rep, at):
        return _met("later", key, mask, (at // BLOCK).astype(np.int32), fp, rep)

    def links(mask, key, fp, rep):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        big = (size > BLOCK)[group]
        at = np.arange(len(key)) - np.flatnonzero(new)[group]
        if big.any():
            yield later(mask[big], key[big], fp[big], rep[big], at[big])
        w = np.flatnonzero((size > 1)[group] & ~big)
        if len(w):
            a, b = _forest(group[w], fp[w].view(np.uint64), max_bits)
            yield _met("link", a=rep[w][a], b=rep[w][b])

    def run(batches):
        held, large, passed = None, None, 0  # large: an unfinished key of which ``passed`` rows went on
        for batch in batches:
            rows = [batch[c].to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp", "rep")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if large is not None:
                n = int(((rows[0] == large[0]) & (rows[1] == large[1])).sum())
                if n:
                    yield later(*(x[:n] for x in rows), np.arange(passed, passed + n))
                    passed, rows = passed + n, [x[n:] for x in rows]
            if not len(rows[0]):
                continue
            edge = np.flatnonzero((rows[1] != rows[1][-1]) | (rows[0] != rows[0][-1]))
            ready = edge[-1] + 1 if len(edge) else 0
            if ready:
                yield from links(*(x[:ready] for x in rows))
            held, large = [x[ready:] for x in rows], None
            if len(held[0]) > BLOCK:
                large, passed = (held[0][0], held[1][0]), len(held[0])
                yield later(*held, np.arange(passed))
                held = None
        if held is not None:
            yield from links(*held)
    return run


def _between(max_bits: int):
    """Links within and between two blocks of one key."""
    def run(t: pa.Table) -> pa.Table:
        fp, rep = t["a"].to_numpy().view(np.uint64), t["b"].to_numpy()
        near, root = _table(fp), np.arange(len(fp))
        for i in range(len(fp) - 1):
            right = np.arange(i + 1, len(fp))
            right = right[root[right] != root[i]]
            found = right[_compare(fp, np.full(len(right), i), right, near, max_bits)]
            if len(found):
                low = min(root[i], root[found].min())
                root[np.isin(root, np.append(root[found], root[i]))] = low
        linked = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"a": rep[linked], "b": rep[root[linked]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return run


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Spanning links a-b between the ``rep`` of the distinct fingerprints ``fp``."""
    masks = F.array(*[F.lit(m) for m in _masks(max_bits)])
    keyed = distinct.select("fp", "rep", F.posexplode(masks).alias("mask", "bits"))
    keyed = keyed.select("mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"), "fp", "rep")
    met = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_meet(max_bits), MET)
    met = cut(met, "simhash-met")
    later = met.filter("kind = 'later'")
    blocks = later.groupBy("mask", "key").agg(F.max("block").alias("last"))
    dealt = later.join(blocks, ["mask", "key"]).withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    dealt = dealt.select("mask", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "a", "b").repartition("mask", "key", "i", "j")
    more = dealt.groupBy("mask", "key", "i", "j").applyInArrow(_between(max_bits), "a long, b long")
    return met.filter("kind = 'link'").select("a", "b").unionByName(more).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of the nodes of ``edges`` a-b."""
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = cut(small.filter("u <> v").distinct(), "edges")
        done = after.count() == now.count() and after.exceptAll(now).isEmpty()
        now = after
        if done:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def assign(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id."""
    rows = cut(fingerprints(docs, shingle), "fingerprints")
    own = rows.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).filter("doc_id IS NOT NULL AND x <> y")
    reps = rows.groupBy("fp").agg(F.min("doc_id").alias("rep")).filter("rep IS NOT NULL")
    reps = cut(reps, "fingerprint-reps")
    # the fingerprints of a doc_id that comes with several texts belong together
    same = rows.join(own.select("doc_id"), "doc_id").join(reps, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots_of = components(links(reps, max_bits).unionByName(same))
    labels = reps.join(roots_of, reps["rep"] == roots_of["node"], "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    labels = cut(labels, "fingerprint-labels")  # a plain join follows, whose hot partitions adaptive execution splits
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(labels, "fp", "left").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id;
    rows without a doc_id all stay. Of several texts under one doc_id the longest
    stays. All columns stay."""
    k, turn = fresh(docs, "keep_", "turn_")
    keep = assign(docs, shingle, max_bits).select(F.col("component_id").alias(k)).filter(F.col(k).isNotNull()).distinct()
    one = Window.partitionBy("doc_id").orderBy(F.length("text").desc(), F.xxhash64("text"))
    kept = docs.join(keep, docs["doc_id"] == keep[k], "left_semi").withColumn(turn, F.row_number().over(one)).filter(F.col(turn) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.filter("doc_id IS NULL"))
