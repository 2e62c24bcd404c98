"""Cross-entropy difference of a target and a background n-gram model.

Tokens are the words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased. Target: documents labelled of
good quality and not toxic. Background: every other document; no text is left out. Both
models count the same n-grams over whole texts, words (order 1) and pairs of a word and
the one before it (order 2), so the model grows with the corpus. They are matched: the
counts of the side with more tokens are scaled down to the total of the other. Both share
one vocabulary, the n-grams of the corpus, V of an order: with N tokens a side, an n-gram
counted c times has the probability (c + PSEUDO) / (N + PSEUDO V). A document's own n-grams
are left out of the counts that score it. Its loss is the mean over its tokens and the
orders of the negative log probabilities; ce_diff is the target loss less the background
loss, low for text like the target.

The count table is dealt by a hash of the n-gram into buckets of about BUCKET_BYTES of
text, never gathered: a task counts its documents' n-grams in batches and sends each
bucket the batch's part; the task of a bucket sums both sides, takes the documents' own
parts off and returns one partial loss per document. N-grams that are frequent within
batches, at most HOT of them, are counted in a pass before and scored where the documents
are, so no bucket holds a hot one; which are chosen has no bearing on the result. N-grams
are told apart by 64-bit hashes.

Labels of good documents up to BROADCAST_LABELS are broadcast, more are joined. Null or
empty text: no tokens, losses and difference null. A label with a null doc_id is left out;
a doc_id labelled twice is target if every label allows it. One side without tokens: both
models are uniform and ce_diff is 0. Empty table: no rows. Repeated rows count and are
scored each. A text of any length is one batch of its own. Extra columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import cut, text_of

PSEUDO = 0.1
#: N-grams scored by broadcast, and how many a batch may propose. A bucket of 8 MB of text
#: takes about 150 MB of a worker; a document has at most one partial loss per bucket and n-gram.
HOT, PROPOSED = 1 << 17, 1 << 13
BATCH_TOKENS, BATCH_DOCS = 200_000, 1 << 15
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 64
BROADCAST_LABELS = 4_000_000
ORDERS = 2


# --- n-grams of a batch ------------------------------------------------------------

def _mix(z: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits (the finisher of SplitMix64)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def ngrams(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """code and document of every n-gram of all orders; the lowest bit of a code is its
    order less one."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((w for t in texts for w in t), object, int(sizes.sum()))
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, stock = pd.factorize(words)
    word = pd.util.hash_array(np.asarray(stock, object), categorize=False)[codes]
    before = np.roll(word, 1)
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0  # the start of a document
    one = _mix(word + np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(1)
    two = _mix(_mix(before + np.uint64(0xD1B54A32D192ED03)) ^ word) | np.uint64(1)
    document = np.repeat(np.arange(len(texts)), sizes)
    return np.concatenate([one, two]), np.concatenate([document, document])


def _entries(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """code, document and count of every n-gram of each document, by code."""
    code, document = ngrams(texts)
    by = np.lexsort((document, code))
    code, document = code[by], document[by]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (document[1:] != document[:-1])
    at = np.flatnonzero(new)
    return code[at], document[at], np.diff(np.append(at, len(code)))


def _groups(batches):
    """(doc_ids, word lists, target flags) of about BATCH_TOKENS tokens."""
    ids, texts, roles, held = [], [], [], 0
    for b in batches:
        for i, t, target in zip(b["doc_id"].to_pylist(), b["text"], b["target"].to_pylist()):
            words = t.as_buffer().to_pybytes().lower().split()  # at ASCII white space alone
            if ids and (held + len(words) > BATCH_TOKENS or len(ids) == BATCH_DOCS):
                yield ids, texts, np.array(roles)
                ids, texts, roles, held = [], [], [], 0
            ids.append(i)
            texts.append(words)
            roles.append(target)
            held += len(words)
    if ids:
        yield ids, texts, np.array(roles)


# --- frequent n-grams and totals ---------------------------------------------------

def _propose(batches):
    for _, texts, _ in _groups(batches):
        code, _, n = _entries(texts)
        if len(code):
            at = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            total = np.add.reduceat(n, at)
            top = np.argsort(-total, kind="stable")[:PROPOSED]
            yield pa.RecordBatch.from_arrays([pa.array(code[at][top].view(np.int64)), pa.array(total[top])], names=["code", "n"])


def _count_hot(hot: np.ndarray):
    """Exact counts of the hot n-grams on both sides; at place -1 the tokens."""
    def run(batches):
        sides = np.zeros((2, len(hot) + 1), np.int64)
        for _, texts, target in _groups(batches):
            code, document, n = _entries(texts)
            place = np.searchsorted(hot, code)
            known = (place < len(hot)) & (hot[np.minimum(place, len(hot) - 1)] == code) if len(hot) else np.zeros(len(code), bool)
            tokens = np.array([len(t) for t in texts], np.int64)
            for side, mask in ((0, target), (1, ~target)):
                own = known & mask[document]
                sides[side, :-1] += np.bincount(place[own], n[own], len(hot)).astype(np.int64)
                sides[side, -1] += tokens[mask].sum()
        at = np.flatnonzero(sides.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == len(hot), -1, at)), pa.array(sides[0, at]), pa.array(sides[1, at])], names=["place", "target_n", "background_n"])
    return run


class Counts:
    """Loss of n-grams under both matched models, up to the vocabulary's share."""

    def __init__(self, target: int, background: int):
        self.total = min(target, background)
        self.scales = [self.total / max(1, target), self.total / max(1, background)]

    def losses(self, n, own_target, counts) -> list[np.ndarray]:
        """For both sides, -n log(count + PSEUDO) with the document's own n taken off
        the side it belongs to."""
        own = (n * own_target, n * ~own_target)
        return [-n * np.log((c - o) * s + PSEUDO) for c, o, s in zip(counts, own, self.scales)]


# --- buckets -----------------------------------------------------------------------

_SENT = "bucket int, row long, doc_id long, n_tokens long, target double, background double, blob binary"
_SUMS = "row long, doc_id long, n_tokens long, target double, background double, one long, two long"


def _send(hot: np.ndarray, counts: list[np.ndarray], model: Counts, buckets: int):
    """A row for each document with its loss over hot n-grams, and for each batch and
    bucket its other n-grams: codes, 2 x document + side, and counts of at most 255."""
    schema = pa.schema([("bucket", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target", pa.float64()), ("background", pa.float64()), ("blob", pa.binary())])

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        for ids, texts, target in _groups(batches):
            code, document, n = _entries(texts)
            place = np.minimum(np.searchsorted(hot, code), max(0, len(hot) - 1))
            known = hot[place] == code if len(hot) else np.zeros(len(code), bool)
            parts = model.losses(n[known], target[document[known]], [c[place[known]] for c in counts])
            sums = [np.bincount(document[known], p, len(ids)) for p in parts]
            rows = base + np.arange(len(ids))
            yield pa.RecordBatch.from_arrays([
                pa.array((rows % buckets).astype(np.int32)), pa.array(rows), pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array(sums[0]), pa.array(sums[1]), pa.nulls(len(ids), pa.binary())], schema=schema)
            code, mark, n = code[~known], (document[~known] * 2 + target[document[~known]]).astype("<u2"), n[~known]
            times = (n + 254) // 255
            if len(n) and times.max() > 1:  # a larger count goes in several parts
                at = np.repeat(np.arange(len(n)), times)
                last = np.append(at[1:] != at[:-1], True)
                code, mark, n = code[at], mark[at], np.where(last, n[at] - 255 * (times[at] - 1), 255)
            bucket = ((code >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            code, mark, n = code[by].astype("<u8"), mark[by], n[by].astype("<u1")
            ends = np.searchsorted(bucket[by], np.arange(buckets + 1))
            spans = [(k, a, z) for k, (a, z) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())) if z > a]
            blobs = [code[a:z].tobytes() + mark[a:z].tobytes() + n[a:z].tobytes() for _, a, z in spans]
            none = len(spans)
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _, _ in spans], pa.int32()), pa.array([base] * none, pa.int64()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()),
                pa.nulls(none, pa.float64()), pa.nulls(none, pa.float64()), pa.array(blobs, pa.binary())], schema=schema)
            base += len(ids)
    return run


def _score_bucket(blobs: list[tuple[int, bytes]], model: Counts) -> pa.RecordBatch:
    codes, rows, sides, counts = [], [], [], []
    for base, blob in blobs:
        m = len(blob) // 11
        mark = np.frombuffer(blob, "<u2", m, 8 * m)
        codes.append(np.frombuffer(blob, "<u8", m))
        rows.append(base + (mark >> 1).astype(np.int64))
        sides.append(mark & 1)
        counts.append(np.frombuffer(blob, "<u1", m, 10 * m))
    code, row, target, n = (np.concatenate(x) for x in (codes, rows, sides, counts))
    by = np.lexsort((row, code))
    code, row, target, n = code[by], row[by], target[by].astype(bool), n[by].astype(np.int64)
    at = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])))  # parts of one count
    code, row, target, n = code[at], row[at], target[at], np.add.reduceat(n, at)
    first = np.append(True, code[1:] != code[:-1])
    at, which = np.flatnonzero(first), np.cumsum(first) - 1
    sums = [np.add.reduceat(n * side, at)[which] for side in (target, ~target)]
    losses = model.losses(n, target, sums)
    found, of = np.unique(row, return_inverse=True)
    odd = int((code[at] & np.uint64(1)).sum())
    none = pa.nulls(len(found) + 1, pa.int64())
    zero = np.zeros(len(found), np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.append(found, -1)), none, none, *(pa.array(np.append(np.bincount(of, x, len(found)), 0.0)) for x in losses),
        pa.array(np.append(zero, len(at) - odd)), pa.array(np.append(zero, odd))], names=["row", "doc_id", "n_tokens", "target", "background", "one", "two"])


def _score(model: Counts):
    """Rows of documents as they are; the blobs of a bucket as the documents' partial
    losses, and at row -1 its distinct n-grams of each order."""
    def run(batches):
        held, at = [], None
        for b in batches:
            docs = b.filter(b["blob"].is_null())
            if docs.num_rows:
                zero = pa.array(np.zeros(docs.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([docs[c] for c in ("row", "doc_id", "n_tokens", "target", "background")] + [zero, zero], names=["row", "doc_id", "n_tokens", "target", "background", "one", "two"])
            rest = b.filter(b["blob"].is_valid())
            for k, base, blob in zip(rest["bucket"].to_pylist(), rest["row"].to_pylist(), rest["blob"].to_pylist()):
                if k != at and held:
                    yield _score_bucket(held, model)
                    held = []
                at = k
                held.append((base, blob))
        if held:
            yield _score_bucket(held, model)
    return run


# --- the whole -----------------------------------------------------------------------

def roles(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text (as bytes) and target (boolean) of every document."""
    good = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("good_id")).agg(
        F.min((F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good")).filter("good").select("good_id", F.lit(True).alias("target"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)
    marked = rows.join(good, rows["doc_id"] == good["good_id"], "left")
    return marked.select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, target_loss, background_loss,
    ce_diff."""
    rows = roles(docs, labels)
    size = docs.agg(F.sum(F.octet_length(text_of(docs)))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-int(size) // BUCKET_BYTES))
    proposed = rows.mapInArrow(_propose, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    hot = np.sort(np.array([r["code"] for r in proposed.orderBy(F.desc("n"), "code").limit(HOT).collect()], np.int64).view(np.uint64))
    counted = rows.mapInArrow(_count_hot(hot), "place long, target_n long, background_n long").groupBy("place").agg(
        F.sum("target_n").alias("target_n"), F.sum("background_n").alias("background_n")).collect()  # HOT + 1 rows at most
    sides, tokens = [np.zeros(len(hot), np.int64) for _ in range(2)], (0, 0)
    for r in counted:
        if r["place"] < 0:
            tokens = (r["target_n"], r["background_n"])
        else:
            sides[0][r["place"]], sides[1][r["place"]] = r["target_n"], r["background_n"]
    model = Counts(*tokens)
    sent = rows.mapInArrow(_send(hot, sides, model, buckets), _SENT)
    scored = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_score(model), _SUMS)
    sums = cut(scored.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("target").alias("target"), F.sum("background").alias("background"),
        F.sum("one").alias("one"), F.sum("two").alias("two")), "losses")
    seen = sums.filter("row = -1").select("one", "two").first() or (0, 0)
    odd = int((hot & np.uint64(1)).sum())
    share = sum(float(np.log(model.total + PSEUDO * v)) if v else 0.0 for v in (seen[0] + len(hot) - odd, seen[1] + odd))
    loss = lambda c: F.when(F.col("n_tokens") > 0, (F.col(c) / F.col("n_tokens") + share) / ORDERS)
    out = sums.filter("row >= 0").select("doc_id", "n_tokens", loss("target").alias("target_loss"), loss("background").alias("background_loss"))
    return out.withColumn("ce_diff", F.col("target_loss") - F.col("background_loss"))
