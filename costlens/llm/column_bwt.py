"""Removal of repeated 100-byte strings with a column-wise multi-document BWT.

A byte goes if some string of LENGTH bytes over it also starts earlier: in a smaller
doc_id, or at an earlier start of the same document. Documents are the UTF-8 bytes
of whole texts; strings never cross them and are judged on the input.

1. Of documents with equal bytes only the first takes part; the others go whole.
2. Anchors: in every window of LENGTH bytes the K-byte string of smallest hash,
   leftmost first. Equal windows have equal anchors at equal offsets, so only windows
   whose anchor occurs again can repeat. A task sends one row per anchor to the
   count; further ones that it holds itself are known to repeat.
3. The windows of one anchor occurrence in a row are a segment. Equal segments are
   folded, first within the task that cuts them, then by key: all but the earliest go.
   Segments with an anchor of their own, or alone with it, cannot repeat.
4. Different segments with one anchor form small collections. A collection is
   indexed column by column: each round inserts the next symbol from the right of
   every segment, updating the Burrows-Wheeler transform and the common prefix
   lengths of all suffixes so far in one sequential pass. Neighbouring suffixes that
   share LENGTH bytes are equal windows; all but the earliest go.
   An anchor with more than POOL segments is not held: its windows are dealt anew, by
   the bytes that 16 windows in a row share, and if need be by whole windows.
5. Removed ranges meet their document, which gives counts and the hash of the rest.

Null text counts as empty. A null doc_id comes last. Rows with equal doc_id and
text are one document; different texts under one doc_id follow each other by
SHA-256. Empty table: no rows. Repeated rows give repeated rows. Extra columns are
ignored."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from costlens.llm.common import cut, text_of

LENGTH, K = 100, 24
#: Windows of a segment at most: by anchor, then by what so many windows share.
BLOCKS = (LENGTH - K + 1, 16, 1)
#: Different segments of one anchor that a task holds, and of one collection.
POOL, COLLECTION = 4096, 8192
#: Bytes whose anchors are sought at once, and of segments that a task holds.
_BATCH, _HELD = 1 << 21, 1 << 25
_NULL_ID = (1 << 63) - 1
_STEP = 0x9E3779B97F4A7C15

ANCHOR = "route long, id long, turn int, place long, known boolean"


def _hashes(x: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of the K bytes from each place on."""
    power = [_STEP]
    for _ in range(4):
        power.append(power[-1] ** 2 % (1 << 64))
    h = x.astype(np.uint64) + np.uint64(1)
    for i in range(3):
        h = h[: -(1 << i)] * np.uint64(power[i]) + h[1 << i :]
    eight, n = h, len(x) - K + 1  # K is 8 + 8 + 8
    h = eight[:n] * np.uint64(power[4]) + eight[8 : 8 + n] * np.uint64(power[3]) + eight[16 : 16 + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def anchors(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """hash, document, anchor, first and last window start of each run of windows
    with one anchor, in documents that end at ``ends`` of the bytes ``x``."""
    h = _hashes(x)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size, width = 1, LENGTH - K + 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(at)]
    starts = np.flatnonzero(np.arange(len(at)) + LENGTH <= ends[doc])
    at = at[starts]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return h[at[first]], doc[starts[first]], at[first], starts[first], starts[last]


def _find_anchors(batches):
    def rows(ids, turns, texts):
        ends = np.cumsum([len(t) for t in texts])
        key, doc, at, a, b = anchors(np.frombuffer(b"".join(texts), np.uint8), ends)
        base = (ends - [len(t) for t in texts])[doc]
        place = (at - base) << 16 | (at - a) << 8 | (at - b)
        _, first, inverse, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        lead = np.zeros(len(key), bool)
        lead[first] = True
        spread = (np.arange(len(key), dtype=np.uint64) * np.uint64(_STEP)) ^ key
        route = np.where(lead, key, spread).view(np.int64)
        return pa.record_batch([pa.array(route), pa.array(np.array(ids, np.int64)[doc]), pa.array(np.array(turns, np.int32)[doc]), pa.array(place), pa.array(n[inverse] > 1)], names=["route", "id", "turn", "place", "known"])

    held, size = ([], [], []), 0
    for b in batches:
        for i, u, t in zip(b["id"].to_pylist(), b["turn"].to_pylist(), b["text"].to_pylist(), strict=True):
            raw = t.encode("utf-8", "surrogatepass")
            for column, value in zip(held, (i, u, raw), strict=True):
                column.append(value)
            size += len(raw)
            if size >= _BATCH:
                yield rows(*held)
                held, size = ([], [], []), 0
    if held[0]:
        yield rows(*held)


def _repeated(batches):
    """The anchors that occur again; batches come sorted by route. A route holds at
    most a row of every task besides rows known to repeat."""
    def out(t):
        route, known = t["route"].to_numpy(), t["known"].to_numpy(zero_copy_only=False)
        new = np.ones(len(route), bool)
        new[1:] = route[1:] != route[:-1]
        group = np.cumsum(new) - 1
        again = known | (np.bincount(group) > 1)[group]
        return t.filter(pa.array(again)).select(["id", "turn", "place"]).combine_chunks().to_batches()

    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*(held.to_batches() if held else []), b])
        route = t["route"].to_numpy()
        edge = np.flatnonzero(route != route[-1])
        ready = int(edge[-1]) + 1 if len(edge) else 0
        if ready:
            yield from out(t.slice(0, ready).combine_chunks())
        held = t.slice(ready)
    if held is not None:
        yield from out(held.combine_chunks())


def blocks(segment: bytes, anchor: int, width: int):
    """(key, first window, part, bytes that all its windows would share) of the parts
    of ``width`` windows in a row, counted from the anchor, of a segment."""
    last = len(segment) - LENGTH
    for q in range((anchor - last) // width, anchor // width + 1):
        high = anchor - q * width
        low = high - width + 1
        a, b = max(low, 0), min(high, last)
        if a <= b:
            yield q, a, segment[a : b + LENGTH], segment[high : low + LENGTH]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _batch(columns: list[str], rows: list[tuple]) -> pa.RecordBatch:
    types = {"later": pa.bool_(), "key": pa.int64(), "segment": pa.binary(), "anchor": pa.int32(), "id": pa.int64(), "turn": pa.int32(), "start": pa.int64(), "stop": pa.int64()}
    values = zip(*rows, strict=True) if rows else [()] * len(columns)
    return pa.record_batch([pa.array(v, types[c]) for c, v in zip(columns, values, strict=True)], names=columns)


_PIECE = ["key", "segment", "anchor", "id", "turn", "start", "stop"]
_FOUND = ["later", *_PIECE]


def _cut_segments(batches):
    """Segments of the repeated anchors, folded within the task. Ranges that go
    already travel without a segment, under keys of their own."""
    first: dict[tuple[int, bytes, int], tuple[int, int, int]] = {}
    held = 0

    def rows():
        return _batch(_PIECE, [(k, s, a, *at, at[2] + len(s)) for (k, s, a), at in first.items()])

    for b in batches:
        gone = []
        for i, u, text, places in zip(b["id"].to_pylist(), b["turn"].to_pylist(), b["text"].to_pylist(), b["places"].to_pylist(), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            for place in set(places):
                at = place >> 16
                a, stop = at - (place >> 8 & 255), at - (place & 255) + LENGTH
                here, segment = (i, u, a), raw[a:stop]
                name = (_signed(xxh64_intdigest(raw[at : at + K])), segment, at - a)
                there = first.setdefault(name, here)
                if there == here:
                    held += stop - a
                    continue
                if here < there:
                    first[name], here = here, there
                gone.append((_signed(xxh64_intdigest(segment, here[2] & 0xFFFF)), None, None, *here, here[2] + stop - a))
        if gone:
            yield _batch(_PIECE, gone)
        if held > _HELD:
            yield rows()
            first.clear()
            held = 0
    if first:
        yield rows()


class Columns:
    """Burrows-Wheeler transform and common prefixes of a collection, built from the
    last column to the first. ``symbol`` is the transform (rank of the byte before a
    suffix, 0 at a start), ``doc`` and ``size`` name the suffix, ``shared`` is its
    common prefix with the suffix before it."""

    def __init__(self, texts: list[bytes]):
        self.length = np.array([len(t) for t in texts], np.int32)
        longest, m = int(self.length.max()), len(texts)
        used = np.unique(np.frombuffer(b"".join(texts), np.uint8))
        rank = np.zeros(256, np.uint16)
        rank[used] = np.arange(1, len(used) + 1)
        kind = np.uint8 if len(used) < 256 else np.uint16
        self.column = np.zeros((longest + 1, m), kind)  # column j: the symbol j from the right
        raw = np.frombuffer(b"".join(t[::-1].ljust(longest, b"\0") for t in texts), np.uint8).reshape(m, longest)
        self.column[:longest] = np.where(np.arange(longest)[:, None] < self.length[None, :], rank[raw].T, 0)
        self.symbol, self.doc = self.column[0].copy(), np.arange(m, dtype=np.int32)
        self.size, self.shared = np.zeros(m, np.int16), np.zeros(m + 1, np.int16)
        self.newest = self.symbol != 0
        for j in range(1, longest + 1):
            self._insert(j, m)

    def _insert(self, j: int, m: int) -> None:
        """Insert the suffixes of size ``j``."""
        order = np.argsort(self.symbol, kind="stable")
        order = order[np.searchsorted(self.symbol[order], 1) :]  # where the suffixes that begin with each symbol come from
        new = self.newest[order]
        old = np.concatenate((np.ones(m, bool), ~new))
        total = m + len(order)
        doc, size, symbol = np.empty(total, np.int32), np.empty(total, np.int16), np.empty(total, self.symbol.dtype)
        shared = np.zeros(total + 1, np.int16)
        fresh = np.flatnonzero(new)
        doc[old], size[old], symbol[old], shared[:-1][old] = self.doc, self.size, self.symbol, self.shared[:-1]
        source = order[fresh]
        at = fresh + m
        doc[at], size[at] = self.doc[source], j
        symbol[at] = self.column[j][doc[at]]
        # prefixes change at the new suffixes and right after them
        touched = np.zeros(len(order) + 1, bool)
        touched[fresh] = True
        touched[fresh + 1] = True
        touched = np.flatnonzero(touched[:-1])
        first = self.symbol[order]
        inner = touched[touched > 0]
        inner = inner[first[inner] == first[inner - 1]]
        shared[m + touched] = 0
        if len(inner):
            low, high = order[inner - 1] + 1, order[inner] + 1
            back = np.argsort(-low, kind="stable")  # from the end, so that only the ranges asked for are read
            spans = np.column_stack((low[back], high[back])).ravel()
            shared[m + inner[back]] = np.minimum.reduceat(self.shared, spans)[::2] + 1
        newest = np.zeros(total, bool)
        newest[at] = symbol[at] != 0
        self.doc, self.size, self.symbol, self.shared, self.newest = doc, size, symbol, shared, newest


def repeats(parts: list[tuple[bytes, int, int, int]]):
    """(id, turn, start, stop) of the windows of ``parts`` (bytes, id, turn, start)
    that are not the earliest of their kind, in ranges."""
    index = Columns([p[0] for p in parts])
    group = np.cumsum(index.shared[:-1] < LENGTH)
    whole = np.flatnonzero(index.size >= LENGTH)
    group, doc = group[whole], index.doc[whole]
    ids, turns, starts = (np.array([p[k] for p in parts], np.int64) for k in (1, 2, 3))
    i, u, at = ids[doc], turns[doc], starts[doc] + index.length[doc] - index.size[whole]
    order = np.lexsort((at, u, i, group))
    group, i, u, at = group[order], i[order], u[order], at[order]
    head = np.ones(len(group), bool)
    head[1:] = group[1:] != group[:-1]
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    gone = (i != i[lead]) | (u != u[lead]) | (at != at[lead])
    i, u, at = i[gone], u[gone], at[gone]
    order = np.lexsort((at, u, i))
    i, u, at = i[order], u[order], at[order]
    if not len(at):
        return
    new = np.ones(len(at), bool)
    new[1:] = (i[1:] != i[:-1]) | (u[1:] != u[:-1]) | (at[1:] > at[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(at)) - 1
    yield from zip(i[a].tolist(), u[a].tolist(), at[a].tolist(), (at[b] + LENGTH).tolist(), strict=True)


def _compare(width: int, pool: int, collected: int):
    """Ranges that go, from segments sorted by key, bytes and place; the segments of
    keys beyond POOL come out again in parts of ``width`` windows."""
    def gone(i, u, start, stop):
        return (False, None, None, None, i, u, start, stop)

    def later(segment, anchor, i, u, start):
        for q, a, part, core in blocks(segment, anchor, width):
            yield True, _signed(xxh64_intdigest(core, q & 0xFFFF)), part, anchor - a, i, u, start + a, start + a + len(part)

    def split(segments, out):
        """The parts of one key that differ but share what all their windows share."""
        cores: dict = {}
        for segment, anchor, i, u, start in segments:
            for q, a, part, core in blocks(segment, anchor, BLOCKS[1]):
                here, slot = (i, u, start + a), cores.setdefault((q, core), {})
                there = slot.setdefault(part, here)
                if there != here:
                    if here < there:
                        slot[part], here = here, there
                    out.append(gone(*here, here[2] + len(part)))
        return [(part, *at) for slot in cores.values() if len(slot) > 1 for part, at in slot.items()]

    def run(batches):
        key, segments, over, collection, out = None, [], False, [], []
        last = None
        for b in batches:
            for k, segment, anchor, i, u, start, stop in zip(*(b[c].to_pylist() for c in _PIECE), strict=True):
                if segment is None:
                    out.append(gone(i, u, start, stop))
                    continue
                if k != key:
                    if len(segments) > 1:
                        collection += split(segments, out)
                        if len(collection) >= collected:
                            out += [gone(*r) for r in repeats(collection)]
                            collection = []
                    key, segments, over, last = k, [], False, None
                if last is not None and segment == last[0]:
                    if (i, u, start) != last[1:]:
                        out.append(gone(i, u, start, stop))
                    continue
                last = (segment, i, u, start)
                if over:
                    out += later(segment, anchor, i, u, start)
                    continue
                segments.append((segment, anchor, i, u, start))
                if len(segments) > pool and width:
                    for s in segments:
                        out += later(*s)
                    segments, over = [], True
            if out:
                yield _batch(_FOUND, out)
                out = []
        if len(segments) > 1:
            collection += split(segments, out)
        if collection:
            out += [gone(*r) for r in repeats(collection)]
        if out:
            yield _batch(_FOUND, out)
    return run


def _remove(batches):
    for b in batches:
        got = []
        for text, ranges in zip(b["text"].to_pylist(), b["ranges"].to_pylist(), strict=True):
            raw, kept, at, spans, end = text.encode("utf-8", "surrogatepass"), [], 0, 0, -1
            for r in sorted((r["start"], r["stop"]) for r in ranges):
                if r[0] > end:
                    kept.append(raw[at : r[0]])
                    spans += 1
                end = at = max(end, r[1])
            kept = b"".join(kept) + raw[at:]
            got.append((len(raw) - len(kept), spans, sha256(kept).hexdigest()))
        n, spans, digest = zip(*got, strict=True) if got else ((), (), ())
        yield pa.record_batch([b["id"], b["digest"], pa.array(n, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], names=["id", "digest", "n_removed", "n_spans", "kept_sha256"])


_PIECE_TYPE = "key long, segment binary, anchor int, id long, turn int, start long, stop long"


def _compared(pieces: DataFrame, width: int, pool: int, collected: int) -> DataFrame:
    dealt = pieces.select(*_PIECE).repartition("key").sortWithinPartitions("key", "segment", "id", "turn", "start")
    return cut(dealt.mapInArrow(_compare(width, pool, collected), f"later boolean, {_PIECE_TYPE}"), "repeats")


def remove_repeats(docs: DataFrame, pool: int = POOL, collected: int = COLLECTION) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256."""
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_NULL_ID)).alias("id"), docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    slim = cut(rows.select("id", "doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "bytes")
    own = slim.filter(F.col("n_bytes") >= LENGTH).select("id", "digest").distinct()
    own = own.withColumn("turn", F.row_number().over(Window.partitionBy("id").orderBy("digest")) - 1)
    firsts = cut(own.groupBy("digest").agg(F.min(F.struct("id", "turn")).alias("f"), F.count(F.lit(1)).alias("n")).select("f.id", "f.turn", "digest", "n"), "firsts")
    chosen = firsts.select("id", "turn", "digest")
    texts = rows.select("id", "digest", "text")

    # Sorted, so that a task run again makes the same batches, routes and keys.
    met = texts.join(chosen.hint("shuffle_hash"), ["id", "digest"]).select("id", "turn", "text").sortWithinPartitions("id", "turn").mapInArrow(_find_anchors, ANCHOR)
    met = met.repartition("route").sortWithinPartitions("route").mapInArrow(_repeated, "id long, turn int, place long")
    places = met.groupBy("id", "turn").agg(F.collect_list("place").alias("places")).join(chosen, ["id", "turn"])
    pieces = texts.join(places.hint("shuffle_hash"), ["id", "digest"]).select("id", "turn", "text", "places").sortWithinPartitions("id", "turn").mapInArrow(_cut_segments, _PIECE_TYPE)
    found = _compared(pieces, BLOCKS[1], pool, collected)
    ranges = found.filter("NOT later")
    for width in (BLOCKS[2], 0):  # parts of one window are equal under one key and never pool
        rest = found.filter("later")
        if rest.isEmpty():
            break
        found = _compared(rest, width, pool, collected)
        ranges = ranges.unionByName(found.filter("NOT later"))

    by_doc = ranges.groupBy("id", "turn").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")).join(chosen, ["id", "turn"])
    cleaned = texts.join(by_doc.hint("shuffle_hash"), ["id", "digest"]).select("id", "digest", "text", "ranges").mapInArrow(
        _remove, "id long, digest binary, n_removed long, n_spans long, kept_sha256 string").dropDuplicates(["id", "digest"])
    copied = firsts.filter("n > 1").select("digest", F.col("id").alias("first_id"))
    out = slim.join(copied, "digest", "left").join(cleaned, ["id", "digest"], "left")
    copy = F.coalesce(F.col("id") != F.col("first_id"), F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"))
