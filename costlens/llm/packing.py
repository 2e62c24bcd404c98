"""Conflict-constrained best-fit packing into sequences of a fixed number of ids.

Pieces are documents; one longer than the capacity first fills whole bins, and its
rest is a piece. Documents are dealt by a hash of doc_id and text to shards of about
SHARD_DOCS; a shard is packed by one task from four numbers a document. Within it,
pieces go by falling size, then doc_id. Open bins are ordered by residual; a bin
carries a bitmap of its sources and one of its duplicate clusters, and a piece may
not join a bin that has its source or its cluster. The search starts at the
smallest residual that holds the piece and moves on to the next larger one until a
compatible bin is found: the tightest. Bins of one residual and one source bitmap
are kept together, so a hot source is passed over by bitmaps and not by bins.

Cluster: equal text after deleting the characters of [\\x20\\x09-\\x0D]. Size: ids of
the whole text with the byte-level BPE, and one end id. Null text counts as empty
(one id); a null source is a source of its own. Empty table: no rows. Repeated rows
are documents of one cluster. Extra columns are ignored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import cut, text_of, without_blanks
from costlens.llm.token_frames import VOCABULARY, encoder

CAPACITY = 2048
SHARD_DOCS = 4096

PLACED = "doc_id long, piece int, shard int, bin int, start int, n_tokens int"


class Bins:
    """Open bins of one shard, ordered by residual."""

    def __init__(self, capacity: int):
        self.capacity, self.count = capacity, 0
        self.open: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(capacity + 1)]
        self.used = 0  # bit r: some bin has the residual r

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin for a piece and where it starts there. ``source`` and ``cluster``
        are bits; a cluster of zero clashes with none."""
        above = self.used >> size
        residual = size
        while above:
            skip = (above & -above).bit_length() - 1
            residual, above = residual + skip, above >> skip
            kinds = self.open[residual]
            for sources, bins in kinds.items():
                if sources & source:
                    continue
                at = next((i for i, (_, held) in enumerate(bins) if not held & cluster), None)
                if at is not None:
                    number, held = bins.pop(at)
                    if not bins:
                        del kinds[sources]
                    if not kinds:
                        self.used &= ~(1 << residual)
                    self._keep(residual - size, sources | source, number, held | cluster)
                    return number, self.capacity - residual
            residual, above = residual + 1, above >> 1
        self.count += 1
        self._keep(self.capacity - size, source, self.count - 1, cluster)
        return self.count - 1, 0

    def _keep(self, residual: int, sources: int, number: int, clusters: int) -> None:
        if residual:
            self.open[residual].setdefault(sources, []).append((number, clusters))
            self.used |= 1 << residual


def pack_shard(ids, sizes, sources, clusters, capacity: int):
    """(row, piece, bin, start, size) for every piece of the rows of a shard."""
    rest = [s % capacity for s in sizes]
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    seen: dict[int, int] = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    shared = {c: 1 << i for i, c in enumerate(c for c, n in seen.items() if n > 1)}
    order = sorted(range(len(sizes)), key=lambda i: (-rest[i], ids[i] is None, ids[i] or 0, clusters[i]))
    bins, out = Bins(capacity), []
    for i in order:
        full = sizes[i] // capacity
        if rest[i]:
            number, start = bins.place(rest[i], source_bit[sources[i]], shared.get(clusters[i], 0))
            out.append((i, full, number, start, rest[i]))
    for i in order:
        for piece in range(sizes[i] // capacity):
            out.append((i, piece, bins.count, 0, capacity))
            bins.count += 1
    return out


def _pack(capacity: int):
    def run(t: pa.Table) -> pa.Table:
        ids, shard = t["doc_id"].to_pylist(), t["shard"][0].as_py()
        out = pack_shard(ids, t["n_tokens"].to_pylist(), t["source"].to_pylist(), t["cluster"].to_pylist(), capacity)
        rows = np.array(out, np.int64).reshape(-1, 5)
        columns = [pa.array([ids[i] for i in rows[:, 0]], pa.int64()), pa.array(rows[:, 1], pa.int32()), pa.array(np.full(len(rows), shard), pa.int32()), *(pa.array(rows[:, k], pa.int32()) for k in (2, 3, 4))]
        return pa.table(columns, names=["doc_id", "piece", "shard", "bin", "start", "n_tokens"])
    return run


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, cluster, n_tokens of every row."""
    def run(batches):
        for b in batches:
            n = [n + 1 for n in encoder(vocabulary).count_each(b["text"].to_pylist())]
            yield pa.record_batch([b["doc_id"], b["source"], b["cluster"], pa.array(n, pa.int64())], names=["doc_id", "source", "cluster", "n_tokens"])

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        F.xxhash64(without_blanks(text_of(docs))).alias("cluster"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, cluster long, n_tokens long")


def pack_lengths(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack rows of doc_id, source, cluster, n_tokens."""
    rows = cut(rows, "lengths")
    shards = max(1, math.ceil(rows.count() / SHARD_DOCS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "n_tokens"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(_pack(capacity), PLACED)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, shard, bin, start, n_tokens. (shard, bin)
    names a sequence; piece k of a document holds its ids from k * capacity."""
    return pack_lengths(lengths(docs, vocabulary), capacity)
