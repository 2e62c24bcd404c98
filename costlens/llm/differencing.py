"""Sharding by Karmarkar-Karp differencing.

Rows of equal text (null counts as the empty text) form a group, which stays whole; its
size is the bytes of its rows and ``ROW_BYTES`` more for each. Differencing starts from
one partial partition per group, a tuple of one size and zeros. It takes the two with
the largest spread (largest less smallest sum), adds the largest slots of one to the
smallest of the other, and puts the result back, until one is left.

Over all groups that order is sequential, so it is kept by size classes: each class
holds groups up to 64 times smaller than the class before, from the largest down, and
its groups are dealt by hash into blocks of about ``BLOCK`` that are differenced at the
same time. Every block starts from one partial partition more, its share of the sums
that the classes before have left: what is uneven there is evened by smaller groups, and
a group above a shard's fair share gets no company until the other shards have caught
up. A block of 2,048 groups weighs at least 32 times the largest group of its class, so
what a block leaves uneven is in the order of its smallest groups, and the next class
evens that in turn. Tasks get one block each; the driver gets the sums of the shards and
the number of groups of each class.

Law ``bytes``: sums near equal as far as whole groups allow; shards may be as uneven as
the largest group. Slots number the rows of a shard without gaps from 0. Rows of null
text have the size ``ROW_BYTES`` and crc32 0. Rows repeated or without an id: each has a
slot. Ties between equal sums and spreads go by place, and equal groups by digest.
Empty table: no rows. Other columns, whatever their names, are ignored."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import cut, text_of

#: Bytes of a row beside its text; groups that are differenced together; ratio of sizes within a class.
ROW_BYTES, BLOCK, RATIO = 16, 2048, 64
#: A group with more than a row in so many is handed its shard by broadcast; there are fewer than this many.
HEAVY = 1000


def difference(sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The slot of each of ``sizes`` after differencing them together with the
    partial partition ``before``, whose slots keep their numbers."""
    k = len(before)
    first = np.argsort(-before, kind="stable")
    sums = [np.concatenate([[x], np.zeros(k - 1, np.int64)]) for x in sizes.tolist()] + [before[first] - before.min()]
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joined = []  # (left, right, place in the joined tuple of each rank)
    while len(heap) > 1:
        left, right = heapq.heappop(heap)[1], heap[0][1]
        both = sums[left] + sums[right][::-1]
        by = np.argsort(-both, kind="stable")
        both = both[by]
        sums.append(both - both[-1])
        sums[left] = sums[right] = None
        heapq.heapreplace(heap, (int(both[-1] - both[0]), len(sums) - 1))
        joined.append((left, right, by))
    slot = np.empty((len(sums), k), np.int64)  # of each rank of each partial partition
    slot[-1] = np.arange(k)
    at = len(sums) - 1
    for left, right, by in reversed(joined):
        own = np.empty(k, np.int64)
        own[by] = slot[at]
        slot[left], slot[right] = own, own[::-1]
        at -= 1
    number = np.empty(k, np.int64)
    number[slot[len(sizes)]] = first
    return number[slot[:len(sizes), 0]]


def _block(left: list[int], blocks: int):
    """Differences one block; ``left`` are the sums so far, dealt out over the blocks."""
    def run(t: pa.Table) -> pa.Table:
        b = t["block"][0].as_py()
        before = np.array([x * (b + 1) // blocks - x * b // blocks for x in left], np.int64)
        t = t.sort_by([("bytes", "descending"), ("digest", "ascending")])
        shard = difference(t["bytes"].to_numpy(), before)
        return t.select(["digest", "bytes", "n"]).append_column("shard", pa.array(shard.astype(np.int32)))
    return run


def place_groups(groups: DataFrame, shards: int) -> DataFrame | None:
    """digest, bytes, n and shard of ``groups`` (digest, bytes, n); None if there are none."""
    whole = groups.agg(F.sum("bytes")).first()[0]
    if whole is None:
        return None
    steps, step = [], int(whole) // RATIO
    while step >= ROW_BYTES:
        steps.append(step)
        step //= RATIO
    level = sum((F.when(F.col("bytes") <= s, 1).otherwise(0) for s in steps), F.lit(0))
    groups = groups.withColumn("level", level)
    left, out = [0] * shards, None
    for level, count in sorted((r["level"], r["count"]) for r in groups.groupBy("level").count().collect()):
        blocks = -(-count // BLOCK)
        own = groups.filter(F.col("level") == level).withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int"))
        placed = own.select("block", "digest", "bytes", "n").groupBy("block").applyInArrow(_block(left, blocks), "digest binary, bytes long, n long, shard int")
        placed = cut(placed, "differenced")
        for r in placed.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():
            left[r["shard"]] += r["bytes"]
        out = placed if out is None else out.unionByName(placed)
    return out


def _number(batches):
    """Adds the task and the place among the task's rows of the same shard."""
    seen: dict[int, int] = {}
    task = TaskContext.get().partitionId()
    for b in batches:
        shard = b.column(b.schema.get_field_index("shard")).to_numpy()
        place = np.empty(len(shard), np.int64)
        by = np.argsort(shard, kind="stable")
        values, at, count = np.unique(shard[by], return_index=True, return_counts=True)
        for v, a, c in zip(values.tolist(), at.tolist(), count.tolist()):
            start = seen.get(v, 0)
            place[by[a:a + c]] = np.arange(start, start + c)
            seen[v] = start + c
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(shard), task, np.int32)), pa.array(place)], names=[*b.schema.names, "task", "place"])


def assign(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, group_rows: one row per
    row of ``docs``."""
    spark = docs.sparkSession
    text = text_of(docs)
    rows = cut(docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")), "sized")
    groups = cut(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")
    placed = place_groups(groups, shards)
    if placed is None:
        return spark.createDataFrame([], "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, group_rows long")
    many = rows.count()
    heavy = F.col("n") * HEAVY > many
    shard_of = placed.select("digest", "shard", "n")
    hot = rows.join(F.broadcast(shard_of.filter(heavy)), "digest")
    others = rows.join(F.broadcast(shard_of.filter(heavy).select("digest")), "digest", "left_anti").join(shard_of.filter(~heavy), "digest")
    dealt = hot.unionByName(others).select("doc_id", "size", "text_crc32", "shard", F.col("n").alias("group_rows"))
    dealt = cut(dealt.mapInArrow(_number, "doc_id long, size long, text_crc32 long, shard int, group_rows long, task int, place long"), "numbered")
    counts = dealt.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "task", F.coalesce(before, F.lit(0)).alias("start"))
    return dealt.join(starts, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "group_rows")
