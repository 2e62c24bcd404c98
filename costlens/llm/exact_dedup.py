"""Exact deduplication by a tree merge of sorted digest runs.

Every partition folds its rows to one sorted run with a single entry per digest.
Runs then meet in rounds: run ``i`` joins run ``i // FAN`` (three binomial levels
per shuffle at a fan-in of eight). A task gets the runs of some digest slots in the
order of their digests - Spark's sort merges them, spilling where they are large - and
passes over that order once, keeping per digest the best entry and the number of rows;
it holds a batch and one entry. After the last round there is one run per slot. A hot
digest travels as one entry per run, so no task sees its rows.

Two texts are equal when they agree after all characters of [\\x20\\x09-\\x0D] are
deleted; null counts as the empty text. The row with the most code points stays,
then the smallest doc_id, a null doc_id last. Each entry also carries the byte
length and an independent 64-bit hash of the normalised text: a round that meets
one digest with two of them raises instead of merging.

Empty table: no rows. Repeated rows (same doc_id and text): one of them stays.
Other columns, whatever their names, are ignored by ``assign`` and passed through
by ``drop_copies``."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import cut, fresh, text_of, without_blanks

#: Runs merged into one per round.
FAN = 8
#: Digests that one merge task should end with.
SLOT_ROWS = 100_000
#: Rows that a task gathers before it folds them, if it holds no more digests than that.
FOLD_ROWS = 200_000

RUN = "slot int, run int, digest binary, n_chars long, doc_id long, row long, n_rows long, n_bytes long, proof long"
_NULL_ID = np.iinfo(np.int64).max


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, digest, n_bytes, proof of every row."""
    bare = without_blanks(text_of(docs))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.length(text_of(docs)).cast("long").alias("n_chars"),
        F.unhex(F.sha2(bare, 256)).alias("digest"),
        F.octet_length(bare).cast("long").alias("n_bytes"),
        F.xxhash64(bare).alias("proof"),
    )


def _words(digest: pa.Array) -> np.ndarray:
    """The digests as rows of four big-endian words, which sort like the bytes."""
    return np.frombuffer(b"".join(digest.to_pylist()), dtype=">u8").reshape(-1, 4).astype(np.uint64)


def merge(t: pa.Table) -> pa.Table:
    """One entry per key of a table in order: the first row of it, and its row count;
    raises on a false match."""
    key = _words(t["digest"].combine_chunks())
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]).any(axis=1)
    for c in ("slot", "run"):
        if c in t.schema.names:
            own = t[c].to_numpy()
            new[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(new)
    for c in ("n_bytes", "proof"):
        values = t[c].to_numpy()
        if (np.minimum.reduceat(values, at) != np.maximum.reduceat(values, at)).any():
            raise ValueError("two different texts share a SHA-256 digest")
    best = t.take(pa.array(at))
    i = best.schema.get_field_index("n_rows")  # the field stays as it is: batches meet only in one schema
    return best.set_column(i, best.schema.field(i), pa.array(np.add.reduceat(t["n_rows"].to_numpy(), at)))


def fold(t: pa.Table) -> pa.Table:
    """``merge`` of a table in any order: most code points first, then the smallest id,
    then the first row."""
    key = _words(t["digest"].combine_chunks())
    order = np.lexsort((t["row"].to_numpy(), t["doc_id"].to_numpy(), -t["n_chars"].to_numpy(), key[:, 3], key[:, 2], key[:, 1], key[:, 0]))
    return merge(t.take(pa.array(order)))


def _local_runs(slot_bits: int):
    def run(batches):
        held, small, n = [], [], 0
        for b in batches:
            small.append(b)
            n += b.num_rows
            if n >= max(FOLD_ROWS, sum(x.num_rows for x in held)):
                held, small, n = fold(pa.Table.from_batches([*held, *small]).combine_chunks()).to_batches(), [], 0
        got = [x for x in (*held, *small) if x.num_rows]
        if got:
            out = fold(pa.Table.from_batches(got).combine_chunks())
            slots = (_words(out["digest"].combine_chunks())[:, 0] >> np.uint64(64 - slot_bits)).astype(np.int32) if slot_bits else np.zeros(len(out), np.int32)
            own = np.full(len(out), TaskContext.get().partitionId(), np.int32)
            yield from out.add_column(0, "slot", pa.array(slots)).add_column(1, "run", pa.array(own)).to_batches()
    return run


def _merge_runs(batches):
    """Merges a task's sorted runs in one pass; the last entry waits for the next batch."""
    held = None
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([b])
            t = merge(t if held is None else pa.concat_tables([held, t.cast(held.schema)]))
            held = t.slice(len(t) - 1).combine_chunks()
            yield from t.slice(0, len(t) - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.to_batches()


def winners(rows: DataFrame) -> DataFrame:
    """digest, keep_id, keep_chars, keep_row, group_size: one row per digest of ``rows``
    (the columns of ``digests``, and optionally a number ``row`` that tells equal rows apart)."""
    n = rows.count()
    slot_bits = max(0, math.ceil(math.log2(max(1, n / SLOT_ROWS))))
    row = rows["row"] if "row" in rows.columns else F.lit(0).cast("long")
    entries = rows.withColumn("row", row).withColumn("n_rows", F.lit(1).cast("long")).withColumn("doc_id", F.coalesce("doc_id", F.lit(int(_NULL_ID))))
    runs = entries.select("digest", "n_chars", "doc_id", "row", "n_rows", "n_bytes", "proof").mapInArrow(_local_runs(slot_bits), RUN)
    runs = cut(runs, "digest-runs")
    last = runs.agg(F.max("run")).first()[0] or 0
    while last:
        runs = runs.withColumn("run", F.floor(F.col("run") / FAN).cast("int")).repartition("slot", "run")
        runs = runs.sortWithinPartitions("slot", "run", "digest", F.desc("n_chars"), "doc_id", "row").mapInArrow(_merge_runs, RUN)
        last //= FAN
    return runs.select("digest", F.nullif("doc_id", F.lit(int(_NULL_ID))).alias("keep_id"), F.col("n_chars").alias("keep_chars"), F.col("row").alias("keep_row"), F.col("n_rows").alias("group_size"))


def assign(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = cut(digests(docs).withColumn("row", F.monotonically_increasing_id()), "digests")
    copies = winners(rows).filter("group_size > 1")
    joined = rows.join(copies, "digest", "left")  # adaptive execution splits the partition of a hot digest
    alone = F.col("group_size").isNull()
    stays = F.col("keep_row") == F.col("row")
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(stays).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``assign`` would not keep; all columns stay."""
    best = winners(cut(digests(docs), "digests"))
    d, n, k, i, c, turn = fresh(docs, "digest_", "chars_", "key_", "id_", "len_", "turn_")
    rows = docs.withColumn(d, F.unhex(F.sha2(without_blanks(text_of(docs)), 256))).withColumn(n, F.length(text_of(docs)).cast("long"))
    best = best.select(F.col("digest").alias(k), F.col("keep_id").alias(i), F.col("keep_chars").alias(c))
    same = (rows[d] == best[k]) & rows["doc_id"].eqNullSafe(best[i]) & (rows[n] == best[c])
    one = Window.partitionBy(d, "doc_id", n).orderBy(d)
    kept = rows.join(best, same, "left_semi").withColumn(turn, F.row_number().over(one)).filter(F.col(turn) == 1)
    return kept.select(*[kept[f"`{x}`"] for x in docs.columns])
