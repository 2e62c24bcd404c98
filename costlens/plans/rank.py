"""Global row numbers without pulling every row into one task.

``Window.orderBy(...)`` with no partition moves the whole input to a single
task. Instead: range-partition on the sort keys, sort within partitions, take
each row's position inside its partition, checkpoint that (so the partitioning
is fixed once and not re-sampled), then add the cumulative row count of the
earlier partitions - a table with one row per partition, broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.session import checkpoint_root

_POS_MASK = (1 << 33) - 1


def global_row_number(df: DataFrame, order: list[Column], out: str, partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              # low 33 bits of the id are the row's position within its partition
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
              .checkpoint(eager=True))
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    return (ranked.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.coalesce("_off", F.lit(0)) + F.col("_pos") + 1).cast("long"))
            .drop("_pid", "_pos", "_off"))


def global_ntile(df: DataFrame, order: list[Column], buckets: int, out: str) -> DataFrame:
    """NTILE(buckets) over a global order, from the global row number and the
    total count (a one-row broadcast), matching the SQL bucket sizes: the first
    ``total % buckets`` buckets hold one extra row."""
    numbered = global_row_number(df, order, "_rn")
    total = numbered.agg(F.count(F.lit(1)).alias("_total"))
    rn, t = F.col("_rn") - 1, F.col("_total")
    small = F.floor(t / buckets)
    extra = t % buckets
    big_rows = extra * (small + 1)
    tile = F.when(rn < big_rows, F.floor(rn / (small + 1)) + 1).otherwise(
        F.floor((rn - big_rows) / F.when(small > 0, small).otherwise(1)) + extra + 1)
    return numbered.crossJoin(F.broadcast(total)).withColumn(out, tile.cast("long")).drop("_rn", "_total")


def _before(pairs: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``pairs`` (distinct values of ``key`` with their row counts ``_n``) with ``_before``,
    the rows of the key that stand before the pair. The pairs are dealt by range, a
    running count is taken per range, and the counts of the ranges before are added, so
    no task holds the values of a whole key."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartitionByRange(n, F.col(key), *order).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    inside = F.sum("_n").over(Window.partitionBy("_pid", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sizes = dealt.groupBy("_pid", key).agg(F.sum("_n").alias("_size"))
    offsets = sizes.select(F.col("_pid").alias("_p"), F.col(key).alias("_key"), F.sum("_size").over(
        Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    placed = dealt.withColumn("_inside", inside).join(offsets, (F.col("_pid") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
    return placed.withColumn("_before", F.coalesce("_inside", F.lit(0)) + F.coalesce("_off", F.lit(0))).drop("_inside", "_p", "_key", "_off", "_pid")


def rank_within(df: DataFrame, key: str, value: str, out: str, dense: bool = False) -> DataFrame:
    """RANK (or DENSE_RANK) of ``value``, falling and nulls last, within ``key``.

    For few keys over many rows: a window would sort all rows of a key in one task.
    Here only the distinct (key, value) pairs with their row counts are placed.
    ``df`` is checkpointed, so that both of its uses see the same (float) values."""
    checkpoint_root(df.sparkSession)
    df = df.checkpoint(eager=True)
    pairs = df.groupBy(F.col(key).alias("_k"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    if dense:
        pairs = pairs.withColumn("_n", F.lit(1).cast("long"))
    placed = _before(pairs, "_k", [F.col("_v").desc_nulls_last()])
    ranks = placed.select("_k", "_v", (F.col("_before") + 1).cast("long").alias(out))
    return df.join(ranks, df[key].eqNullSafe(ranks["_k"]) & df[value].eqNullSafe(ranks["_v"])).drop("_k", "_v")


def exact_percentiles(rows: DataFrame, key: str, value: str, wanted: dict[str, float]) -> DataFrame:
    """Exact interpolated percentiles per ``key``, one column per entry of ``wanted``.

    Rows are counted per (key, value) first, with partial counts before the shuffle;
    the rows before a value tell which value stands at a position. No task buffers or
    sorts the values of a whole key, as an aggregate or a window per key would."""
    checkpoint_root(rows.sparkSession)
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(key), F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = _before(counts, key, [F.col("_v")])
    totals = placed.groupBy(F.col(key).alias("_key")).agg(F.sum("_n").alias("_total"))
    placed = placed.join(totals, F.col(key).eqNullSafe(F.col("_key")))

    def at(index):
        return F.max(F.when((F.col("_before") <= index) & (index < F.col("_before") + F.col("_n")), F.col("_v")))

    out = []
    for name, p in wanted.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(place)), at(F.ceil(place))
        out.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    return placed.groupBy(key).agg(*out)


#: Accuracy of the sketch behind ``top_rows`` (KLL's k), and the share of rows that it may be wrong by.
TOP_K, TOP_ERROR = 4000, 0.005


def top_rows(df: DataFrame, value: str, rest: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows by ``value`` falling, nulls last, then by ``rest``.

    A sort with a limit merges k rows of every task in one task. Here a mergeable
    sketch of ``value`` gives a bar that at least k rows reach; only those are written,
    ranked by range in many tasks and cut at k. Should too few reach the bar, as with
    fewer than k rows or many nulls, all rows are ranked."""
    checkpoint_root(df.sparkSession)
    spark = df.sparkSession
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(TOP_K)).alias("sketch")).first()
    if seen.n <= k:
        return df
    rows = df
    if seen.known > k:
        share = F.lit(max(0.0, 1 - TOP_ERROR - k / seen.known))
        bar = spark.createDataFrame([(seen.sketch,)], "sketch binary").select(F.kll_sketch_get_quantile_double("sketch", share)).first()[0]
        reach = df.filter(F.col(value) >= F.lit(bar)).checkpoint(eager=True)
        rows = reach if reach.count() >= k else df
    ranked = global_row_number(rows, [F.col(value).desc_nulls_last(), *rest], "_place")
    return ranked.filter(F.col("_place") <= k).drop("_place")
