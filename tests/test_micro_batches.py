"""What a micro-batch writes and reads: Spark runs it without adaptive execution."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from costlens.streaming import daily

ROW = "k long, v string, ts timestamp_ntz"


def _days(session, lo, hi):
    return session.range(lo, hi, 1, 8).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.expr("IF(id % 41 = 40, NULL, TIMESTAMP_NTZ '2024-01-01 00:00:00' + (id % 41) * INTERVAL '1' DAY)").alias("ts"))


def _put(session, root, rows, **kw):
    return daily.upsert_days(session, root, rows, ["k"], [F.col("ts").desc(), F.col("v")], F.to_date("ts"), **kw)


def test_a_task_does_not_write_every_day(spark, tmp_path):
    batch = spark.newSession()
    batch.conf.set("spark.sql.adaptive.enabled", "false")
    batch.conf.set("spark.sql.shuffle.partitions", "8")
    batch.conf.set("spark.sql.session.timeZone", "UTC")
    root = str(tmp_path / "t")
    got = _put(batch, root, _days(batch, 0, 4100), stream="s", epoch=0)
    assert set(got.days) == {date(2024, 1, 1) + timedelta(days=n) for n in range(40)} | {None}
    files = daily.read_days(spark, root).inputFiles()
    assert 41 <= len(files) <= 41 + 8  # of 41 days by 8 tasks
    again = _put(batch, root, _days(batch, 0, 41).unionByName(_days(batch, 4100, 4141)).withColumn("v", F.lit("b")), stream="s", epoch=1)
    assert set(again.days.values()) == {2}
    rows = daily.read_days(spark, root)
    assert rows.count() == rows.select("k").distinct().count() == 4141
    assert rows.filter("v = 'b'").count() == 82 and rows.filter("load_day IS DISTINCT FROM CAST(ts AS DATE)").count() == 0


def test_a_batch_without_rows_reads_nothing_and_keeps_its_epoch(spark, tmp_path):
    none = spark.createDataFrame([], f"{ROW}, load_day date")
    some = spark.createDataFrame([(1, "a", datetime(2024, 1, 2), date(2024, 1, 2))], none.schema)
    closed = spark.range(3).select(F.expr("CAST(raise_error('read') AS LONG)").alias("k"), F.expr("DATE '2024-01-01' + CAST(id AS INT)").alias("load_day"))
    assert daily._touched(closed, none, ["k"]) == set()
    assert daily._touched(some.withColumn("load_day", F.lit(date(2024, 1, 1))), some, ["k"]) == {date(2024, 1, 1), date(2024, 1, 2)}
    root = str(tmp_path / "t")
    _put(spark, root, some.drop("load_day"), stream="s", epoch=0)
    got = _put(spark, root, none.drop("load_day"), stream="s", epoch=1)
    assert got.days == {date(2024, 1, 2): 1} and got.epochs == {"s": 1}
    assert daily.read_days(spark, root).count() == 1
