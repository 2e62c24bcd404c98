"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from costlens.llm import bpe_tree, column_bwt, differencing, exact_dedup, licenses, lm_score, packing, quality_rules, run_detection, secret_ledger, simhash, token_frames, whitening
from costlens.llm.common import table, text_of


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assign(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames.round_trip(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.assign(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.digest(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(table(spark, sf_dir, "documents"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents lie in directories source/lang/doc_id by thousands, and the first
    hundred of a thousand in one of those above, by turns."""
    docs = table(spark, sf_dir, "documents")
    thousand, place = F.floor(F.col("doc_id") / 1000).cast("string"), F.pmod(F.col("doc_id"), F.lit(1000))
    depth = F.when(place >= 100, 3).otherwise(F.coalesce(1 + place % 2, F.lit(3)))
    path = F.concat_ws("/", "source", F.when(depth > 1, F.col("lang")), F.when(depth > 2, thousand), F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.remove_repeats(table(spark, sf_dir, "documents"))


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.scan(table(spark, sf_dir, "documents"))


def op11_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.assign(table(spark, sf_dir, "documents"), shards=40)


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the documents whose id hashes to a multiple of ten repeat
    a stretch of their words up to the end. A null id changes nothing."""
    h = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    chosen = (h % 10 == 0) & text_of(docs).rlike("[^ \t\n\x0b\f\r]")
    words = F.array_remove(F.split(text_of(docs), "[ \t\n\x0b\f\r]+"), "")
    rows = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"), F.when(chosen, words).alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.select("doc_id", "text", "w", "g", F.size("w").cast("long").alias("n"), (F.col("g") % F.size("w")).alias("a"))
    rows = rows.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    more = F.expr("concat(slice(w, 1, int(a)), slice(flatten(array_repeat(slice(w, int(a) + 1, int(p)), int(ceil((n - a) / p)))), 1, int(n - a)))")
    return rows.select("doc_id", F.when(F.col("w").isNull(), F.col("text")).otherwise(F.concat_ws(" ", more)).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_detection.find(repeated(table(spark, sf_dir, "documents")))
    longest = F.expr("reduce(runs, cast(null as struct<start:long,length:long,period:long>), (a, b) -> if(a is null or b.length > a.length, b, a))")
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    rows = found.withColumn("longest", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=8)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_token_frames, op3_best_fit_packing, op4_simhash, op5_bpe_tree, op6_exact_dedup, op7_licences, op8_lm_score, op9_column_bwt, op10_secret_ledger, op11_kk_shards, op12_periodic_runs, op13_feast_whitening)}
QUERIES["pipeline"] = corpus_pipeline.run

_OP6 = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, first_value(doc_id) OVER w = doc_id AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)"""

ORACLES = {"op1_quality_rules": quality_rules.ORACLE_SQL, "op6_exact_dedup": _OP6}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
