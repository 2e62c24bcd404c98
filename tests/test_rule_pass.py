"""Texts are judged once per row: the filters by prefix lower a text's start in one match,
and the anti-pattern rules share a projection below the generator."""

import re

from pyspark.sql import functions as F

from costlens.functions import exprs as X
from costlens.functions.exprs import AsOf
from costlens.operators import antipatterns as AP

TEXTS = [None, "", " ", "ALTER TABLE t", "alter", "alte", "Select 1", " call x", "CALL x", "Create OR Replace VIEW v", "create or  replace v", "execute dbt", "EXECUTE DBT PROJECT p",
         "execute streamlit", "execute", "grant\nselect", "xalter", "x\nalter table", "KALL x", "İalter", "GRANTİ", "CİLL", "caſll", "ΣCALL", "CALLΣ", "a.ter", "call" * 50]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_prefixes_are_told_as_by_the_whole_lowered_text(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for prefixes in (X.INTERNAL_PREFIXES_ATTRIBUTION, X.INTERNAL_PREFIXES_UNION, X.INTERNAL_PREFIXES_STAGING, ["a.t", "x", "K", "k"]):
        got = rows.select("t", X.not_like_any("t", prefixes).alias("now"),
                          F.expr(" AND ".join(f"NOT startswith(lower(t), '{p}')" for p in prefixes)).alias("long"))
        assert all(r.now == r.long for r in got.collect())
        assert len(re.findall(r"lower\(", _plan(rows.filter(X.not_like_any("t", prefixes))))) == 1


def _history(spark):
    rows = spark.range(400).selectExpr(
        "'Q' || id AS query_id", "CASE id % 5 WHEN 0 THEN 'select * from t' WHEN 1 THEN 'SELECT a FROM t ORDER BY a' WHEN 2 THEN 'call x' WHEN 3 THEN 'select 1 from snowflake.account_usage.q' ELSE NULL END AS query_text",
        "'SELECT' AS query_type", "IF(id % 9 = 0, NULL, 'USER_1') AS user_name", "IF(id % 7 = 0, NULL, 'ETL_WH') AS warehouse_name", "'Small' AS warehouse_size", "IF(id % 11 = 0, NULL, 'DB') AS database_name",
        "IF(id % 13 = 0, 'FAIL', 'SUCCESS') AS execution_status", "TIMESTAMP_NTZ '2024-01-30 00:00:00' - id * INTERVAL '6' HOUR AS end_time", "id * 9000 AS total_elapsed_time_ms", "id * 8000 AS execution_time_ms",
        "id * 100 AS queued_overload_time_ms", "IF(id % 6 = 0, NULL, id * 100000) AS bytes_scanned", "id * 10000 AS rows_produced", "id AS partitions_scanned", "IF(id % 8 = 0, 0, 400) AS partitions_total",
        "IF(id % 3 = 0, id, 0) AS bytes_spilled_to_local_storage", "IF(id % 4 = 0, id, NULL) AS bytes_spilled_to_remote_storage", "'H1' AS query_parameterized_hash", "end_time AS start_time")
    return rows.unionByName(rows.limit(40))


def test_union_has_what_each_rule_finds_and_works_its_tests_out_below_the_generator(spark):
    price = spark.createDataFrame([(3.0,)], "credit_price_usd double")
    costed = AP.costed(_history(spark), price)
    patterns = spark.createDataFrame([], ("query_hash string, query_type string, warehouse_name string, query_date date, execution_count long, avg_execution_time_s double, total_cost_usd double, "
                                          "avg_cost_per_execution double, sample_user_name string, sample_query_id string, sample_query_text string"))
    union = AP.antipattern_union(costed, patterns, AsOf())
    text = F.col("sample_query_text")
    each = None
    for rule in AP.rules(AsOf()):
        one = AP.single_rule(costed, rule, AsOf()).select(AP.COMMON).filter(text.isNotNull() & X.not_like_any(text, X.INTERNAL_PREFIXES_UNION))
        assert one.count() > 0 or rule == "CARTESIAN_JOIN"
        each = one if each is None else each.unionByName(one)
    assert sorted(map(repr, union.collect())) == sorted(map(repr, each.collect()))
    generators = [line for line in _plan(union).splitlines() if "Generate" in line]
    assert generators and not any("Contains" in line or "upper" in line for line in generators)
