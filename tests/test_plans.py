"""Plan checks: no Python UDFs, filters reach the scan, one scan for the
row-local anti-patterns."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan):
    return len(re.findall(r"(?<!Local)Relation \[", plan))


def test_no_python_udf_in_core_plans(spark):
    qs = E.queries()
    for key in ["query_cost_attribution", "ap_union", "idle_warehouse_periods", "alert_union", "dq_schema_report"]:
        plan = _plan(qs[key](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_ap_union_scans_orders_once_for_row_rules(spark):
    plan = E.queries()["ap_union"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # one scan for the six row-local rules; the repeated branch reads the rows and their newest texts
    assert _scans(plan) <= 3
    assert plan.count("using SELECT *. ") == 1  # a rule's text is built in one place, after the filter


def test_ship_date_ranges_reach_the_scan(spark):
    for key in ("wl_health_scorecard", "wl_month_detail", "wl_demand_signals"):
        plan = _plan(E.queries()[key](spark, SF))
        assert "GreaterThanOrEqual(l_shipdate" in plan, key


def test_incremental_extract_filters_by_a_scalar(spark):
    plan = _plan(E.queries()["incremental_extract"](spark, SF))
    assert "NestedLoop" not in plan and "subquery" in plan.lower()


def test_reports_read_written_layers(spark):
    for key, most in (("weekly_executive_report", 15), ("dq_schema_report", 120)):
        plan = E.queries()[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert _scans(plan) <= most, (key, _scans(plan))


def test_column_pruning_reaches_scan(spark):
    plan = _plan(E.queries()["warehouse_daily_credits"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan
