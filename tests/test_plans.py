"""Plan-shape regression tests: pushdown, pruning, no Python in the hot path."""

import __spark_entry__ as E
from shelflens.operators import sales_metrics as SM
from shelflens.plans.inventory_report import prepare_sales
from shelflens.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_bound_reaches_parquet_scan(spark):
    for name in ("q_sales_last_30d", "q_sales_last_90d", "q_revenue_windows", "q_sales_history"):
        plan = plan_of(spark, name)
        assert "GreaterThanOrEqual(l_shipdate" in plan, name


def test_flagship_reads_only_needed_columns(spark):
    per_sku = SM.sku_sales_summary(prepare_sales(fx.sales(spark, SF)), fx.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in per_sku
    assert per_sku.count("Exchange") == 1       # sales by SKU
    plan = plan_of(spark, "q_inventory_report")  # joins the written per-SKU table
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int>" in plan
    assert plan.count("Exchange") <= 2          # both sides by SKU unless broadcast


def test_no_python_evaluation_in_headline_plans(spark):
    for name in ("q_inventory_report", "q_profile_missing", "q_describe_metrics", "q_clean_performance",
                 "q_parse_gmt_timestamp", "q_read_inventory_tsv"):
        plan = plan_of(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
