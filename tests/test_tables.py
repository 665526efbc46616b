from datetime import datetime

from shelflens.plans.inventory_report import inventory_report
from shelflens.sources import fixtures as fx
from shelflens.sources.tables import save_bucketed

SF = "/root/testdata/sf0.001"


def test_bucketed_report_has_no_exchange(spark, tmp_out):
    sales = save_bucketed(fx.sales(spark, SF), "sales_bucketed", buckets=8, path=f"{tmp_out}/s")
    listings = save_bucketed(fx.listings(spark, SF), "listings_bucketed", buckets=8, path=f"{tmp_out}/l")
    as_of = datetime(2001, 8, 1, 12)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rep = inventory_report(sales, listings, as_of)
        plan = rep._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        base = inventory_report(fx.sales(spark, SF), fx.listings(spark, SF), as_of)
        assert sorted(map(tuple, rep.collect())) == sorted(map(tuple, base.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
