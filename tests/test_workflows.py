"""End-to-end: raw vendor files -> profile -> clean -> load -> analyse -> write."""

import os
from datetime import datetime

from shelflens.plans import analysis as A
from shelflens.sources import fixtures as fx
from shelflens.sources.marketplace import demo_data

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2001, 8, 1, 12)


def write_raw(spark, data_dir):
    li, part = fx.table(spark, SF, "lineitem"), fx.table(spark, SF, "part")
    fx.daily_report_text(li).write.option("header", True).csv(os.path.join(data_dir, "SalesandTrafficByDate.csv"))
    (fx.vendor_listing(part).write.option("header", True).option("sep", "\t")
     .csv(os.path.join(data_dir, "Inventory+Report+03-22-2025.txt")))
    fx.vendor_performance(fx.table(spark, SF, "events")).write.option("header", True).csv(
        os.path.join(data_dir, "SellerPerformance.csv"))
    return part.count()


def test_profile_clean_and_full_analysis(spark, tmp_out):
    data_dir = os.path.join(tmp_out, "data")
    n_items = write_raw(spark, data_dir)
    prof = A.profile_all_files(spark, data_dir)
    issues = {r["column"]: r["issues"] for r in prof.collect() if r["issues"]}
    assert "Currency formatting in column: Ordered Product Sales" in issues["Ordered Product Sales"]
    assert "Percentage formatting" in issues["late_shipment_rate"]
    written = A.clean_data(spark, data_dir)
    assert len(written) == 3
    res = A.run_full_analysis(spark, data_dir, AS_OF, output_dir=os.path.join(tmp_out, "out"))
    assert res["basic_analysis"].count() == n_items
    assert res["clustering"].count() == n_items
    assert {r["statistic"] for r in res["performance"].collect()} == {
        "count", "mean", "std", "min", "25%", "50%", "75%", "max"}
    assert set(res["written"]) >= {"inventory_analysis", "stale_items", "bad_metadata", "good_sellers",
                                   "sales_velocity", "metadata_quality", "inventory_clusters"}
    # synthetic daily-report SKUs never match listings (as in the reference)
    assert res["basic_analysis"].where("`Days Since Last Sale` IS NOT NULL").count() == 0


def test_missing_files_give_empty_frames(spark, tmp_out, caplog):
    with caplog.at_level("WARNING"):
        data = A.load_all_data(spark, os.path.join(tmp_out, "nothing"))
    assert sum("No " in r.getMessage() for r in caplog.records) == 3
    assert data["sales"].count() == 0 and data["inventory"].count() == 0 and data["performance"] is None


def test_run_analysis_demo(spark):
    sales, inv = demo_data(spark, AS_OF)
    out = A.run_analysis(sales, inv, AS_OF)
    rows = out.collect()
    assert len(rows) == 5 and all(r["Cluster_Description"].endswith(")") for r in rows)
    summary = A.flag_summary(out).first()
    assert (summary["items"], summary["flagged"], summary["good"]) == (5, 3, 2)


def test_run_inventory_analysis_writes_reports(spark, tmp_out):
    sales, inv = demo_data(spark, AS_OF)
    res = A.run_inventory_analysis(sales, inv, AS_OF, output_dir=os.path.join(tmp_out, "o"), fmt="csv")
    assert set(res["written"]) == {"inventory_analysis", "stale_items", "bad_metadata", "good_sellers",
                                   "sales_velocity", "metadata_quality", "revenue_analysis"}
    back = spark.read.option("header", True).csv(res["written"]["good_sellers"])
    assert sorted(r["SKU"] for r in back.collect()) == ["0385472579", "B07D6CTWPZ"]
    flags = {r["Flag"]: r["items"] for r in res["flag_counts"].collect()}
    assert sum(flags.values()) == 5


def test_alternate_sales_file_is_normalised(spark, tmp_out):
    data_dir = os.path.join(tmp_out, "alt")
    fx.daily_report_text(fx.table(spark, SF, "lineitem")).write.option("header", True).csv(
        os.path.join(data_dir, "DetailPageSalesandTrafficByDate.csv"))
    sales = A.load_sales(spark, data_dir, AS_OF)
    assert {"Date", "SKU", "quantity", "Sales"} <= set(sales.columns)
    assert sales.where("SKU LIKE 'SALE_%'").count() == sales.count() > 0
