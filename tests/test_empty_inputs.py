"""Operators on empty inputs return empty (or zero) results instead of failing."""

from datetime import datetime

from shelflens.operators.dbscan import dbscan
from shelflens.operators.describe import describe
from shelflens.operators.ordering import with_row_index
from shelflens.plans import performance as PF
from shelflens.plans import reports as R
from shelflens.plans.clustering import clustered_report
from shelflens.plans.inventory_report import inventory_report

AS_OF = datetime(2001, 8, 1, 12)


def test_empty_operators(spark):
    pts = spark.createDataFrame([], "id long, x double, y double")
    assert dbscan(pts, "id", ["x", "y"]).count() == 0
    assert describe(spark.createDataFrame([], "a double"), ["a"]).count() == 0
    assert with_row_index(spark.createDataFrame([], "v long"), ["v"]).count() == 0
    perf = spark.createDataFrame([], "Date string, order_defect_rate double")
    assert PF.performance_summary(perf).count() == 0
    assert PF.performance_trend(perf).count() == 0


def test_empty_listings(spark):
    sales = spark.createDataFrame([("A", AS_OF, 1.0, 1.0)], "SKU string, Date timestamp_ntz, quantity double, Price double")
    inv = spark.createDataFrame([], "SKU string, Title string, ISBN string, Price double, Has_Image boolean")
    rep = inventory_report(sales, inv, AS_OF)
    assert rep.count() == 0
    assert R.flag_counts(rep).count() == 0
    assert clustered_report(sales, inv, AS_OF).count() == 0      # fewer than 5 items: no clustering
