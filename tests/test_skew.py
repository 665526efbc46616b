"""A third of the rows on one key: final plans and partition sizes."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelflens.operators import kmeans as KM
from shelflens.operators.dbscan import dbscan
from shelflens.operators.features import FEATURES, ITEM_ID
from shelflens.operators.sales_metrics import with_sales_metrics
from shelflens.plans.analysis import analyze
from shelflens.sources import fixtures as fx
from shelflens.sources.marketplace import enrich_with_catalog

SF = "/root/testdata/sf0.001"

SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


@pytest.fixture
def small_pieces(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_listing_is_split(spark, small_pieces):
    n = 30_000
    listings = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("SKU"), F.sha2(F.col("id").cast("string"), 256).alias("Title"))
    sales = spark.range(n).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("SKU"),
                                  F.lit(datetime(2025, 1, 1)).alias("Date"), F.lit(1.0).alias("quantity"))
    out = with_sales_metrics(listings, sales, datetime(2025, 1, 2), with_revenue=False)
    assert len(out.collect()) == n
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_and_null_skus_are_split_in_the_catalog_join(spark, small_pieces):
    n = 30_000
    sku = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("S"), F.col("id")))
    listings = spark.range(n, numPartitions=16).select(sku.alias("SKU"), F.sha2(F.col("id").cast("string"), 256).alias("Title"), F.lit(1).alias("join_hash"))
    catalog = spark.range(n).select(F.when(F.col("id") == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("SKU"), F.col("id").cast("string").alias("Author"))
    out = enrich_with_catalog(listings, catalog)
    rows = out.collect()
    assert len(rows) == n and all(r.Author == ("0" if r.SKU == "HOT" else r.SKU and r.SKU[1:]) and r.join_hash == 1 for r in rows)
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_reports_run_nothing_before_an_action(spark):
    sc = spark.sparkContext
    sales, listings = fx.sales(spark, SF), fx.listings(spark, SF)
    sc.setJobGroup("lazy-report", "no job")
    try:
        report = analyze(sales, listings, datetime(2001, 8, 1, 12))
        assert sc.statusTracker().getJobIdsForGroup("lazy-report") == []
        assert report.count() == listings.count()
        assert sc.statusTracker().getJobIdsForGroup("lazy-report")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_kmeans_input_spreads_a_hot_sku(spark):
    n = 8000
    rows = spark.range(n).select(F.col("id").alias(ITEM_ID), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("SKU"),
                                 *[(F.col("id") % 97).cast("double").alias(c) for c in FEATURES])
    sizes = [r["count"] for r in KM.pin_features(rows, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) < 2 * n / 8


def test_no_point_is_lost(spark):
    nan = float("nan")
    rows = [(1, 0.0, 0.0), (2, 0.0, 0.1), (3, 0.1, 0.0), (4, None, 0.0), (5, 0.0, nan), (6, None, None), (7, 9.0, 9.0)]
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in dbscan(spark.createDataFrame(rows, "id long, x double, y double"), "id", ["x", "y"], 0.5, 3).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (1, True), 4: (-1, False), 5: (-1, False), 6: (-1, False), 7: (-1, False)}
    with pytest.raises(ValueError):
        dbscan(spark.createDataFrame([(1, 0.0, 0.0, 0.0, 0.0)], "id long, a double, b double, c double, d double"), "id", list("abcd"), 0.5, 3)


def test_kmeans_ranking_uses_hash_aggregates(spark):
    rows = spark.range(200).select(F.col("id").alias(ITEM_ID), F.concat(F.lit("S"), F.col("id")).alias("SKU"),
                                   *[(F.col("id") % (7 + k)).cast("double").alias(c) for k, c in enumerate(FEATURES)])
    plan = KM.kmeans_labels(KM.pin_features(rows, 4), 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
