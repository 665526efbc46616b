"""Golden rows for the per-item report (derived by hand from the rules)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.plans import reports as R
from shelflens.plans.inventory_report import inventory_report
from shelflens.sources.marketplace import demo_data

AS_OF = datetime(2001, 8, 1, 12, 0, 0)
SALES_SCHEMA = T.StructType([T.StructField("SKU", T.StringType()), T.StructField("Date", T.TimestampNTZType()),
                             T.StructField("Quantity", T.LongType()), T.StructField("Price", T.DoubleType())])
INV_SCHEMA = T.StructType([T.StructField("SKU", T.StringType()), T.StructField("Title", T.StringType()),
                           T.StructField("ISBN", T.StringType()), T.StructField("Price", T.DoubleType()),
                           T.StructField("Has_Image", T.BooleanType())])


def unit_fixture(spark):
    d = lambda n: AS_OF - timedelta(days=n)
    sales = spark.createDataFrame([("TEST001", d(150), 1, 10.99), ("TEST002", d(2), 3, 15.99),
                                   ("TEST003", d(100), 1, 5.99)], SALES_SCHEMA)
    inv = spark.createDataFrame([("TEST001", "Stale Book", "1234567890", 10.99, True),
                                 ("TEST002", "Good Seller", "0987654321", 15.99, True),
                                 ("TEST003", "Borderline Book", "1122334455", 5.99, True),
                                 ("TEST004", "No Sales Data", None, 1.99, False)], INV_SCHEMA)
    return sales, inv


def by_sku(df):
    return {r["SKU"]: r for r in df.collect()}


def test_unit_fixture_golden(spark):
    sales, inv = unit_fixture(spark)
    rep = inventory_report(sales, inv, AS_OF)
    rows = by_sku(rep)
    assert set(rows) == {"TEST001", "TEST002", "TEST003", "TEST004"}
    exp = {  # days, 30d, 90d, rev30, rev90, stale, bad, score, flag, notes
        "TEST001": (150, 0, 0, 0, 0, True, False, 100, K.FLAG_WARN, "Reprice or remove"),
        "TEST002": (2, 3, 3, 47.97, 47.97, False, False, 100, K.FLAG_OK, "Good seller"),
        "TEST003": (100, 0, 0, 0, 0, True, False, 100, K.FLAG_WARN, "Reprice or remove"),
        "TEST004": (None, 0, 0, 0, 0, False, True, 25, K.FLAG_WARN, "Fix metadata issues"),
    }
    for sku, e in exp.items():
        r = rows[sku]
        got = (r["Days Since Last Sale"], r["Sales Last 30d"], r["Sales Last 90d"],
               r["Revenue Last 30d"], r["Revenue Last 90d"], r["Is_Stale"], r["Bad_Metadata"],
               r["Metadata_Quality_Score"], r["Flag"], r["Notes"])
        assert got[0] == e[0] and got[5:] == e[5:], (sku, got)
        assert got[1:5] == pytest.approx(e[1:5]), (sku, got)


def test_unit_fixture_heuristic(spark):
    sales, inv = unit_fixture(spark)
    scored = by_sku(R.with_heuristic_score(inventory_report(sales, inv, AS_OF)))
    assert {k: v["Heuristic_Score"] for k, v in scored.items()} == {
        "TEST001": 0.5, "TEST002": 1.0, "TEST003": 0.75, "TEST004": 0.375}


def test_report_columns_in_order(spark):
    sales, inv = unit_fixture(spark)
    cols = inventory_report(sales, inv, AS_OF).columns
    assert cols == [c for c in K.REPORT_COLUMNS if c not in ("quantity",)]


def test_demo_fixture_golden(spark):
    sales, inv = demo_data(spark, AS_OF)
    rows = by_sku(inventory_report(sales, inv, AS_OF))
    exp = {
        "B000FJS1B4": (200, 0, 0, 0.0, 0.0, True, False, 100, "Reprice or remove"),
        "0385472579": (3, 2, 2, 31.98, 31.98, False, False, 100, "Good seller"),
        "B07D6CTWPZ": (15, 1, 1, 9.99, 9.99, False, False, 100, "Good seller"),
        "B07CHNQLTF": (45, 0, 1, 0.0, 7.99, False, True, 50, "Fix metadata issues"),
        "0451524934": (90, 0, 1, 0.0, 5.99, False, True, 75, "Fix metadata issues"),
    }
    for sku, e in exp.items():
        r = rows[sku]
        got = (r["Days Since Last Sale"], r["Sales Last 30d"], r["Sales Last 90d"], r["Revenue Last 30d"],
               r["Revenue Last 90d"], r["Is_Stale"], r["Bad_Metadata"], r["Metadata_Quality_Score"], r["Notes"])
        assert got[0] == e[0] and got[5:] == e[5:], (sku, got)
        assert got[1:5] == pytest.approx(e[1:5]), (sku, got)


def test_floor_days_negative_and_noon(spark):
    """Elapsed whole days: 47 h -> 1, -1 h -> -1 (future sale), never sold -> NULL."""
    sales = spark.createDataFrame([("A", AS_OF - timedelta(hours=47), 1, 1.0),
                                   ("B", AS_OF + timedelta(hours=1), 1, 1.0)], SALES_SCHEMA)
    inv = spark.createDataFrame([("A", "Title A long", "1", 5.0, True), ("B", "Title B long", "2", 5.0, True),
                                 ("C", "Title C long", "3", 5.0, True)], INV_SCHEMA)
    rows = by_sku(inventory_report(sales, inv, AS_OF))
    assert rows["A"]["Days Since Last Sale"] == 1
    assert rows["B"]["Days Since Last Sale"] == -1
    assert rows["B"]["Sales Last 30d"] == 1      # no upper bound on the window
    assert rows["C"]["Days Since Last Sale"] is None
    assert rows["C"]["Is_Stale"] is False        # never sold is not stale


def test_window_bound_inclusive(spark):
    sales = spark.createDataFrame([("A", AS_OF - timedelta(days=90), 2, 1.0),
                                   ("A", AS_OF - timedelta(days=90, seconds=1), 5, 1.0)], SALES_SCHEMA)
    inv = spark.createDataFrame([("A", "Long enough", "1", 5.0, True)], INV_SCHEMA)
    r = by_sku(inventory_report(sales, inv, AS_OF))["A"]
    assert r["Sales Last 90d"] == 2


def test_duplicate_listing_kept(spark):
    sales, _ = unit_fixture(spark)
    inv = spark.createDataFrame([("TEST002", "Good Seller", "1", 15.99, True),
                                 ("TEST002", "Good Seller copy", "1", 15.99, True)], INV_SCHEMA)
    rows = inventory_report(sales, inv, AS_OF).collect()
    assert len(rows) == 2 and all(r["Sales Last 30d"] == 3 for r in rows)


def test_missing_required_columns(spark):
    sales, inv = unit_fixture(spark)
    with pytest.raises(ValueError, match="quantity"):
        inventory_report(sales.drop("Quantity"), inv, AS_OF)
    with pytest.raises(ValueError):
        inventory_report(None, inv, AS_OF)


def test_empty_sales(spark):
    _, inv = unit_fixture(spark)
    empty = spark.createDataFrame([], SALES_SCHEMA)
    rows = by_sku(inventory_report(empty, inv, AS_OF))
    assert all(r["Days Since Last Sale"] is None and r["Sales Last 30d"] == 0 for r in rows.values())


def test_no_price_drops_revenue(spark):
    sales, inv = unit_fixture(spark)
    rep = inventory_report(sales.drop("Price"), inv, AS_OF)
    assert "Revenue Last 30d" not in rep.columns


def test_string_dates_are_parsed(spark):
    rows = [("A", (AS_OF - timedelta(days=3)).strftime("%Y-%m-%d %H:%M:%S"), 1)]
    sales = spark.createDataFrame(rows, "SKU string, Date string, quantity long")
    inv = spark.createDataFrame([("A", "Long enough", "1", 5.0, True)], INV_SCHEMA)
    assert by_sku(inventory_report(sales, inv, AS_OF))["A"]["Days Since Last Sale"] == 3


def test_days_do_not_depend_on_session_time_zone(spark):
    sales = spark.createDataFrame([("A", datetime(2001, 3, 11, 1, 30), 1, 1.0),
                                   ("B", datetime(2001, 7, 31, 12, 30), 1, 1.0)], SALES_SCHEMA)
    inv = spark.createDataFrame([("A", "Long enough", "1", 5.0, True),
                                 ("B", "Long enough", "1", 5.0, True)], INV_SCHEMA)
    expected = {k: v["Days Since Last Sale"] for k, v in by_sku(inventory_report(sales, inv, AS_OF)).items()}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = {k: v["Days Since Last Sale"] for k, v in by_sku(inventory_report(sales, inv, AS_OF)).items()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expected == {"A": 143, "B": 0}


def test_larger_random_fixture_row_count(spark):
    """1,000 sales lines over 100 listings (seed 42): one report row per listing."""
    import numpy as np
    rng = np.random.default_rng(42)
    skus = [f"SKU{i:03d}" for i in range(100)]
    start = datetime(2024, 1, 1)
    sales = spark.createDataFrame(
        [(skus[int(rng.integers(0, 100))], start + timedelta(days=int(rng.integers(0, 1000))),
          int(rng.integers(1, 10)), float(rng.integers(5, 50))) for _ in range(1000)], SALES_SCHEMA)
    inv = spark.createDataFrame(
        [(s, f"Book {s}", f"978{i:010d}", float(rng.integers(5, 50)), bool(rng.random() < 0.8))
         for i, s in enumerate(skus)], INV_SCHEMA)
    rep = inventory_report(sales, inv, datetime(2026, 12, 1))
    assert rep.count() == 100 and rep.select("SKU").distinct().count() == 100
