"""Marketplace tables (A6-A8, A12, E6) as DataFrame sources.

The reference fetches these through an HTTP client that returns fixed stub
rows; here they are tables (any Spark source) and the operations on them are
filters, projections and joins that Catalyst pushes into the scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.functions.dates import window_start, ts_literal
from shelflens.operators.joins import left_join_unique, semi_join

SUMMARY_COLUMNS = ["SKU", "ASIN", "Title", "Condition", "Price", "Quantity"]
CATALOG_COLUMNS = ["SKU", "ASIN", "Title", "Author", "ISBN", "Has_Image", "Publication_Date"]
DEFAULT_HISTORY_DAYS = 365


def sales_history(sales: DataFrame, as_of: datetime, start: datetime | None = None,
                  end: datetime | None = None) -> DataFrame:
    """Sales lines with ``start <= Date <= end`` (default: the last 365 days)."""
    dtype = sales.schema["Date"].dataType
    end = end or as_of
    lo = ts_literal(start, dtype) if start else window_start(end, DEFAULT_HISTORY_DAYS, dtype)
    return sales.where(F.col("Date").between(lo, ts_literal(end, dtype)))


def inventory_summary(listings: DataFrame, marketplace_id: str | None = None) -> DataFrame:
    """Listing snapshot columns, optionally for one marketplace."""
    df = listings
    if marketplace_id is not None and "marketplace_id" in df.columns:
        df = df.where(F.col("marketplace_id") == F.lit(marketplace_id))
    return df.select(*[c for c in SUMMARY_COLUMNS if c in df.columns])


def catalog_lookup(catalog: DataFrame, skus: DataFrame) -> DataFrame:
    """Catalog rows for the SKUs in ``skus`` (a DataFrame with ``SKU``)."""
    return semi_join(catalog, skus, "SKU").select(*[c for c in CATALOG_COLUMNS if c in catalog.columns])


def enrich_with_catalog(listings: DataFrame, catalog: DataFrame) -> DataFrame:
    """Listing snapshot + catalog metadata (ISBN, image, author, date)."""
    extra = [c for c in ("Author", "ISBN", "Has_Image", "Publication_Date")
             if c in catalog.columns and c not in listings.columns]
    # One catalog row per SKU, so the left join never fans out: of several the
    # smallest in column order (NULLs first), whatever the input order.
    rows = catalog.where(F.col("SKU").isNotNull()).groupBy("SKU").agg(F.min(F.struct(*extra)).alias("__c")) if extra else None
    if rows is None:
        return listings
    return left_join_unique(listings, rows.select("SKU", "__c.*"), "SKU")


def demo_data(spark: SparkSession, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """The five-item demo set with dates relative to ``as_of`` (tests/examples)."""
    d = lambda days: as_of - timedelta(days=days)
    # fixed values: the demo sales set (ages in days before as_of)
    sales = spark.createDataFrame(
        [("B000FJS1B4", d(200), 1, 12.99), ("0385472579", d(3), 2, 15.99),
         ("B07D6CTWPZ", d(15), 1, 9.99), ("B07CHNQLTF", d(45), 1, 7.99),
         ("0451524934", d(90), 1, 5.99)],
        T.StructType([T.StructField("SKU", T.StringType()), T.StructField("Date", T.TimestampNTZType()),
                      T.StructField("quantity", T.LongType()), T.StructField("Price", T.DoubleType())]))
    # fixed values: the demo listing set
    inventory = spark.createDataFrame(
        [("B000FJS1B4", "The Hobbit", "9780547928227", 12.99, True, 5),
         ("0385472579", "Zen Mind, Beginner's Mind", "9781590308493", 15.99, True, 3),
         ("B07D6CTWPZ", "Educated: A Memoir", "9780399590504", 9.99, True, 2),
         ("B07CHNQLTF", "Sapiens", "9780062316097", 7.99, False, 1),
         ("0451524934", "1984", "9780451524935", 5.99, True, 4)],
        T.StructType([T.StructField("SKU", T.StringType()), T.StructField("Title", T.StringType()),
                      T.StructField("ISBN", T.StringType()), T.StructField("Price", T.DoubleType()),
                      T.StructField("Has_Image", T.BooleanType()), T.StructField("quantity", T.LongType())]))
    return sales, inventory
