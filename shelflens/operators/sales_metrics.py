"""Per-item sales metrics in ONE distributed aggregation, joined once.

The reference runs five group-bys over the sales lines (last sale, 30/90-day
units, 30/90-day revenue) and five merges.  Here they are a single
``groupBy(SKU)`` with conditional sums: Spark does a map-side partial
aggregate, so a hot SKU (even a third of all lines) ships one partial row per
map task, never its raw lines; then one left join onto the listings.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions.dates import floor_days_since, window_start
from shelflens.operators.joins import left_join_unique

# Prices and units at full scale: only the total is converted, once, to double.
PRICE, UNITS = T.DecimalType(18, 6), T.DecimalType(12, 3)


def sales_col(d: int) -> str:
    return f"Sales_Last_{d}d"


def revenue_col(d: int) -> str:
    return f"Revenue_{d}d"


def _revenue_term(in_window: Column) -> Column:
    # Exact money arithmetic: decimal price x decimal units, summed as decimal.
    return F.when(in_window, F.col("Price").cast(PRICE) * F.col("quantity").cast(UNITS))


def sku_sales_summary(sales: DataFrame, as_of: datetime,
                      windows=K.SALES_WINDOWS_DAYS, with_revenue: bool | None = None) -> DataFrame:
    """One row per SKU: last sale time, units and revenue per trailing window.

    Windows are ``Date >= as_of - d`` with no upper bound (future-dated lines
    count), exactly as the reference filters.  Revenue uses the *sale* price
    and is produced only when the sales carry a ``Price`` column.
    """
    if with_revenue is None:
        with_revenue = "Price" in sales.columns
    date_type = sales.schema["Date"].dataType
    aggs = [F.max("Date").alias("Last_Sale")]
    for d in windows:
        in_w = F.col("Date") >= window_start(as_of, d, date_type)
        aggs.append(F.sum(F.when(in_w, F.col("quantity").cast(T.DoubleType()))).alias(sales_col(d)))
        if with_revenue:
            aggs.append(F.sum(_revenue_term(in_w)).alias(revenue_col(d)))
    return (sales.where(F.col("SKU").isNotNull())
            .groupBy("SKU")
            .agg(*aggs))


def with_sales_metrics(inventory: DataFrame, sales: DataFrame, as_of: datetime,
                       windows=K.SALES_WINDOWS_DAYS, with_revenue: bool | None = None) -> DataFrame:
    """Listings left-joined to their per-SKU metrics; absent sums become 0.

    Adds ``Days_Since_Last_Sale`` (NULL for never-sold items), one
    ``Sales_Last_<d>d`` per window and, with revenue, ``Revenue_<d>d``.
    Lazy.  The join strategy is AQE's: broadcast when the per-SKU side is small at
    run time, else sort-merge with a hot SKU split (``left_join_unique``).
    """
    if with_revenue is None:
        with_revenue = "Price" in sales.columns
    per_sku = sku_sales_summary(sales, as_of, windows, with_revenue)
    per_sku = per_sku.withColumn("Days_Since_Last_Sale", floor_days_since(as_of, F.col("Last_Sale")))
    joined = left_join_unique(inventory, per_sku, "SKU")
    fills = {}
    for d in windows:
        fills[sales_col(d)] = F.coalesce(F.col(sales_col(d)), F.lit(0.0))
        if with_revenue:
            fills[revenue_col(d)] = F.coalesce(F.col(revenue_col(d)).cast(T.DoubleType()), F.lit(0.0))
    return joined.withColumns(fills)


# -- stand-alone per-SKU aggregates (F-A1..F-A4, G1) -------------------------
def last_sale(sales: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """F-A1 (+ G1 when ``as_of`` is given): latest sale time per SKU."""
    out = (sales.where(F.col("SKU").isNotNull())
           .groupBy("SKU").agg(F.max("Date").alias("Last_Sale")))
    if as_of is not None:
        out = out.withColumn("Days_Since_Last_Sale", floor_days_since(as_of, F.col("Last_Sale")))
    return out


def window_units(sales: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """F-A2/F-A3: units per SKU over ``Date >= as_of - days``.

    The bound is a typed literal, so it is pushed to the parquet scan and row
    groups entirely before the window are skipped.
    """
    lo = window_start(as_of, days, sales.schema["Date"].dataType)
    return (sales.where((F.col("Date") >= lo) & F.col("SKU").isNotNull())
            .groupBy("SKU")
            .agg(F.sum(F.col("quantity").cast(T.DoubleType())).alias(sales_col(days))))


def revenue_windows(sales: DataFrame, as_of: datetime, windows=K.SALES_WINDOWS_DAYS) -> DataFrame:
    """F-A4: sale-price revenue per SKU per window, for SKUs sold in the widest one."""
    dtype = sales.schema["Date"].dataType
    widest = max(windows)
    scoped = sales.where((F.col("Date") >= window_start(as_of, widest, dtype))
                         & F.col("SKU").isNotNull())
    aggs = []
    for d in windows:
        in_w = F.col("Date") >= window_start(as_of, d, dtype)
        aggs.append(F.coalesce(F.sum(_revenue_term(in_w)).cast(T.DoubleType()), F.lit(0.0))
                    .alias(revenue_col(d)))
    return scoped.groupBy("SKU").agg(*aggs)
