"""Adapters: the driver's TPC-H-ish tables seen as listings, sales lines and
seller-performance days.  The same rules are written as DuckDB SQL in
``shelflens/oracle.py``; keep the two in step.

* listings  <- part      (one listing per part; 10% are listings whose SKU
  never appears in sales, modelled with an ``N`` prefix; every part row kept)
* sales     <- lineitem  (every line is a sale of ``P<partkey>``)
* performance <- events  (one row per calendar day)
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed report date for reproducible results (noon, so elapsed whole days and
# calendar days differ).
AS_OF = datetime(2001, 8, 1, 12, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key_text(c) -> F.Column:
    return c.cast(T.StringType())


def listings_from_part(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        F.concat(F.when(k % 10 == 0, F.lit("N")).otherwise(F.lit("P")), _key_text(k)).alias("SKU"),
        F.when(k % 11 == 0, F.substring("p_name", 1, 3)).otherwise(F.col("p_name")).alias("Title"),
        F.when(k % 7 == 0, F.lit(None).cast(T.StringType()))
         .when(k % 13 == 0, F.lit(""))
         .otherwise(F.lpad(_key_text(k), 13, "0")).alias("ISBN"),
        ((k % 20).cast(T.DoubleType()) + F.lit(0.99)).alias("Price"),
        (F.col("p_size") % 5 != 0).alias("Has_Image"),
        (F.col("p_size") % 9).cast(T.LongType()).alias("quantity"),
    )


def sales_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.lit("P"), _key_text(F.col("l_partkey"))).alias("SKU"),
        F.col("l_shipdate").alias("Date"),
        F.col("l_quantity").alias("quantity"),
        ((F.col("l_suppkey") % 50).cast(T.DoubleType()) + F.lit(0.49)).alias("Price"),
    )


def performance_from_events(events: DataFrame) -> DataFrame:
    """Daily seller performance: units ordered, defect rate, mean value."""
    return (events
            .groupBy(F.to_date("ts").alias("Date"))
            .agg(F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).cast(T.LongType())
                  .alias("units_ordered"),
                 F.round(F.avg(F.when(F.col("event_type") == "error", 1.0).otherwise(0.0)), 6)
                  .alias("order_defect_rate"),
                 F.round(F.avg("value"), 6).alias("mean_value")))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings_from_part(table(spark, sf_dir, "part"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_lineitem(table(spark, sf_dir, "lineitem"))


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return performance_from_events(table(spark, sf_dir, "events"))


# ---------------------------------------------------------------------------
# Vendor-text adapters: the same tables rendered the way marketplace exports
# look (currency text, percent text, GMT stamps, spreadsheet quoting, vendor
# column names).  The clean source column is the oracle for each cleaner.
# ---------------------------------------------------------------------------
def money(c) -> F.Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def money_text(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber", money(F.col("l_extendedprice")).alias("Price"),
                           "l_returnflag")


def quantity_text(lineitem: DataFrame) -> DataFrame:
    n = F.col("l_linenumber")
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.when(n == 1, F.lit("n/a")).when(n == 2, F.lit("-3"))
                            .otherwise(F.col("l_quantity").cast(T.StringType())).alias("Quantity"))


def date_text(lineitem: DataFrame) -> DataFrame:
    n, d = F.col("l_linenumber") % 3, F.col("l_shipdate")
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.when(n == 0, F.date_format(d, "yyyy-MM-dd"))
                            .when(n == 1, F.date_format(d, "M/d/yyyy"))
                            .otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss")).alias("Date"))


def gmt_text(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.concat(F.date_format("l_shipdate", "MM/dd/yy HH:mm:ss"),
                                    F.lit(" GMT (PST)")).alias("Date"))


def excel_text(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber",
                           F.concat(F.lit('="P'), F.col("l_partkey").cast(T.StringType()), F.lit('"'))
                           .alias("SKU"))


def percent_text(lineitem: DataFrame) -> DataFrame:
    pct = (F.col("l_discount").cast(T.DecimalType(4, 2)) * F.lit(100)).cast(T.StringType())
    return lineitem.select("l_orderkey", "l_linenumber", F.concat(pct, F.lit("%")).alias("discount_rate"))


def nullable_listing(part: DataFrame) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    return part.select(
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("P"), k.cast(T.StringType()))).alias("SKU"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("Title"),
        F.when(s % 6 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("Price"),
        F.when(s % 4 == 0, F.lit(None)).otherwise(s).alias("Quantity"))


def daily_report_text(lineitem: DataFrame) -> DataFrame:
    """The 18-column daily sales-and-traffic report, one row per ship day, as text."""
    # Exact money as integer cents (long sums stay on Spark's fast path; a
    # day's total cannot overflow a long).  A "session" is an order whose
    # first line shipped that day.
    cents = F.round(F.col("l_extendedprice") * 100).cast(T.LongType())
    b2b = F.col("l_returnflag") == F.lit("R")
    agg = lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(
        (F.sum(cents) / F.lit(100.0)).alias("ops"),
        (F.sum(F.when(b2b, cents).otherwise(F.lit(0))) / F.lit(100.0)).alias("ops_b2b"),
        F.sum("l_quantity").cast(T.LongType()).alias("units"),
        F.sum(F.when(b2b, F.col("l_quantity")).otherwise(0.0)).cast(T.LongType()).alias("units_b2b"),
        F.count(F.lit(1)).alias("items"), F.count(F.when(b2b, 1)).alias("items_b2b"),
        F.count(F.when(F.col("l_linenumber") == 1, 1)).alias("sessions"))
    txt = lambda c: F.col(c).cast(T.StringType())
    none = F.lit(None).cast(T.StringType())
    return agg.select(
        F.date_format("d", "yyyy-MM-dd").alias("Date"),
        money(F.col("ops")).alias("Ordered Product Sales"),
        money(F.col("ops_b2b")).alias("Ordered Product Sales - B2B"),
        txt("units").alias("Units Ordered"), txt("units_b2b").alias("Units Ordered - B2B"),
        txt("items").alias("Total Order Items"), txt("items_b2b").alias("Total Order Items - B2B"),
        none.alias("Average Sales per Order Item"),
        none.alias("Average Sales per Order Item - B2B"),
        none.alias("Average Units per Order Item"),
        none.alias("Average Units per Order Item - B2B"),
        none.alias("Average Selling Price"),
        none.alias("Average Selling Price - B2B"),
        txt("sessions").alias("Sessions - Total"),
        none.alias("Sessions - Total - B2B"),
        F.concat(F.expr("(items_b2b * 100) div items").cast(T.StringType()), F.lit("%"))
         .alias("Order Item Session Percentage"),
        F.lit(None).cast(T.StringType()).alias("Order Item Session Percentage - B2B"),
        F.lit("1").alias("Average Offer Count"))


def vendor_listing(part: DataFrame) -> DataFrame:
    """A listing report with vendor column names and vendor text."""
    k, s = F.col("p_partkey"), F.col("p_size")
    key = k.cast(T.StringType())
    return part.select(
        F.concat(F.lit("P"), key).alias("seller-sku"),
        F.concat(F.lit("B"), F.lpad(key, 9, "0")).alias("asin1"),
        F.col("p_name").alias("item-name"),
        F.concat_ws(" ", "p_type", "p_name").alias("product-name"),
        F.when(k % 9 == 0, F.lit("n/a")).otherwise(money(F.col("p_retailprice"))).alias("price"),
        F.when(s % 7 == 0, F.lit(None).cast(T.StringType())).when(s % 11 == 0, F.lit("-1"))
         .otherwise(s.cast(T.StringType())).alias("quantity"),
        F.when(s % 4 == 0, F.lit("True")).when(s % 4 == 1, F.lit("false"))
         .when(s % 4 == 2, F.lit("yes")).otherwise(F.lit(None).cast(T.StringType())).alias("has_image"),
        F.when(k % 7 == 0, F.lit(None).cast(T.StringType())).otherwise(F.lpad(key, 13, "0"))
         .alias("external_product_id"),
        F.concat(F.lit("X"), key).alias("product-id"))


def vendor_performance(events: DataFrame) -> DataFrame:
    """A seller-performance export: GMT stamps, spreadsheet SKUs, percent text."""
    return events.select(
        F.col("event_id").alias("event-id"),
        F.concat(F.date_format("ts", "MM/dd/yy HH:mm:ss"), F.lit(" GMT (PST)")).alias("Date"),
        F.concat(F.lit('="U'), F.col("user_id").cast(T.StringType()), F.lit('"')).alias("sku"),
        F.col("event_type").alias("event_type"),
        F.concat(F.col("value").cast(T.StringType()), F.lit("%")).alias("late_shipment_rate"),
        F.concat((F.lit(90) + F.col("event_id") % 10).cast(T.StringType()), F.lit(".5%")).alias("on_time_delivery_rate"),
        F.when(F.col("event_id") % 50 == 0, F.lit("n/a")).otherwise(F.concat(
            F.lit("0.0"), F.lpad((F.col("event_id") % 100).cast(T.StringType()), 2, "0"))).alias("order_defect_rate"),
        F.col("value").alias("order_value"))


def listing_snapshot(part: DataFrame) -> DataFrame:
    """Marketplace listing snapshot (inventory summary) for every part."""
    k = F.col("p_partkey")
    key = k.cast(T.StringType())
    return part.select(
        F.concat(F.lit("P"), key).alias("SKU"),
        F.concat(F.lit("B"), F.lpad(key, 9, "0")).alias("ASIN"),
        F.col("p_name").alias("Title"),
        F.when(F.col("p_size") % 3 == 0, F.lit("Used")).otherwise(F.lit("New")).alias("Condition"),
        F.col("p_retailprice").alias("Price"),
        F.col("p_size").cast(T.LongType()).alias("Quantity"))


def catalog(part: DataFrame) -> DataFrame:
    """Catalog metadata per SKU."""
    k = F.col("p_partkey")
    key = k.cast(T.StringType())
    return part.select(
        F.concat(F.lit("P"), key).alias("SKU"),
        F.concat(F.lit("B"), F.lpad(key, 9, "0")).alias("ASIN"),
        F.col("p_name").alias("Title"),
        F.col("p_brand").alias("Author"),
        F.when(k % 7 == 0, F.lit(None).cast(T.StringType())).when(k % 13 == 0, F.lit(""))
         .otherwise(F.lpad(key, 13, "0")).alias("ISBN"),
        (F.col("p_size") % 5 != 0).alias("Has_Image"),
        F.date_format(F.date_add(F.lit("1990-01-01").cast(T.DateType()), (k % 3650).cast(T.IntegerType())),
                      "yyyy-MM-dd").alias("Publication_Date"))


def ragged_lines(lineitem: DataFrame) -> DataFrame:
    """CSV text lines with 2 fields; line 3 of an order is short, line 5 long."""
    n = F.col("l_linenumber")
    o, p, s = (F.col(c).cast(T.StringType()) for c in ("l_orderkey", "l_partkey", "l_suppkey"))
    return lineitem.select(
        F.when(n == 3, o).when(n == 5, F.concat_ws(",", o, p, s)).otherwise(F.concat_ws(",", o, p))
        .alias("value"))
