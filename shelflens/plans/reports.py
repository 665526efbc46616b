"""Derived reports (H2-H9, G7-G10, F-A6, F-A7): filters, projections and
sorts over the per-item report.  Sorts are total: the reference sorts by one
key with unspecified tie order, so ``SKU`` is added as the tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions import rules

S30, S90, DAYS = "Sales Last 30d", "Sales Last 90d", "Days Since Last Sale"
R30, R90 = "Revenue Last 30d", "Revenue Last 90d"


def c(name: str):
    return F.col(f"`{name}`")


# -- H2-H4: the three base buckets ----------------------------------------
def report_stale(report: DataFrame) -> DataFrame:
    return report.where(F.col("Is_Stale"))


def report_bad_metadata(report: DataFrame) -> DataFrame:
    return report.where(F.col("Bad_Metadata"))


def report_good_sellers(report: DataFrame) -> DataFrame:
    return report.where(~F.col("Is_Stale") & ~F.col("Bad_Metadata"))


# -- H5, H6, H8: sorted projections -----------------------------------------
def report_sales_velocity(report: DataFrame) -> DataFrame:
    return (report.select("SKU", "Title", c(S30), c(S90), c(DAYS))
            .orderBy(c(S90).desc_nulls_last(), F.col("SKU")))


def report_metadata_quality(report: DataFrame) -> DataFrame:
    cols = [x for x in ("SKU", "Title", "ISBN", "Has_Image", "Metadata_Quality_Score")
            if x in report.columns]
    return (report.select(*cols)
            .orderBy(F.col("Metadata_Quality_Score").desc_nulls_last(), F.col("SKU")))


def report_revenue(report: DataFrame) -> DataFrame:
    if R90 not in report.columns:
        raise ValueError("revenue report needs sales with a Price column")
    return (report.select("SKU", "Title", c(R30), c(R90), c(S30), c(S90))
            .orderBy(c(R90).desc_nulls_last(), F.col("SKU")))


# -- G7-G10 (file-report rules) and H7 ----------------------------------------
def stale_items_strict(report: DataFrame) -> DataFrame:
    qty = F.col("quantity") if "quantity" in report.columns else F.lit(None)
    return report.where(rules.stale_strict(c(DAYS), c(S90), qty))


def bad_metadata_strict(report: DataFrame) -> DataFrame:
    return report.where(rules.bad_metadata(report.columns, empty_isbn_is_missing=True))


def good_sellers_strict(report: DataFrame) -> DataFrame:
    return report.where(rules.good_seller_strict(report.columns, c(DAYS), c(S30)))


def with_heuristic_score(report: DataFrame) -> DataFrame:
    return report.withColumn("Heuristic_Score",
                             rules.heuristic_score(report.columns, c(DAYS), c(S90)))


def report_heuristic(report: DataFrame) -> DataFrame:
    scored = with_heuristic_score(report)
    return (scored.select("SKU", "Title", "ISBN", "Has_Image", "Price", "Heuristic_Score")
            .orderBy(F.col("Heuristic_Score").desc(), F.col("SKU")))


# -- H9, F-A6, F-A7: data behind the plots -----------------------------------
NEEDS_ATTENTION = "Needs Attention"
GOOD_SELLER_LABEL = "Good Seller"


def _label(flag_col):
    return F.when(flag_col == F.lit(K.FLAG_WARN), F.lit(NEEDS_ATTENTION)).otherwise(F.lit(GOOD_SELLER_LABEL))


def stale_scatter(report: DataFrame) -> DataFrame:
    return report.select("SKU", c(DAYS), c(S30), _label(F.col("Flag")).alias("Class"))


def flag_counts(report: DataFrame) -> DataFrame:
    """Rows per flag with the total and the share of all items.

    The total comes from the same grouped result (a window over a handful
    of flag rows), so the item table is scanned once.
    """
    from pyspark.sql import Window
    per_flag = report.groupBy("Flag").agg(F.count(F.lit(1)).alias("items"))
    total = F.sum("items").over(Window.partitionBy())
    return per_flag.select(
        "Flag", _label(F.col("Flag")).alias("Label"), "items",
        total.alias("total_items"),
        F.round(F.col("items").cast(T.DoubleType()) / total, 6).alias("share"))


def sales_distribution(report: DataFrame) -> DataFrame:
    return (report.groupBy(c(S30).alias(S30))
            .agg(F.count(F.lit(1)).alias("items"))
            .orderBy(c(S30)))
