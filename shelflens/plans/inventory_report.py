"""H1: the per-item inventory report (flagship), and the wide item table the
other reports are filters/sorts of.

Plan shape: scan(sales) -> partial agg -> shuffle(SKU) -> final agg
            -> join(listings, left) -> one projection.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions import rules
from shelflens.functions.dates import ensure_timestamp
from shelflens.operators import columns as C
from shelflens.operators.sales_metrics import revenue_col, sales_col, with_sales_metrics

REQUIRED_SALES = ("Date", "SKU", "quantity")

RENAMES = {
    sales_col(30): "Sales Last 30d",
    sales_col(90): "Sales Last 90d",
    "Days_Since_Last_Sale": "Days Since Last Sale",
    revenue_col(30): "Revenue Last 30d",
    revenue_col(90): "Revenue Last 90d",
}


def prepare_sales(sales: DataFrame) -> DataFrame:
    """B1 + B2 + C4: canonical ``quantity``, required columns, timestamp Date."""
    C.require_columns(sales, (), "Sales")
    sales = C.normalize_quantity(sales)
    C.require_columns(sales, REQUIRED_SALES, "Sales")
    dtype = sales.schema["Date"].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        sales = sales.withColumn("Date", ensure_timestamp(dtype, F.col("Date")))
    return sales


def prepare_listings(inventory: DataFrame) -> DataFrame:
    C.require_columns(inventory, (), "Inventory")
    return C.normalize_quantity(inventory)


def item_table(sales: DataFrame, inventory: DataFrame, as_of: datetime) -> DataFrame:
    """Listings + per-SKU metrics + all flags, with internal column names."""
    sales = prepare_sales(sales)
    inventory = prepare_listings(inventory)
    df = with_sales_metrics(inventory, sales, as_of)
    cols = inventory.columns
    days = F.col("Days_Since_Last_Sale")
    s30, s90 = F.col(sales_col(30)), F.col(sales_col(90))
    stale = rules.is_stale(days, s30)
    bad = rules.bad_metadata(cols)
    return df.withColumns({
        "Is_Stale": stale,
        "Bad_Metadata": bad,
    }).withColumns({
        "Flag": rules.flag(F.col("Is_Stale"), F.col("Bad_Metadata")),
        "Notes": rules.notes(F.col("Is_Stale"), F.col("Bad_Metadata")),
        "Metadata_Quality_Score": rules.metadata_quality_score(cols),
    })


def to_report(items: DataFrame, keep=()) -> DataFrame:
    """Spaced names, fixed order, only the columns that exist (+ ``keep``)."""
    renamed = items.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in items.columns})
    return C.project_existing(renamed, list(K.REPORT_COLUMNS) + list(keep))


def inventory_report(sales: DataFrame, inventory: DataFrame, as_of: datetime) -> DataFrame:
    """H1: ``SKU, Title, ISBN, Price, Has_Image, quantity, Sales Last 30d, ...``."""
    return to_report(item_table(sales, inventory, as_of))
