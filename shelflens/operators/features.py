"""Feature preparation for clustering.

Standardisation is fit/transform like MLlib: one distributed aggregate
computes mean and population std per column (a handful of numbers reach the
driver), then the transform is plain column arithmetic with literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K

FEATURES = ["Price", "Sales_Last_30d", "Sales_Last_90d", "Days_Since_Last_Sale", "Has_Image", "Has_ISBN"]
# Per-row identity of a listing.  Listings may repeat a SKU (even a third of
# all rows), so clustering results are joined back by this id, never by SKU.
ITEM_ID = "item_id"


def with_item_id(items: DataFrame) -> DataFrame:
    """Attach a unique row id (stable once the frame is checkpointed)."""
    if ITEM_ID in items.columns:
        return items
    return items.withColumn(ITEM_ID, F.monotonically_increasing_id())


def feature_columns(items: DataFrame) -> list:
    """The I1 feature expressions over an item table (internal column names).

    Never-sold items get 365 days; absent image/ISBN columns give 0; a
    missing price counts as 0.0 (the cleaning default).
    """
    cols = items.columns
    has_image = (F.coalesce(F.col("Has_Image"), F.lit(False)).cast(T.DoubleType())
                 if "Has_Image" in cols else F.lit(0.0))
    has_isbn = (F.col("ISBN").isNotNull().cast(T.DoubleType()) if "ISBN" in cols else F.lit(0.0))
    return [
        F.coalesce(F.col("Price").cast(T.DoubleType()), F.lit(0.0)).alias("Price"),
        F.coalesce(F.col("Sales_Last_30d"), F.lit(0.0)).cast(T.DoubleType()).alias("Sales_Last_30d"),
        F.coalesce(F.col("Sales_Last_90d"), F.lit(0.0)).cast(T.DoubleType()).alias("Sales_Last_90d"),
        F.coalesce(F.col("Days_Since_Last_Sale").cast(T.DoubleType()),
                   F.lit(float(K.NEVER_SOLD_DAYS_FEATURE))).alias("Days_Since_Last_Sale"),
        has_image.alias("Has_Image"),
        has_isbn.alias("Has_ISBN"),
    ]


def cluster_features(items: DataFrame, extra=()) -> DataFrame:
    """Numeric features per item, keyed by ``item_id`` (+ ``extra`` columns)."""
    return with_item_id(items).select(ITEM_ID, "SKU", *feature_columns(items), *extra)


def fit_standardizer(df: DataFrame, cols) -> dict[str, tuple[float, float]]:
    """Mean and population std per column (constant column -> scale 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"m_{c}"), F.stddev_pop(F.col(f"`{c}`")).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        mean = row[f"m_{c}"] if row[f"m_{c}"] is not None else 0.0
        std = row[f"s_{c}"]
        out[c] = (float(mean), float(std) if std and std > 0 else 1.0)
    return out


def apply_standardizer(df: DataFrame, stats: dict[str, tuple[float, float]],
                       digits: int | None = None, suffix: str = "") -> DataFrame:
    cols = {}
    for c, (mean, std) in stats.items():
        z = (F.col(f"`{c}`").cast(T.DoubleType()) - F.lit(mean)) / F.lit(std)
        cols[c + suffix] = F.round(z, digits) if digits is not None else z
    return df.withColumns(cols)


def standardize(df: DataFrame, cols, digits: int | None = None, suffix: str = "") -> DataFrame:
    """Z-scores with population std, as scikit-learn's StandardScaler."""
    return apply_standardizer(df, fit_standardizer(df, cols), digits, suffix)
