"""Bucketed tables: co-locate sales lines and listings on SKU.

A report that runs every day over the same large tables pays for the
SKU shuffle of both sides every time.  Written once bucketed (and sorted) by
SKU with the same bucket count, the per-SKU aggregation reads each bucket as
a hash partition and the left join becomes a sort-merge join of matching
buckets: no exchange at all.  Pick the bucket count so a bucket is a few
hundred MB (e.g. ``input_bytes / 256 MB``), and use the same count for both
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_bucketed(df: DataFrame, table: str, key: str = "SKU", buckets: int = 64,
                  path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a parquet table bucketed and sorted by ``key``."""
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
