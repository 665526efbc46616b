"""Per-SKU sales metrics maintained incrementally with Structured Streaming.

The same aggregation as the batch report (``sku_sales_summary``: last sale,
trailing-window units and revenue as of a fixed ``as_of``) over a folder that
receives new sales files.  State is one row per SKU; the stream's checkpoint
goes to the shared checkpoint folder, so a restarted query resumes exactly.
With many millions of SKUs, run the session with the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass`` =
``org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``)
so state lives on local disk instead of the executor heap.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelflens.operators.sales_metrics import sku_sales_summary
from shelflens.session import scratch_dir


def sales_file_stream(spark: SparkSession, path: str, schema: T.StructType,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def sku_metrics_stream(sales_stream: DataFrame, as_of: datetime) -> DataFrame:
    """Streaming per-SKU metrics (a stateful aggregation keyed by SKU)."""
    return sku_sales_summary(sales_stream, as_of)


def start_metrics_query(metrics: DataFrame, sink_format: str = "parquet_snapshot", name: str = "sku_metrics",
                        checkpoint: str | None = None, available_now: bool = True, **options) -> StreamingQuery:
    """Run the aggregation; ``checkpoint`` defaults to a fresh folder under the
    shared one.  ``parquet_snapshot`` (option ``path``) writes the changed SKUs of
    each trigger as Parquet folders ``batch=<n>`` from the executors; other sinks
    get ``complete`` output, of which ``memory`` collects the whole table in the
    driver and is for tests only."""
    if sink_format == "parquet_snapshot":
        path = options.pop("path")

        def write(rows, batch):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

        writer = (metrics.writeStream.outputMode("update").foreachBatch(write)
                  .option("checkpointLocation", checkpoint or scratch_dir(metrics.sparkSession, "stream")).options(**options))
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    writer = (metrics.writeStream.outputMode("complete").format(sink_format)
              .option("checkpointLocation", checkpoint or scratch_dir(metrics.sparkSession, "stream"))
              .options(**options))
    if sink_format == "memory":
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
