import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelflens.operators.sales_metrics import sku_sales_summary
from shelflens.streaming.sales_stream import sales_file_stream, sku_metrics_stream, start_metrics_query

AS_OF = datetime(2001, 8, 1, 12)
SCHEMA = "SKU string, Date timestamp_ntz, quantity double, Price double"


def test_stream_equals_batch(spark, tmp_out):
    src = os.path.join(tmp_out, "sales")
    rows1 = [("A", AS_OF - timedelta(days=5), 2.0, 1.5), ("B", AS_OF - timedelta(days=60), 1.0, 2.0)]
    rows2 = [("A", AS_OF - timedelta(days=100), 4.0, 1.0), ("C", AS_OF - timedelta(days=1), 3.0, 3.0)]
    spark.createDataFrame(rows1, SCHEMA).write.parquet(os.path.join(src, "b1"))
    spark.createDataFrame(rows2, SCHEMA).write.parquet(os.path.join(src, "b2"))
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = sales_file_stream(spark, os.path.join(src, "*"), schema)
    q = start_metrics_query(sku_metrics_stream(stream, AS_OF), "memory", name="sku_metrics_test",
                            checkpoint=os.path.join(tmp_out, "ckpt"))
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.table("sku_metrics_test").collect())
    batch = sorted(tuple(r) for r in sku_sales_summary(spark.createDataFrame(rows1 + rows2, SCHEMA), AS_OF).collect())
    assert got == batch and len(got) == 3


def test_state_carries_across_micro_batches(spark, tmp_out):
    src = os.path.join(tmp_out, "sales2")
    batches = [[("A", AS_OF - timedelta(days=d), float(d % 3 + 1), 2.0) for d in range(i, 60, 7)]
               + [("B", AS_OF - timedelta(days=95 + i), 1.0, 1.0)] for i in range(4)]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = sales_file_stream(spark, os.path.join(src, "*"), schema, max_files_per_trigger=1)
    q = start_metrics_query(sku_metrics_stream(stream, AS_OF), path=os.path.join(tmp_out, "out"),
                            checkpoint=os.path.join(tmp_out, "ckpt2"))
    q.awaitTermination(180)
    assert len(q.recentProgress) >= 4          # one file per trigger
    changed = spark.read.parquet(os.path.join(tmp_out, "out"))
    assert dict(changed.groupBy("batch").count().collect()) == {k: 2 for k in range(4)}
    latest = changed.groupBy("SKU").agg(F.max_by(F.struct(*[c for c in changed.columns if c != "batch"]), "batch").alias("r")).select("r.*")
    got = sorted(tuple(r) for r in latest.collect())
    flat = [r for rows in batches for r in rows]
    batch = sorted(tuple(r) for r in sku_sales_summary(spark.createDataFrame(flat, SCHEMA), AS_OF).collect())
    assert got == batch
