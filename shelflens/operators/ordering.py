"""Contiguous row numbers without funnelling data through one task.

``with_row_index`` sorts once (range-partitioned, spillable), pins the sorted
partitions with a reliable ``checkpoint`` in the shared checkpoint folder
(so numbers stay stable if an executor is lost and the lineage is cut), and then
turns per-partition counts -- a table with one row per partition, i.e. bounded
by the partition count, never by the data -- into global numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.session import ensure_checkpoint_dir

_PID, _POS = "__pid", "__pos"


def _sorted_with_positions(df: DataFrame, order_cols) -> DataFrame:
    """Total order on ``order_cols`` plus a tie-break from the input position.

    The tie-break lets the range partitioner split a hot value (one value may
    hold a third of all rows) across many sort tasks instead of one.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = (df.withColumn("__tie", F.monotonically_increasing_id())
               .orderBy(*order_cols, F.col("__tie")).drop("__tie"))
    ordered = ordered.withColumn(_PID, F.spark_partition_id())
    # monotonically_increasing_id = (partition << 33) + position in partition
    ordered = ordered.withColumn(
        _POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast(T.LongType()), 33))
    return ordered.checkpoint(eager=True)


def with_row_index(df: DataFrame, order_cols, name: str = "row_index") -> DataFrame:
    """Append a contiguous 0-based row number following ``order_cols``."""
    ordered = _sorted_with_positions(df, order_cols)
    counts = ordered.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # ``offsets`` has one row per partition of ``ordered``: a proven size bound.
    return (ordered.join(F.broadcast(offsets), _PID)
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("__off") + F.col(_POS)).cast(T.LongType()).alias(name)))
