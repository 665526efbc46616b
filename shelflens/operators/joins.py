"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def semi_join(left: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``left`` whose key appears in ``keys``.

    Keys are made distinct first, so a key that fills a third of ``keys``
    costs one row per map task.  AQE broadcasts the key list only if its bytes,
    known at run time, are below the session's threshold.
    """
    on = [on] if isinstance(on, str) else list(on)
    keys = keys.select(*on).where(" AND ".join(f"`{c}` IS NOT NULL" for c in on)).distinct()
    return left.join(keys, on, "left_semi")


def _co_located(df: DataFrame) -> bool:
    """Whether the plan moves no rows by key (both sides bucketed alike).  Plans only, runs nothing."""
    return "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def left_join_unique(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """``left`` joined to ``right``, an aggregate by ``on`` (one row per key), lazily.

    Straight from its aggregate, the right side has no exchange of its own, and AQE
    can only split a key that fills a third of ``left`` (or its NULL keys) between two
    exchanges.  So the join also asks for a hash of the key: both sides are dealt out for
    the join itself, AQE cuts a hot key's rows into pieces and sends its one right
    row to each, or broadcasts a right side that proves small.  Tables bucketed by the
    key keep their plan without any exchange.
    """
    plain = left.join(right, on, "left")
    if _co_located(plain):
        return plain
    names, hashed = plain.columns, "join_hash"
    while hashed in names:
        hashed += "_"
    return (left.withColumn(hashed, F.xxhash64(on)).join(right.withColumn(hashed, F.xxhash64(on)), [on, hashed], "left")
            .select(*[F.col(f"`{c}`") for c in names]))
