"""Seller-performance analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions.dates import ensure_timestamp
from shelflens.operators.describe import describe

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def select_metrics(df: DataFrame) -> list[str]:
    """The known rate columns that are present, else every numeric column."""
    known = [m for m in K.PERFORMANCE_METRICS if m in df.columns]
    if known:
        return known
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def time_column(df: DataFrame) -> str | None:
    for c in K.PERFORMANCE_TIME_COLUMNS:
        if c in df.columns:
            return c
    return None


def performance_summary(df: DataFrame, digits: int | None = None,
                        approx_accuracy: int | None = None) -> DataFrame:
    """describe() over the selected metrics, with a ``statistic`` column
    (exact quartiles unless ``approx_accuracy`` asks for ``percentile_approx``)."""
    metrics = select_metrics(df)
    if not metrics:
        return df.sparkSession.createDataFrame([], "statistic string")
    return describe(df, metrics, digits, approx_accuracy)


def performance_trend(df: DataFrame) -> DataFrame:
    """``(time, metric, value)`` series sorted by time; unparseable time -> NULL."""
    tcol = time_column(df)
    metrics = select_metrics(df)
    if tcol is None or not metrics:
        return df.sparkSession.createDataFrame([], "time timestamp_ntz, metric string, value double")
    dtype = df.schema[tcol].dataType
    timed = df.select(ensure_timestamp(dtype, F.col(f"`{tcol}`")).alias("time"),
                      *[F.col(f"`{m}`").try_cast(T.DoubleType()).alias(m) for m in metrics])
    return (timed.unpivot("time", [F.col(f"`{m}`") for m in metrics], "metric", "value")
            .orderBy(F.col("time").asc_nulls_last(), "metric"))
