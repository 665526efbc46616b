"""F-A9: ``describe`` -- count, mean, sample std, min, quartiles, max.

Moments and the sketch that brackets the quartiles come from one partial/final
aggregate; quartiles are *exact* (linear interpolation, as pandas) via the
distributed selection of ``quantiles``.  ``percentile`` would keep a per-group
value map in one task, and ``DataFrame.summary()`` returns nearest-rank values
(1/2/3 where pandas gives 1.75/2.5/4.75), so neither is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.operators.quantiles import select_quantiles, to_long

STATISTICS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def describe_long(df: DataFrame, metrics, digits: int | None = None,
                  approx_accuracy: int | None = None) -> DataFrame:
    """``(metric, statistic, value)`` rows, one per metric x statistic.

    ``approx_accuracy`` switches the quartiles to ``percentile_approx`` (one
    pass, bounded sketch per metric, nearest-rank values) for inputs where an
    exact sort is not wanted; the default is exact.
    """
    long = to_long(df, metrics)
    moments = [F.count(F.lit(1)).cast(T.DoubleType()), F.avg("__v"), F.stddev_samp("__v"), F.min("__v"), F.max("__v")]
    names = [n for n in STATISTICS if n not in QUARTILES]
    if approx_accuracy:
        qs = F.percentile_approx("__v", list(QUARTILES.values()), approx_accuracy)
        wide = (long.withColumnRenamed("value", "__v").groupBy("metric")
                .agg(*[m.alias(n) for m, n in zip(moments, names)], qs.alias("__q"))
                .select("metric", *names, *[F.col("__q")[i].alias(k) for i, k in enumerate(QUARTILES)]))
        out = wide.unpivot("metric", STATISTICS, "statistic", "value")
    else:
        found = select_quantiles(long, list(QUARTILES.values()), [m.alias(n) for m, n in zip(moments, names)])
        rows = [(r["__g"], n, r[n] if n not in QUARTILES else quantiles[QUARTILES[n]])
                for r, quantiles in found for n in STATISTICS]
        out = df.sparkSession.createDataFrame(rows, "metric string, statistic string, value double")
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out


def describe(df: DataFrame, metrics, digits: int | None = None,
             approx_accuracy: int | None = None) -> DataFrame:
    """pandas layout: one row per statistic, one column per metric."""
    metrics = list(metrics)
    long = describe_long(df, metrics, digits, approx_accuracy)
    return (long.groupBy("statistic")
            .pivot("metric", metrics)
            .agg(F.first("value")))
