"""Principal components with MLlib.

``ml.feature.PCA`` computes the d x d covariance with a distributed tree
aggregate and does *not* centre in ``transform``, so vectors are centred
(and optionally scaled, i.e. the correlation-matrix variant) by a fitted
``StandardScaler`` first.  Component signs are fixed so that the loading
with the largest magnitude is positive, which makes output reproducible.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pca(df: DataFrame, vector_col: str, k: int = 2, keep=(), use_correlation: bool = False,
        prefix: str = "pc") -> DataFrame:
    """Project ``vector_col`` (array or vector) on the first ``k`` components."""
    col = F.col(vector_col)
    if dict(df.dtypes)[vector_col].startswith("array"):
        col = array_to_vector(F.transform(col, lambda x: x.cast("double")))
    base = df.select(*keep, col.alias("__x"))
    scaler = StandardScaler(inputCol="__x", outputCol="__c", withMean=True, withStd=use_correlation)
    centred = scaler.fit(base).transform(base)
    model = PCA(k=k, inputCol="__c", outputCol="__pc").fit(centred)
    loadings = model.pc.toArray()                       # d x k, small
    signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, j])), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array(F.col("__pc"))
    return model.transform(centred).select(
        *keep, *[(arr[j] * F.lit(signs[j])).alias(f"{prefix}{j + 1}") for j in range(k)])


def explained_variance(df: DataFrame, vector_col: str, k: int = 2) -> list[float]:
    col = F.col(vector_col)
    if dict(df.dtypes)[vector_col].startswith("array"):
        col = array_to_vector(F.transform(col, lambda x: x.cast("double")))
    base = df.select(col.alias("__x"))
    centred = StandardScaler(inputCol="__x", outputCol="__c", withMean=True, withStd=False).fit(base).transform(base)
    return list(PCA(k=k, inputCol="__c", outputCol="__pc").fit(centred).explainedVariance.toArray())
