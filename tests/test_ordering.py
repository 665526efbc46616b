import numpy as np
import pandas as pd
import pytest

from shelflens.operators.describe import describe
from shelflens.operators.ordering import with_row_index
from shelflens.operators.quantiles import exact_quantiles, to_long


def test_row_index_contiguous(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("id * 7919 % 5000 as v")
    rows = with_row_index(df, ["v"], "i").collect()
    assert sorted(r["i"] for r in rows) == list(range(5000))
    assert all(r["i"] == r["v"] for r in rows)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=1001), rng.integers(0, 5, size=400).astype(float)
    pdf = pd.DataFrame({"a": np.concatenate([a, [np.nan] * 3]), "b": np.concatenate([b, [np.nan] * 604])})
    df = spark.createDataFrame(pdf).repartition(5)
    q = {(r["metric"], r["p"]): r["quantile"]
         for r in exact_quantiles(to_long(df, ["a", "b"]), [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    for m, vals in (("a", a), ("b", b)):
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert q[(m, p)] == pytest.approx(np.quantile(vals, p, method="linear"), rel=1e-12, abs=1e-12)


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 3.0, 10.0, None], "y": [5.0, 5.0, 6.0, 7.0, 8.0]})
    out = {r["statistic"]: r for r in describe(spark.createDataFrame(pdf), ["x", "y"]).collect()}
    exp = pdf.describe()
    for stat in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
        for c in ("x", "y"):
            assert out[stat][c] == pytest.approx(exp.loc[stat, c]), (stat, c)


def test_describe_approx_close(spark):
    df = spark.range(0, 10001).selectExpr("cast(id as double) as x")
    out = {r["statistic"]: r["x"] for r in describe(df, ["x"], approx_accuracy=10000).collect()}
    assert abs(out["50%"] - 5000) <= 2 and out["count"] == 10001


def test_describe_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "`Units Ordered - B2B` double, `a.b` double")
    out = {r["statistic"]: r for r in describe(df, ["Units Ordered - B2B", "a.b"]).collect()}
    assert out["mean"]["Units Ordered - B2B"] == 2.0 and out["max"]["a.b"] == 4.0
