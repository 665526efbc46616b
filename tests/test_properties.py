"""Property tests: each example is a whole batch evaluated in one Spark job."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelflens.functions import cleaning as CL
from shelflens.functions import dates as D
from shelflens.operators.quantiles import exact_quantiles

AS_OF = datetime(2001, 8, 1, 12)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=-10**15, max_value=10**15), min_size=1, max_size=200))
def test_floor_days_matches_python(spark, offsets_us):
    stamps = [AS_OF - timedelta(microseconds=o) for o in offsets_us]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i long, t timestamp_ntz")
    got = {r["i"]: r["d"] for r in df.select("i", D.floor_days_since(AS_OF, F.col("t")).alias("d")).collect()}
    assert all(got[i] == (AS_OF - t) // timedelta(days=1) for i, t in enumerate(stamps))


@SETTINGS
@given(st.lists(st.integers(min_value=-10**11, max_value=10**11), min_size=1, max_size=200))
def test_currency_round_trip(spark, cents):
    texts = [f"{'-' if c < 0 else ''}${abs(c) / 100:,.2f}" for c in cents]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r["i"]: r["v"] for r in df.select("i", CL.clean_currency(F.col("t")).alias("v")).collect()}
    assert all(got[i] == float(f"{c / 100:.2f}") for i, c in enumerate(cents))


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10000), min_size=1, max_size=200))
def test_percent_round_trip(spark, basis_points):
    texts = [f"{b / 100:.2f}%" for b in basis_points]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r["i"]: r["v"] for r in df.select("i", CL.clean_percentage(F.col("t")).alias("v")).collect()}
    assert all(got[i] == pytest.approx(b / 10000, abs=1e-12) for i, b in enumerate(basis_points))


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=300),
       st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=300))
def test_quantiles_match_numpy(spark, small, wide):
    rows = [("s", float(v)) for v in small] + [("w", float(v)) for v in wide]
    df = spark.createDataFrame(rows, "metric string, value double").repartition(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["metric"], r["p"]): r["quantile"] for r in exact_quantiles(df, probs).collect()}
    for m, vals in (("s", small), ("w", wide)):
        for p in probs:
            assert got[(m, p)] == pytest.approx(float(np.quantile(np.array(vals, dtype=float), p)), rel=1e-9, abs=1e-9)
