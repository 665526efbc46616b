"""Exact quantiles by selection: brackets, narrowing, ties, odd values."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def check(spark, groups, leaf=Q.LEAF):
    df = spark.createDataFrame([(g, float(v)) for g, vals in groups.items() for v in vals], "metric string, value double").repartition(7)
    got = {(r["metric"], r["p"]): r["quantile"] for r in Q.exact_quantiles(df, PROBS, leaf=leaf).collect()}
    assert len(got) == len(groups) * len(PROBS)
    for g, vals in groups.items():
        for p in PROBS:
            assert got[g, p] == pytest.approx(float(np.quantile(np.array(vals, dtype=float), p)), rel=1e-12, abs=1e-300), (g, p)


def sample(n):
    rng = np.random.default_rng(3)
    return {"normal": rng.normal(size=n), "wide": 10.0 ** rng.uniform(-200, 200, size=n),
            "hot": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 10, size=n)),
            "edge": np.concatenate([np.full(n // 2, 2.0), np.full(n // 2, 3.0)]), "one": [4.0]}


def test_brackets_of_large_groups(spark):
    check(spark, sample(30_000))


def test_narrowing_reads_few_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "ACCURACY", 100)     # wide brackets
    monkeypatch.setattr(Q, "PIVOTS", 4)
    check(spark, sample(4_000), leaf=8)


def test_a_wrong_sketch_is_seen(spark, monkeypatch):
    monkeypatch.setattr(Q, "ACCURACY", 500)
    right = Q._brackets
    calls = []

    def wrong(row, probs):
        calls.append(row["__g"])
        return [(a + 0.5, b + 0.5) for a, b in right(row, probs)]
    monkeypatch.setattr(Q, "_brackets", wrong)
    check(spark, {k: v for k, v in sample(3_000).items() if k in ("normal", "hot")})
    assert sorted(calls) == ["hot", "normal"]


def test_infinite_values_beside_fewer_brackets(spark, monkeypatch):
    monkeypatch.setattr(Q, "ACCURACY", 200)
    df = spark.createDataFrame([("w", float(v)) for v in np.arange(3000.0)] + [("c", 1.0)] * 900 + [("c", float("inf"))] * 900, "metric string, value double")
    got = {(r["metric"], r["p"]): r["quantile"] for r in Q.exact_quantiles(df, [0.1, 0.25, 0.75, 0.9]).collect()}
    assert got["c", 0.25] == 1.0 and got["c", 0.9] == float("inf")
    assert got["w", 0.25] == float(np.quantile(np.arange(3000.0), 0.25))


def test_missing_values_and_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("a", -0.0), ("a", 0.0),
                                ("i", float("inf")), ("i", float("-inf")), ("i", 5.0), (None, 1.0), ("n", None)], "metric string, value double")
    got = {(r["metric"], r["p"]): r["quantile"] for r in Q.exact_quantiles(df, [0.0, 0.5, 1.0]).collect()}
    assert got == {("a", 0.0): 0.0, ("a", 0.5): 0.5, ("a", 1.0): 3.0, ("i", 0.0): float("-inf"), ("i", 0.5): 5.0, ("i", 1.0): float("inf")}
    assert Q.exact_quantiles(df.limit(0), [0.5]).count() == 0


def test_little_is_written(spark, monkeypatch):
    seen = []
    keep = Q.written
    monkeypatch.setattr(Q, "written", lambda df, name: seen.append(keep(df, name)) or seen[-1])
    df = spark.range(400_000).select(F.lit("m").alias("metric"), F.hash("id").cast("double").alias("value"))
    Q.exact_quantiles(df, [0.25, 0.5, 0.75]).collect()
    assert len(seen) == 1 and seen[0].count() < 400_000 * 0.01
