"""k nearest neighbours from random-projection trees, no pair outside a leaf.

Each tree halves its leaves level by level at the median of a random projection
(one mergeable sketch per leaf; rows at the median part by a hash of their id, so a
third of equal vectors still spreads).  Leaves end at about ``leaf`` rows; a task
compares the rows of one leaf at a time, and each row keeps the best of all trees.
Every level is written: nothing holds more than a leaf.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflens.session import written

TREES = 4
SEED = 42


def _leaf_rows(points: DataFrame, n: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """``(tree, leaf, id, v)``: every row once per tree."""
    depth = max(0, math.ceil(math.log2(n / leaf))) if n else 0

    def project(batches):
        directions = None
        for batch in batches:
            v = batch.column(1)
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) if len(v) else np.zeros((0, 1))
            if directions is None:
                directions = np.random.default_rng(seed).normal(size=(x.shape[1], trees * depth))
            p = x @ directions
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array(list(p), pa.list_(pa.float64()))], names=["id", "v", "p"])

    rows = written(points.mapInArrow(project, "id long, v array<double>, p array<double>"), "projected")
    place = written(rows.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "id", F.lit(0).cast("long").alias("leaf"), "p"), "leaves")
    for level in range(depth):
        now = place.withColumn("x", F.get(F.col("p"), F.col("tree") * depth + level))
        middle = written(now.groupBy("tree", "leaf").agg(F.percentile_approx("x", 0.5, 1000).alias("middle")), "medians")
        bit = F.pmod(F.xxhash64("id", F.lit(level), "tree"), F.lit(2)) == 1
        upper = (F.col("x") > F.col("middle")) | ((F.col("x") == F.col("middle")) & bit)
        place = written(now.join(middle, ["tree", "leaf"]).select("tree", "id", (F.col("leaf") * 2 + upper.cast("long")).alias("leaf"), "p"), "leaves")
    return place.select("tree", "leaf", "id").join(rows.select("id", "v"), "id")


def nearest_neighbours(points: DataFrame, k: int, n: int | None = None, trees: int = TREES, leaf: int | None = None,
                       seed: int = SEED) -> DataFrame:
    """``points(id long, v array<double>)``, ids unique, vectors of one length ->
    ``(id, other, d2)``: up to ``k`` near rows of each, by squared distance, then id.

    Approximate beyond one leaf (``leaf``, at least three times ``k``); rows of an empty
    table or a single row have no neighbours."""
    n = points.count() if n is None else n
    leaf = leaf or max(128, 3 * k)

    def best(batches):
        def of_leaf(ids, x):
            d2 = ((x * x).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * x @ x.T).clip(0)
            np.fill_diagonal(d2, np.inf)
            order = np.lexsort((np.broadcast_to(ids, d2.shape), d2), axis=1)[:, :min(k, len(ids) - 1)]
            return [pa.array(np.repeat(ids, order.shape[1])), pa.array(ids[order].reshape(-1)), pa.array(np.take_along_axis(d2, order, 1).reshape(-1))]

        key, ids, rows = None, [], []
        for batch in batches:
            for t, l, i, v in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (t, l) != key and len(ids) > 1:
                    yield pa.RecordBatch.from_arrays(of_leaf(np.array(ids), np.array(rows)), names=["id", "other", "d2"])
                if (t, l) != key:
                    key, ids, rows = (t, l), [], []
                ids.append(i), rows.append(v)
        if len(ids) > 1:
            yield pa.RecordBatch.from_arrays(of_leaf(np.array(ids), np.array(rows)), names=["id", "other", "d2"])

    leaves = _leaf_rows(points, n, trees, leaf, seed).select("tree", "leaf", "id", "v")
    found = leaves.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf").mapInArrow(best, "id long, other long, d2 double")
    near = Window.partitionBy("id").orderBy("d2", "other")  # at most trees * k rows of an id
    return (found.groupBy("id", "other").agg(F.min("d2").alias("d2")).withColumn("rank", F.row_number().over(near))
            .where(F.col("rank") <= k).drop("rank"))
