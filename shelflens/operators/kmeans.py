"""K-means clustering of items (I3-I5, F-A5, F-A8, F-A10).

The default fit is Lloyd's algorithm as DataFrame aggregates.  z-scores are held in
fixed point (steps of ``1 / RESOLUTION``), so every sum is a sum of integers: labels
depend neither on the order of rows nor on partitions, plans or retries, and SQL can
follow them.  The start is deterministic and distributed: the row nearest to the mean,
then the row farthest from all chosen ones (ties by the smallest values), one
aggregate each.  Each iteration is one scan of the written features with map-side
partial sums; k x columns numbers reach the driver, and they come back as literals,
so a label is a plain expression over a row and joins nothing.  The loop stops when
the centres have moved by at most ``TOLERANCE`` in all (squared, z units).

``init_mode="k-means||"`` and ``"random"`` use MLlib's fit instead.
Cluster ids are arbitrary, so they are renumbered by ascending (mean raw price,
size, smallest SKU hash) to make results comparable run to run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.operators.features import FEATURES, ITEM_ID, fit_standardizer, standardize
from shelflens.session import ensure_checkpoint_dir, written

RESOLUTION = 1 << 20  # steps of a z-score
TOLERANCE = 1e-4  # squared movement of all centres that ends the fit


def n_clusters_for(n_items: int, rule: str = "file") -> int | None:
    """I4: cluster count from the item count; None (skip) below 5 items."""
    if n_items < 5:
        return None
    if rule == "demo":
        return min(3, max(2, n_items - 1))
    return min(3, max(2, n_items // 10))


def pin_features(features: DataFrame, partitions: int | None = None) -> DataFrame:
    """Materialise the feature table once (reliable checkpoint).

    Rows are hash-partitioned by SKU and features into a fixed number of
    partitions (the listings of a SKU that fills a third of the rows spread by
    their own values; the row id depends on the plan and is left out) and
    totally ordered inside each, so K-means|| seeding sees the same layout
    whatever plan (broadcast or sort-merge, coalesced or not) produced them.
    """
    spark = features.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["SKU"] + [c for c in FEATURES if c in features.columns] + \
        ([ITEM_ID] if ITEM_ID in features.columns else [])
    return features.repartition(n, *[c for c in order if c != ITEM_ID]).sortWithinPartitions(*order).checkpoint(eager=True)


@dataclass
class Fit:
    """A fitted K-means: mean and deviation per column, centres in steps, the
    number of iterations and the last movement."""

    scale: dict
    centres: list
    iterations: int
    moved: float

    def steps(self) -> list:
        return [_steps(c, *self.scale[c]) for c in self.scale]

    def label(self):
        """Place of the nearest centre (the first of equally near ones)."""
        return _nearest(self.steps(), self.centres)


def _steps(column: str, mean: float, std: float):
    z = (F.col(f"`{column}`").cast(T.DoubleType()) - F.lit(mean)) / F.lit(std)
    return F.floor(z * F.lit(float(RESOLUTION)) + F.lit(0.5)).cast(T.LongType())


def _distance(steps, centre):
    terms = [(s - F.lit(float(c))) * (s - F.lit(float(c))) for s, c in zip(steps, centre)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _nearest(steps, centres):
    far = [_distance(steps, c) for c in centres]
    label = F.lit(len(far) - 1)
    for k in range(len(far) - 2, -1, -1):
        closest = F.lit(True)
        for other in far[k + 1:]:
            closest = closest & (far[k] <= other)
        label = F.when(closest, F.lit(k)).otherwise(label)
    return label.cast(T.IntegerType())


def _start(rows: DataFrame, names, k: int) -> list:
    """k rows as first centres: nearest to the mean, then farthest from the chosen."""
    values = F.struct(*names)
    upwards = F.struct(*[(-F.col(n)).alias(n) for n in names])  # the largest is the smallest row
    first = _distance([F.col(n) for n in names], [0.0] * len(names))
    centres = [list(rows.agg(F.min_by(values, F.struct(first.alias("d"), values.alias("v"))).alias("c")).first()["c"])]
    while len(centres) < k:
        near = [_distance([F.col(n) for n in names], c) for c in centres]
        least = near[0] if len(near) == 1 else F.least(*near)
        centres.append(list(rows.agg(F.max_by(values, F.struct(least.alias("d"), upwards.alias("v"))).alias("c")).first()["c"]))
    return [[float(x) for x in c] for c in centres]


def kmeans_fit(features: DataFrame, k: int, cols=FEATURES, max_iter: int = K.KMEANS_MAX_ITER,
               tolerance: float = TOLERANCE) -> Fit:
    """Fit on ``features`` (scanned once per pass: pass a written table).

    An empty cluster keeps its centre; rows with a NULL feature are left out of the
    fit (and have no label); fewer distinct rows than k give equal centres, of which
    the first takes the rows; an empty table raises ``ValueError``."""
    scale = fit_standardizer(features, cols)
    names = [f"s{j}" for j in range(len(cols))]
    rows = features.select(*[_steps(c, *scale[c]).alias(n) for c, n in zip(cols, names)])
    rows = rows.where(" AND ".join(f"{n} IS NOT NULL" for n in names))
    if rows.isEmpty():
        raise ValueError("no rows to cluster")
    centres, moved, done = _start(rows, names, k), float("inf"), 0
    while done < max_iter and moved > tolerance:
        label = _nearest([F.col(n) for n in names], centres)
        sums = {r["label"]: r for r in rows.groupBy(label.alias("label"))
                .agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).collect()}  # k rows
        new = [[sums[j][n] / sums[j]["n"] for n in names] if j in sums else c for j, c in enumerate(centres)]
        moved = sum((a - b) ** 2 for c, d in zip(centres, new) for a, b in zip(c, d)) / RESOLUTION**2
        centres, done = new, done + 1
    return Fit(scale, centres, done, moved)


def kmeans_labels(features: DataFrame, k: int, seed: int = K.KMEANS_SEED,
                  max_iter: int = K.KMEANS_MAX_ITER, cols=FEATURES, init_mode: str = "farthest",
                  carry=()) -> DataFrame:
    """``(item_id, SKU, Cluster, <raw features>)`` of a written or pinned feature
    table.  A label is an expression over the row, so the raw feature columns (and
    any ``carry`` columns) need no join back.

    ``init_mode="farthest"`` is the deterministic fit above; ``"k-means||"`` is MLlib's
    scalable k-means++ seeding, ``"random"`` matches the accelerated path's random starts.
    """
    raw = [c for c in cols if c != "Price"]
    carry = [c for c in carry if c not in (ITEM_ID, "SKU", "Price", *raw)]
    if init_mode == "farthest":
        labelled = features.withColumn("raw_cluster", kmeans_fit(features, k, cols, max_iter).label())
    else:
        z = standardize(features, cols, suffix="_z")
        assembled = VectorAssembler(inputCols=[c + "_z" for c in cols], outputCol="features").transform(z)
        model = KMeans(k=k, seed=seed, maxIter=max_iter, initMode=init_mode, featuresCol="features",
                       predictionCol="raw_cluster").fit(assembled)
        labelled = model.transform(assembled)
    labelled = labelled.select(ITEM_ID, "SKU", "Price", *raw, *carry, "raw_cluster")
    # k rows: one per cluster, renumbered in a stable order.
    order = (labelled.groupBy("raw_cluster")
             .agg(F.avg("Price").alias("__p"), F.count(F.lit(1)).alias("__n"), F.min(F.xxhash64("SKU")).alias("__s")))
    ranked = order.select("raw_cluster", (F.row_number().over(
        Window.orderBy("__p", "__n", "__s")) - 1).cast(T.IntegerType()).alias("Cluster"))
    return labelled.join(F.broadcast(ranked), "raw_cluster").select(ITEM_ID, "SKU", "Cluster", "Price", *raw, *carry)


def _labelled(features: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with ``Cluster`` and the feature columns (joined 1:1 on the row id
    only when the labels do not already carry the features)."""
    if labels is None:
        return features
    return features.join(labels.select(ITEM_ID, "Cluster"), ITEM_ID)


def cluster_stats(features: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """F-A5: per cluster mean price / sales / days / image / ISBN and item count."""
    j = _labelled(features, labels)
    return j.groupBy("Cluster").agg(
        F.avg("Price").alias("mean_Price"),
        F.avg("Sales_Last_30d").alias("mean_Sales_Last_30d"),
        F.avg("Days_Since_Last_Sale").alias("mean_Days_Since_Last_Sale"),
        F.avg("Has_Image").alias("mean_Has_Image"),
        F.avg("Has_ISBN").alias("mean_Has_ISBN"),
        F.count("SKU").alias("items"))


def describe_clusters(stats: DataFrame) -> DataFrame:
    """Label each cluster from its means, with ``(n=<items>)``."""
    s30, days = F.col("mean_Sales_Last_30d"), F.col("mean_Days_Since_Last_Sale")
    category = (F.when((s30 > K.HIGH_MIN_SALES30) & (days < K.HIGH_MAX_DAYS), F.lit(K.CLUSTER_HIGH))
                .when((s30 < K.STALE_MAX_SALES30) & (days > K.STALE_MIN_DAYS), F.lit(K.CLUSTER_STALE))
                .when((F.col("mean_Has_Image") < K.POOR_META_SHARE) | (F.col("mean_Has_ISBN") < K.POOR_META_SHARE),
                      F.lit(K.CLUSTER_POOR))
                .otherwise(F.lit(K.CLUSTER_AVERAGE)))
    return stats.withColumn("Cluster_Description",
                            F.concat(category, F.lit(" (n="), F.col("items").cast(T.StringType()), F.lit(")")))


def cluster_items(features: DataFrame, k: int, seed: int = K.KMEANS_SEED,
                  init_mode: str = "farthest", pinned: bool = False, carry=()) -> DataFrame:
    """``(item_id, SKU, Cluster, Cluster_Description, *carry)`` for every item
    row (pass ``pinned=True`` for a table that is written or pinned already).
    The item plan runs once, into a written table that all passes scan."""
    if not pinned:
        features = written(features, "features") if init_mode == "farthest" else pin_features(features)
    labels = kmeans_labels(features, k, seed, init_mode=init_mode, carry=carry)
    desc = describe_clusters(cluster_stats(labels)).select("Cluster", "Cluster_Description")
    # one row per cluster (k rows): a proven bound for the broadcast
    return labels.join(F.broadcast(desc), "Cluster").select(
        ITEM_ID, "SKU", "Cluster", "Cluster_Description", *[c for c in carry if c not in (ITEM_ID, "SKU")])


def price_histogram(features: DataFrame, labels: DataFrame | None = None,
                    bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """F-A10: equal-width price bins per cluster over that cluster's own range.

    Every cluster has all its bins, empty ones with 0 items.  Missing prices
    count as 0; a constant cluster uses ``[x - 0.5, x + 0.5]``.
    """
    j = _labelled(features, labels).select("Cluster", F.coalesce("Price", F.lit(0.0)).alias("Price"))
    rng = j.groupBy("Cluster").agg(F.min("Price").alias("lo"), F.max("Price").alias("hi"))
    rng = rng.select("Cluster",
                     F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                     F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    b = F.least(F.floor((F.col("Price") - F.col("lo")) / width), F.lit(bins - 1)).cast(T.IntegerType())
    counted = (j.join(F.broadcast(rng), "Cluster")  # one row per cluster
               .groupBy("Cluster", b.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("items")))
    every = rng.select("Cluster", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    counted = (every.join(counted.select("Cluster", "bin", "items"), ["Cluster", "bin"], "left")
               .withColumn("items", F.coalesce("items", F.lit(0).cast(T.LongType()))))
    return counted.select("Cluster", "bin",
                          (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
                          (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_end"),
                          "items")
