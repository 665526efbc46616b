import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.operators import kmeans as KM
from shelflens.operators.dbscan import dbscan, neighbour_offsets
from shelflens.operators.features import FEATURES, standardize
from shelflens.operators.pca import pca


def brute_dbscan(xy, eps, min_samples):
    n = len(xy)
    d2 = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    label = np.full(n, -1)
    comp = -np.ones(n, dtype=int)
    for i in range(n):                      # components over core points
        if core[i] and comp[i] < 0:
            stack, members = [i], []
            comp[i] = i
            while stack:
                j = stack.pop()
                members.append(j)
                for k in np.nonzero(nb[j] & core)[0]:
                    if comp[k] < 0:
                        comp[k] = i
                        stack.append(k)
            cid = min(members)
            for m in members:
                label[m] = cid
    for i in range(n):
        if not core[i]:
            adj = [label[k] for k in np.nonzero(nb[i] & core)[0]]
            label[i] = min(adj) if adj else -1
    return label, core


@pytest.mark.parametrize("seed", [0, 1])
def test_dbscan_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    blobs = [rng.normal(c, 0.15, size=(80, 2)) for c in ((0, 0), (2, 2), (2, -1))]
    dense = np.tile([[5.0, 5.0]], (40, 1))                  # one very hot cell
    noise = rng.uniform(-3, 7, size=(60, 2))
    xy = np.round(np.vstack(blobs + [dense, noise]), 6)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")
    got = {r["id"]: (r["cluster"], r["is_core"]) for r in dbscan(df, "id", ["x", "y"], 0.5, 5).collect()}
    label, core = brute_dbscan(xy, 0.5, 5)
    assert [got[i][0] for i in range(len(xy))] == list(label)
    assert [got[i][1] for i in range(len(xy))] == list(core)


def test_neighbour_offsets_cover_eps():
    assert len(neighbour_offsets(2, 0.5)) == 25
    assert (0,) in neighbour_offsets(1, 1.0)


def test_standardize_population(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = standardize(df, ["a", "b"]).collect()
    assert [round(r["a"], 9) for r in rows] == [round(x, 9) for x in (-1.224744871, 0.0, 1.224744871)]
    assert all(r["b"] == 0.0 for r in rows)


def features_df(spark, n=120, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        g = i % 3
        rows.append((i, f"S{i:03d}", float(10 + 20 * g + rng.normal()), float(g * 5 + rng.random()),
                     float(g * 9 + rng.random()), float(30 + 100 * g + rng.normal()), float(g != 1), 1.0))
    return spark.createDataFrame(rows, ["item_id", "SKU"] + FEATURES)


def test_kmeans_invariants(spark):
    feats = features_df(spark)
    a = {r["SKU"]: r["Cluster"] for r in KM.kmeans_labels(feats, 3).collect()}
    b = {r["SKU"]: r["Cluster"] for r in KM.kmeans_labels(feats, 3).collect()}
    assert a == b and set(a.values()) == {0, 1, 2}
    # well separated groups are recovered, relabelled by ascending mean price
    assert all(a[f"S{i:03d}"] == i % 3 for i in range(120))
    desc = KM.describe_clusters(KM.cluster_stats(feats, KM.kmeans_labels(feats, 3))).collect()
    assert all(r["Cluster_Description"].endswith(f"(n={r['items']})") for r in desc)


def test_n_clusters_rule():
    assert KM.n_clusters_for(4) is None
    assert KM.n_clusters_for(5, "demo") == 3 and KM.n_clusters_for(3 + 2, "file") == 2
    assert KM.n_clusters_for(1000) == 3


def test_price_histogram_bins(spark):
    feats = spark.createDataFrame([(1, 0.0), (2, 30.0), (3, 15.0), (4, 7.0)], "item_id long, Price double")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1)], "item_id long, Cluster int")
    h = {(r["Cluster"], r["bin"]): r["items"] for r in KM.price_histogram(feats, labels).collect()}
    assert len(h) == 2 * 30  # empty bins too
    assert {k: n for k, n in h.items() if n} == {(0, 0): 1, (0, 29): 1, (0, 15): 1, (1, 15): 1}


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    got = np.array([[r["pc1"], r["pc2"]] for r in pca(df, "v", 2, keep=("id",)).orderBy("id").collect()])
    xc = x - x.mean(0)
    _, _, vt = np.linalg.svd(xc, full_matrices=False)
    ref = xc @ vt[:2].T
    for j in range(2):
        assert np.allclose(np.abs(got[:, j]), np.abs(ref[:, j]), atol=1e-8)
    assert got[:, 0].var() >= got[:, 1].var()


def test_kmeans_cost_below_random_assignment(spark):
    feats = features_df(spark, n=150, seed=11)
    labels = KM.kmeans_labels(feats, 3)
    z = standardize(feats, FEATURES).join(labels.select("item_id", "SKU", "Cluster"), ["item_id", "SKU"])

    def sse(df, label_col):
        cent = df.groupBy(label_col).agg(*[F.avg(c).alias(f"m_{c}") for c in FEATURES])
        j = df.join(cent, label_col)
        return j.select(sum(((F.col(c) - F.col(f"m_{c}")) ** 2 for c in FEATURES[1:]),
                            (F.col(FEATURES[0]) - F.col(f"m_{FEATURES[0]}")) ** 2).alias("e")).agg(F.sum("e")).first()[0]

    random = z.withColumn("rnd", (F.xxhash64("SKU") % 3 + 3) % 3)
    assert sse(z, "Cluster") <= sse(random, "rnd")


def test_duplicate_skus_do_not_fan_out(spark):
    """A SKU listed many times keeps one clustered row per listing."""
    from datetime import datetime, timedelta
    from shelflens.plans.clustering import clustered_report
    as_of = datetime(2001, 8, 1, 12)
    sales = spark.createDataFrame([("A", as_of - timedelta(days=d), 1.0, 2.0) for d in range(1, 40)]
                                  + [("B", as_of - timedelta(days=200), 1.0, 2.0)],
                                  "SKU string, Date timestamp_ntz, quantity double, Price double")
    inv = spark.createDataFrame([("A", "Listing title", "1", 5.0, True)] * 30
                                + [(f"C{i}", "Other title", None, 1.0, False) for i in range(10)]
                                + [("B", "Old book title", "2", 9.0, True)],
                                "SKU string, Title string, ISBN string, Price double, Has_Image boolean")
    out = clustered_report(sales, inv, as_of, n_clusters=3)
    assert out.count() == 41 and out.where("SKU = 'A'").count() == 30
    assert out.where("Cluster IS NULL").count() == 0


def test_dbscan_boundary_points_reach_point_level(spark):
    """Points within a hair of eps of a hot duplicate cell straddle every box level."""
    rng = np.random.default_rng(4)
    hot = np.tile([[1.0, 1.0]], (30, 1))
    ang = rng.uniform(0, 2 * np.pi, size=40)
    r = 0.5 + rng.choice([-1e-7, 1e-7], size=40)
    ring = np.c_[1.0 + r * np.cos(ang), 1.0 + r * np.sin(ang)]
    far = rng.uniform(3, 6, size=(30, 2))
    xy = np.vstack([hot, ring, far])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")
    got = {r_["id"]: (r_["cluster"], r_["is_core"]) for r_ in dbscan(df, "id", ["x", "y"], 0.5, 5).collect()}
    label, core = brute_dbscan(xy, 0.5, 5)
    assert [got[i][0] for i in range(len(xy))] == list(label)
    assert [got[i][1] for i in range(len(xy))] == list(core)


def test_kmeans_random_init(spark):
    feats = features_df(spark, n=90, seed=8)
    a = {r["item_id"]: r["Cluster"] for r in KM.kmeans_labels(feats, 3, init_mode="random").collect()}
    assert set(a.values()) <= {0, 1, 2} and len(a) == 90


def test_kmeans_independent_of_upstream_plan(spark):
    """Same labels whether the item plan broadcast or sort-merged its join."""
    from shelflens import registry as r
    d = "/root/testdata/sf0.001"
    a = {(x.SKU, x.Cluster) for x in r.q_kmeans(spark, d).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = {(x.SKU, x.Cluster) for x in r.q_kmeans(spark, d).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a == b


def test_pca_dbscan_matches_brute_force(spark):
    from shelflens.plans.clustering import embedding_pca, pca_dbscan
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    proj = sorted((r["vec_id"], r["pc1"], r["pc2"]) for r in embedding_pca(emb).collect())
    xy = np.array([[p1, p2] for _, p1, p2 in proj])
    ids = [i for i, _, _ in proj]
    eps = float(np.std(xy[:, 0]) / 4)
    got = {r["vec_id"]: r["cluster"] for r in pca_dbscan(emb, eps=eps, min_samples=5).collect()}
    label, _ = brute_dbscan(xy, eps, 5)
    mapped = [ids[l] if l >= 0 else -1 for l in label]
    assert [got[i] for i in ids] == mapped


def test_kmeans_follows_lloyd_exactly(spark):
    """Start, steps and stop as a plain numpy loop has them; partitions do not matter."""
    feats = features_df(spark, n=200, seed=21)
    x = feats.orderBy("item_id").toPandas()[FEATURES].to_numpy()
    std = x.std(0)
    z = np.floor((x - x.mean(0)) / np.where(std > 0, std, 1) * KM.RESOLUTION + 0.5)
    rank = lambda d: np.lexsort((*z.T[::-1], d))
    centres = [z[rank((z**2).sum(1))[0]]]
    while len(centres) < 3:
        centres.append(z[rank(-np.min([((z - c) ** 2).sum(1) for c in centres], axis=0))[0]])
    for _ in range(300):
        label = np.argmin([((z - c) ** 2).sum(1) for c in centres], axis=0)
        new = [z[label == j].mean(0) for j in range(3)]
        moved = sum(((a - b) ** 2).sum() for a, b in zip(centres, new)) / KM.RESOLUTION**2
        centres = new
        if moved <= KM.TOLERANCE:
            break
    for parts in (1, 7):
        fit = KM.kmeans_fit(feats.repartition(parts), 3)
        assert np.allclose(fit.centres, centres, rtol=0, atol=1e-3) and fit.moved <= KM.TOLERANCE


def test_kmeans_odd_tables(spark):
    schema = "item_id long, SKU string, " + ", ".join(f"{c} double" for c in FEATURES)
    with pytest.raises(ValueError):
        KM.kmeans_fit(spark.createDataFrame([], schema), 2)
    same = [(i, f"S{i}", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(6)]
    assert {r.Cluster for r in KM.kmeans_labels(spark.createDataFrame(same, schema), 3).collect()} == {0}
    one = KM.kmeans_labels(spark.createDataFrame([*same, (9, "Z", 5.0, 1.0, 1.0, 1.0, 1.0, 1.0)], schema), 2).collect()
    assert {r.SKU: r.Cluster for r in one} == {f"S{i}": 0 for i in range(6)} | {"Z": 1}
