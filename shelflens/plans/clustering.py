"""Clustering plans: items -> features -> K-means / descriptions (I1-I5, E5),
embeddings -> PCA (I6) and DBSCAN (I7)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.operators import kmeans as KM
from shelflens.operators.dbscan import dbscan
from shelflens.operators.features import cluster_features, standardize
from shelflens.operators.pca import pca
from shelflens.plans.inventory_report import RENAMES, item_table, to_report


def item_features(sales: DataFrame, inventory: DataFrame, as_of: datetime) -> DataFrame:
    return cluster_features(item_table(sales, inventory, as_of))


def choose_k(inventory: DataFrame, rule: str = "file") -> int | None:
    """I4: needs the item count (one ``count`` action)."""
    return KM.n_clusters_for(inventory.count(), rule)


def cluster_inventory(sales: DataFrame, inventory: DataFrame, as_of: datetime,
                      n_clusters: int | None = None, rule: str = "file") -> DataFrame:
    """``(item_id, SKU, Cluster, Cluster_Description)``; None below 5 items."""
    k = n_clusters or choose_k(inventory, rule)
    if k is None:
        return None
    return KM.cluster_items(item_features(sales, inventory, as_of), k)


def clustered_report(sales: DataFrame, inventory: DataFrame, as_of: datetime,
                     n_clusters: int | None = None, rule: str = "file") -> DataFrame:
    """E5: the report with each row's cluster id and description.

    The report columns ride through K-means next to the features (one
    projection of the same item rows), so no item-level join is needed: only
    the k-row description table is broadcast.  A SKU listed many times keeps
    one row per listing (no SKU x SKU fan-out).
    """
    items = item_table(sales, inventory, as_of)
    k = n_clusters or choose_k(inventory, rule)
    if k is None:
        return to_report(items)
    source = {v: k_ for k_, v in RENAMES.items()}          # report name -> item column
    names = [n for n in K.REPORT_COLUMNS if n != "SKU" and source.get(n, n) in items.columns]
    carried = [f"__r{i}" for i in range(len(names))]
    rows = cluster_features(items, extra=[F.col(f"`{source.get(n, n)}`").alias(a)
                                          for n, a in zip(names, carried)])
    out = KM.cluster_items(rows, k, carry=carried)
    return out.select("SKU", *[F.col(a).alias(n) for n, a in zip(names, carried)],
                      "Cluster", "Cluster_Description")


def feature_dbscan(rows: DataFrame, id_col: str, cols, eps: float = K.DBSCAN_EPS,
                   min_samples: int = K.DBSCAN_MIN_SAMPLES) -> DataFrame:
    """DBSCAN on up to three columns, standardised first."""
    z = standardize(rows.select(id_col, *cols), list(cols))
    return dbscan(z, id_col, list(cols), eps, min_samples)


def embedding_pca(embeddings: DataFrame, k: int = 2) -> DataFrame:
    return pca(embeddings, "embedding", k, keep=("vec_id", "label"))


def pca_dbscan(embeddings: DataFrame, k: int = 2, eps: float = K.DBSCAN_EPS,
               min_samples: int = K.DBSCAN_MIN_SAMPLES) -> DataFrame:
    """DBSCAN on the first ``k`` principal components (high-dimensional vectors
    are projected first so the grid has few neighbour cells)."""
    proj = embedding_pca(embeddings, k)
    return dbscan(proj, "vec_id", [f"pc{j + 1}" for j in range(k)], eps, min_samples)
