"""Reusable DataFrame operators.

columns        exact-name column resolution and listing standardisation
sales_metrics  one-pass per-SKU aggregates and the listings join
cleaning       table-level cleaners picked by column name and type
profile        one-pass profiling, top-k samples, issue rows
ordering       distributed row index and exact quantiles
describe       pandas-style describe (exact or approximate quartiles)
joins          size-checked broadcast and semi join
features       cluster features and standardisation
kmeans         MLlib K-means, relabelling, cluster statistics
pca            MLlib PCA with centring and sign fixing
dbscan         grid + box-refinement DBSCAN with label propagation
"""
