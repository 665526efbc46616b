"""End-to-end plans built from the operators.

inventory_report  per-item report (flagship) and the wide item table
reports           filters / sorts / summaries over the report
performance       seller-performance metric selection, summary, trend
clustering        K-means over items, PCA and DBSCAN over embeddings
analysis          workflow entry points (analyze, full file analysis, profile + clean)
"""
