"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the adapters in
``sources/fixtures.py``) so its work grows with the data.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from shelflens.operators import cleaning as CLN
from shelflens.operators import columns as COL
from shelflens.operators import profile as PR
from shelflens.operators import sales_metrics as SM
from shelflens.operators.dbscan import dbscan
from shelflens.operators.describe import describe
from shelflens.operators import kmeans as KM
from shelflens.operators.features import FEATURES, cluster_features, standardize
from shelflens.operators.tsne import tsne
from shelflens.plans import analysis as A
from shelflens.plans import clustering as CLU
from shelflens.plans import performance as PF
from shelflens.plans import reports as R
from shelflens.plans.inventory_report import inventory_report, item_table, prepare_sales
from shelflens.session import scratch_dir, written
from shelflens.sources import files as FS
from shelflens.sources import fixtures as fx
from shelflens.sources import marketplace as MP

Query = Callable[[SparkSession, str], DataFrame]


def q_inventory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory_report(fx.sales(spark, sf_dir), fx.listings(spark, sf_dir), fx.AS_OF)


def _report(spark, sf_dir):
    return q_inventory_report(spark, sf_dir)


def _sales(spark, sf_dir):
    return prepare_sales(fx.sales(spark, sf_dir))


def _items(spark, sf_dir):
    return item_table(fx.sales(spark, sf_dir), fx.listings(spark, sf_dir), fx.AS_OF)


def _pick(*cols):
    """A query that projects report columns (joins/flags seen one at a time)."""
    def run(spark, sf_dir):
        return _report(spark, sf_dir).select(*[F.col(f"`{x}`") for x in cols])
    return run


def _on_report(fn):
    def run(spark, sf_dir):
        return fn(_report(spark, sf_dir))
    return run


# -- B1 / B9 -------------------------------------------------------------------
def q_normalize_quantity(spark, sf_dir):
    raw = fx.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("SKU"),
        F.col("l_shipdate").alias("Date"), F.col("l_quantity").alias("Quantity"))
    return prepare_sales(raw).select("SKU", "Date", "quantity")


def q_report_projection(spark, sf_dir):
    """Sales without a Price column: the revenue columns are left out."""
    sales = fx.sales(spark, sf_dir).drop("Price")
    return inventory_report(sales, fx.listings(spark, sf_dir), fx.AS_OF)


# -- F-A1..F-A4, G1 -----------------------------------------------------------------
def q_last_sale(spark, sf_dir):
    return SM.last_sale(_sales(spark, sf_dir))


def q_days_since_last_sale(spark, sf_dir):
    return SM.last_sale(_sales(spark, sf_dir), fx.AS_OF)


def q_sales_last_30d(spark, sf_dir):
    return SM.window_units(_sales(spark, sf_dir), fx.AS_OF, 30)


def q_sales_last_90d(spark, sf_dir):
    return SM.window_units(_sales(spark, sf_dir), fx.AS_OF, 90)


def q_revenue_windows(spark, sf_dir):
    return SM.revenue_windows(_sales(spark, sf_dir), fx.AS_OF)


def _li(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem")


def _part(spark, sf_dir):
    return fx.table(spark, sf_dir, "part")


def _lineitem_op(adapter, op):
    def run(spark, sf_dir):
        return op(adapter(_li(spark, sf_dir)))
    return run


# -- B3-B8, B10 ------------------------------------------------------------------
def q_map_columns(spark, sf_dir):
    return COL.map_vendor_columns(fx.vendor_listing(_part(spark, sf_dir)))


def q_resolve_title(spark, sf_dir):
    raw = _part(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("SKU"),
        F.concat_ws(" ", "p_type", "p_name").alias("product-description"))
    return COL.resolve_title(raw)


def q_ensure_columns(spark, sf_dir):
    raw = _part(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sku"),
        F.concat(F.lit("B"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("Asin"))
    return COL.ensure_columns(raw)


def q_has_image(spark, sf_dir):
    return COL.resolve_has_image(fx.vendor_listing(_part(spark, sf_dir)).select("seller-sku", "has_image"))


def q_resolve_isbn(spark, sf_dir):
    raw = fx.vendor_listing(_part(spark, sf_dir)).select("seller-sku", "external_product_id", "product-id")
    return COL.resolve_isbn(raw)


def _daily(spark, sf_dir):
    return FS.daily_sales_projection(fx.daily_report_text(_li(spark, sf_dir)), fx.AS_OF)


def q_daily_sales_projection(spark, sf_dir):
    return _daily(spark, sf_dir).select("Date", "OrderedProductSales", "Sales", "quantity")


def q_synthetic_sku(spark, sf_dir):
    """B8 over the report as several CSV files, best days first; numbers follow the files."""
    path = scratch_dir(spark, "synthetic-sku")
    report = fx.daily_report_text(_li(spark, sf_dir))
    units = F.col("`Units Ordered`").cast("long")
    FS.write_report(report.repartitionByRange(6, units.desc(), "Date").sortWithinPartitions(units.desc(), "Date"), path, fmt="csv")
    return FS.read_sales_report(spark, path, fx.AS_OF).select("Date", "SKU")


# -- C ----------------------------------------------------------------------------
def q_fill_defaults(spark, sf_dir):
    return CLN.fill_defaults(fx.nullable_listing(_part(spark, sf_dir)))


def q_clean_sales(spark, sf_dir):
    return CLN.clean_sales(fx.daily_report_text(_li(spark, sf_dir)))


def q_clean_inventory(spark, sf_dir):
    return CLN.clean_inventory(fx.vendor_listing(_part(spark, sf_dir)))


def _performance_file(spark, sf_dir):
    """The vendor's performance export as a CSV file read back as text."""
    path = scratch_dir(spark, "vendor-performance")
    FS.write_report(fx.vendor_performance(fx.table(spark, sf_dir, "events")), path, fmt="csv")
    return FS.read_text_csv(spark, path)


def q_clean_performance(spark, sf_dir):
    return CLN.clean_performance_text(_performance_file(spark, sf_dir))


def q_clean_then_summarise(spark, sf_dir):
    return PF.performance_summary(CLN.clean_performance_text(_performance_file(spark, sf_dir)), digits=6).select(
        "statistic", "on_time_delivery_rate", "order_defect_rate", "late_shipment_rate")


def q_report_round_trip(spark, sf_dir):
    """The report written as CSV; the first readable candidate is read."""
    path = scratch_dir(spark, "report-csv")
    report = _report(spark, sf_dir).select("SKU", "Title", "Days Since Last Sale", "Sales Last 90d", "Revenue Last 90d")
    FS.write_report(report, path, fmt="csv")
    return FS.first_readable(spark, [path + "-absent", path], lambda p: FS.read_report(spark, p, schema=report.schema))


def q_title_length(spark, sf_dir):
    return fx.listings(spark, sf_dir).select("SKU", "Title", F.char_length("Title").alias("Title_Length"))


# -- A: files written from the tables, then read back -------------------------------
def q_read_sales_report(spark, sf_dir):
    path = scratch_dir(spark, "sales-report")
    FS.write_report(fx.daily_report_text(_li(spark, sf_dir)).orderBy("Date"), path, fmt="csv")
    return FS.read_sales_report(spark, path, fx.AS_OF)


def q_read_inventory_tsv(spark, sf_dir):
    path = scratch_dir(spark, "listing-tsv")
    (fx.vendor_listing(_part(spark, sf_dir)).write.option("sep", "\t").option("header", True)
     .csv(path))
    return FS.read_listing_tsv(spark, path).select(
        "SKU", "ASIN", "Title", "Price", "quantity", "Has_Image", "ISBN")


def q_read_performance(spark, sf_dir):
    path = scratch_dir(spark, "performance-csv")
    FS.write_report(fx.performance(spark, sf_dir), path, fmt="csv")
    return FS.read_performance(spark, path)


def q_ragged_csv(spark, sf_dir):
    path = scratch_dir(spark, "ragged-csv")
    # each file starts with a header; one data line has the header's text
    lines = fx.ragged_lines(_li(spark, sf_dir)).unionAll(spark.createDataFrame([("Column1,Column2",)], "value string"))
    (lines.withColumnRenamed("value", "Column1,Column2").write.option("header", True).option("sep", "\x01").option("quote", "").csv(path))
    return FS.read_ragged_csv(spark, path, ["Column1", "Column2"])


def q_sales_history(spark, sf_dir):
    return MP.sales_history(_sales(spark, sf_dir), fx.AS_OF)


def q_inventory_summary(spark, sf_dir):
    return MP.inventory_summary(fx.listing_snapshot(_part(spark, sf_dir)))


def q_catalog_lookup(spark, sf_dir):
    sold = SM.window_units(_sales(spark, sf_dir), fx.AS_OF, 30).select("SKU")
    return MP.catalog_lookup(fx.catalog(_part(spark, sf_dir)), sold)


def q_enrich_catalog(spark, sf_dir):
    part = _part(spark, sf_dir)
    return MP.enrich_with_catalog(fx.listing_snapshot(part), fx.catalog(part))


# -- J, F-A9 ------------------------------------------------------------------------
def q_select_metrics(spark, sf_dir):
    perf = fx.performance(spark, sf_dir)
    return perf.select(PF.time_column(perf), *PF.select_metrics(perf))


def q_performance_summary(spark, sf_dir):
    return PF.performance_summary(fx.performance(spark, sf_dir), digits=6)


def q_performance_trend(spark, sf_dir):
    return PF.performance_trend(fx.performance(spark, sf_dir))


def q_describe_metrics(spark, sf_dir):
    return describe(_sales(spark, sf_dir), ["quantity", "Price"], digits=6)


# -- D ------------------------------------------------------------------------------
def _vendor_tables(spark, sf_dir):
    li, part = _li(spark, sf_dir), _part(spark, sf_dir)
    return [("sales", "sales", fx.daily_report_text(li), "Date"),
            ("inventory", "inventory", fx.vendor_listing(part), "seller-sku"),
            ("performance", "performance", fx.vendor_performance(fx.table(spark, sf_dir, "events")), "event-id")]


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _profiles(spark, sf_dir, **asked):
    return _union([PR.column_profile(df, t, fam, **asked) for t, fam, df, _ in _vendor_tables(spark, sf_dir)])


def q_profile_counts(spark, sf_dir):
    out = _union([PR.table_counts(df, t) for t, _, df, _ in _vendor_tables(spark, sf_dir)])
    return out.withColumn("issues", F.array_join("issues", "; "))


def q_profile_missing(spark, sf_dir):
    return _profiles(spark, sf_dir, types=False, issues=False).select("table", "column", "missing_count", "missing_pct")


def q_profile_types(spark, sf_dir):
    return _profiles(spark, sf_dir, issues=False).select("table", "ordinal", "column", "data_type", "row_count")


def q_profile_samples(spark, sf_dir):
    return _union([PR.column_samples(df, t, key) for t, _, df, key in _vendor_tables(spark, sf_dir)])


def q_profile_issues(spark, sf_dir):
    return PR.column_issues(_profiles(spark, sf_dir, types=False))


def q_profile_report(spark, sf_dir):
    tabs = _vendor_tables(spark, sf_dir)
    return PR.profile_report([PR.column_profile(df, t, fam) for t, fam, df, _ in tabs],
                             [PR.column_samples(df, t, key) for t, _, df, key in tabs])


def q_profile_files(spark, sf_dir):
    """D6, D7 over the vendors' raw files, written from the tables in the order of their keys."""
    root = scratch_dir(spark, "raw-files")
    names = {"sales": A.RAW_SALES[0], "inventory": A.RAW_INVENTORY[0], "performance": A.RAW_PERFORMANCE[0]}
    for table, _, df, key in _vendor_tables(spark, sf_dir):
        (df.orderBy(F.col(f"`{key}`")).write.option("header", True)
         .option("sep", "\t" if names[table].endswith(".txt") else ",").csv(f"{root}/{names[table]}"))
    return A.profile_all_files(spark, root)


# -- I, F-A5, F-A8, F-A10, E5 ----------------------------------------------------------
def _features(spark, sf_dir):
    return cluster_features(_items(spark, sf_dir))


def _clusters(spark, sf_dir):
    k = CLU.choose_k(fx.listings(spark, sf_dir))
    return KM.cluster_items(_features(spark, sf_dir), k)


def _labelled(spark, sf_dir):
    """K-means labels carrying the raw features (no join back needed)."""
    k = CLU.choose_k(fx.listings(spark, sf_dir))
    return KM.kmeans_labels(written(_features(spark, sf_dir), "features"), k)


def q_cluster_features(spark, sf_dir):
    return _features(spark, sf_dir).drop("item_id")


def q_standardize(spark, sf_dir):
    return standardize(_features(spark, sf_dir), FEATURES, digits=6).drop("item_id")


def q_kmeans(spark, sf_dir):
    return _clusters(spark, sf_dir).select("SKU", "Cluster")


def q_cluster_stats(spark, sf_dir):
    return _rounded(KM.cluster_stats(_labelled(spark, sf_dir)))


def q_describe_clusters(spark, sf_dir):
    return KM.describe_clusters(KM.cluster_stats(_labelled(spark, sf_dir))).select("Cluster", "Cluster_Description", "items")


def q_cluster_nunique(spark, sf_dir):
    """Labels that the fit really gave, with their items."""
    sizes = _labelled(spark, sf_dir).groupBy("Cluster").agg(F.count(F.lit(1)).alias("items"))
    return sizes.agg(F.count(F.lit(1)).alias("n_clusters"), F.min("items").alias("smallest"), F.max("items").alias("largest"))


def q_price_histogram(spark, sf_dir):
    return KM.price_histogram(_labelled(spark, sf_dir))


def q_join_clusters(spark, sf_dir):
    return CLU.clustered_report(fx.sales(spark, sf_dir), fx.listings(spark, sf_dir), fx.AS_OF)


def q_pca(spark, sf_dir):
    return _rounded(CLU.embedding_pca(fx.table(spark, sf_dir, "embeddings")), 4)


def q_dbscan(spark, sf_dir):
    """Parts by retail price and size.  The z-scores are rounded here (not in the
    library), so that the last bits of mean and deviation, which differ between
    engines, decide nothing in the comparison."""
    part = _part(spark, sf_dir).select("p_partkey", F.col("p_retailprice").cast("double").alias("price"), F.col("p_size").cast("double").alias("size"))
    return dbscan(standardize(part, ["price", "size"], digits=6), "p_partkey", ["price", "size"], eps=0.08, min_samples=5)


def q_pca_dbscan(spark, sf_dir):
    """All coordinates of the embeddings, projected to two components first."""
    return CLU.pca_dbscan(fx.table(spark, sf_dir, "embeddings"))


def q_tsne(spark, sf_dir):
    """A picture of all embeddings (iterative floats: held against exact t-SNE in the tests)."""
    return tsne(fx.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


# -- labels computed from the tables: the cluster aggregates without a fit --------------
def _given_labels(spark, sf_dir):
    rows = _features(spark, sf_dir)
    return rows.withColumn("Cluster", (F.col("Sales_Last_90d") > 0).cast("int") + (F.col("Price") > 10).cast("int"))


def q_cluster_stats_given(spark, sf_dir):
    return _rounded(KM.cluster_stats(_given_labels(spark, sf_dir)))


def q_describe_clusters_given(spark, sf_dir):
    return KM.describe_clusters(KM.cluster_stats(_given_labels(spark, sf_dir))).select("Cluster", "Cluster_Description")


def q_price_histogram_given(spark, sf_dir):
    return KM.price_histogram(_given_labels(spark, sf_dir))


def _rounded(df, digits=6):
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema.fields])


def queries() -> dict[str, Query]:
    return {
        # clustering (I) and cluster aggregates (F-A5, F-A8, F-A10), E5
        "q_cluster_features": q_cluster_features,  # I1
        "q_standardize": q_standardize,  # I2
        "q_kmeans": q_kmeans,  # I3, I4
        "q_cluster_stats": q_cluster_stats,  # F-A5
        "q_describe_clusters": q_describe_clusters,  # I5
        "q_cluster_nunique": q_cluster_nunique,  # F-A8
        "q_price_histogram": q_price_histogram,  # F-A10
        "q_join_clusters": q_join_clusters,  # E5
        "q_pca": q_pca,  # I6
        "q_dbscan": q_dbscan,  # I7
        "q_pca_dbscan": q_pca_dbscan,  # I6, I7
        "q_tsne": q_tsne,  # section 2.13
        "q_cluster_stats_given": q_cluster_stats_given,  # F-A5
        "q_describe_clusters_given": q_describe_clusters_given,  # I5
        "q_price_histogram_given": q_price_histogram_given,  # F-A10
        # sources (A)
        "q_read_sales_report": q_read_sales_report,  # A1, A2, B8, B10
        "q_read_inventory_tsv": q_read_inventory_tsv,  # A3, B3-B7, C2
        "q_read_performance": q_read_performance,  # A4
        "q_ragged_csv": q_ragged_csv,  # A9
        "q_sales_history": q_sales_history,  # A6
        "q_inventory_summary": q_inventory_summary,  # A7
        "q_catalog_lookup": q_catalog_lookup,  # A8
        "q_enrich_catalog": q_enrich_catalog,  # E6
        # column resolution (B)
        "q_map_columns": q_map_columns,  # B3
        "q_resolve_title": q_resolve_title,  # B4
        "q_ensure_columns": q_ensure_columns,  # B5
        "q_has_image": q_has_image,  # B6
        "q_resolve_isbn": q_resolve_isbn,  # B7
        "q_synthetic_sku": q_synthetic_sku,  # B8
        "q_daily_sales_projection": q_daily_sales_projection,  # B10
        # cleaning (C)
        "q_clean_currency": _lineitem_op(fx.money_text, CLN.clean_money_columns),  # C1
        "q_clean_quantity": _lineitem_op(fx.quantity_text, CLN.clean_quantity_column),  # C2
        "q_fill_defaults": q_fill_defaults,  # C3
        "q_parse_date": _lineitem_op(fx.date_text, CLN.parse_date_column),  # C4
        "q_parse_gmt_timestamp": _lineitem_op(fx.gmt_text, CLN.clean_time_columns),  # C5
        "q_unwrap_excel_text": _lineitem_op(fx.excel_text, CLN.unwrap_excel_columns),  # C6
        "q_clean_percentage": _lineitem_op(fx.percent_text, CLN.clean_percent_columns),  # C7
        "q_clean_sales": q_clean_sales,  # C8
        "q_clean_inventory": q_clean_inventory,  # C9
        "q_clean_performance": q_clean_performance,  # C10
        "q_clean_then_summarise": q_clean_then_summarise,  # C10, J2
        "q_report_round_trip": q_report_round_trip,  # A2, A10, A11
        "q_title_length": q_title_length,  # C11
        # profiling (D)
        "q_profile_counts": q_profile_counts,  # D1
        "q_profile_missing": q_profile_missing,  # D2
        "q_profile_types": q_profile_types,  # D3
        "q_profile_samples": q_profile_samples,  # D4
        "q_profile_issues": q_profile_issues,  # D5
        "q_profile_report": q_profile_report,  # D6
        "q_profile_files": q_profile_files,  # D6, D7, file order
        # performance (J) and describe (F-A9)
        "q_select_metrics": q_select_metrics,  # J1
        "q_performance_summary": q_performance_summary,  # J2, F-A9
        "q_performance_trend": q_performance_trend,  # J3
        "q_describe_metrics": q_describe_metrics,  # F-A9
        "q_inventory_report": q_inventory_report,  # H1
        # projections / joins (B, E)
        "q_normalize_quantity": q_normalize_quantity,  # B1
        "q_report_projection": q_report_projection,  # B9
        "q_join_recency": _pick("SKU", "Days Since Last Sale"),  # E1
        "q_join_sales_30d": _pick("SKU", "Sales Last 30d"),  # E2
        "q_join_sales_90d": _pick("SKU", "Sales Last 90d"),  # E3
        "q_join_revenue": _pick("SKU", "Revenue Last 30d", "Revenue Last 90d"),  # E4
        # aggregates (F)
        "q_last_sale": q_last_sale,  # F-A1
        "q_sales_last_30d": q_sales_last_30d,  # F-A2
        "q_sales_last_90d": q_sales_last_90d,  # F-A3
        "q_revenue_windows": q_revenue_windows,  # F-A4
        "q_flag_counts": _on_report(R.flag_counts),  # F-A6
        "q_sales_distribution": _on_report(R.sales_distribution),  # F-A7
        # derived columns (G)
        "q_days_since_last_sale": q_days_since_last_sale,  # G1
        "q_is_stale": _pick("SKU", "Is_Stale"),  # G2
        "q_bad_metadata": _pick("SKU", "Bad_Metadata"),  # G3
        "q_flag": _pick("SKU", "Flag"),  # G4
        "q_notes": _pick("SKU", "Notes"),  # G5
        "q_metadata_quality_score": _pick("SKU", "Metadata_Quality_Score"),  # G6
        "q_stale_items_strict": _on_report(R.stale_items_strict),  # G7
        "q_bad_metadata_strict": _on_report(R.bad_metadata_strict),  # G8
        "q_good_sellers_strict": _on_report(R.good_sellers_strict),  # G9
        "q_heuristic_score": _on_report(lambda r: R.with_heuristic_score(r).select("SKU", "Heuristic_Score")),  # G10
        # reports (H)
        "q_report_stale": _on_report(R.report_stale),  # H2
        "q_report_bad_metadata": _on_report(R.report_bad_metadata),  # H3
        "q_report_good_sellers": _on_report(R.report_good_sellers),  # H4
        "q_report_sales_velocity": _on_report(R.report_sales_velocity),  # H5
        "q_report_metadata_quality": _on_report(R.report_metadata_quality),  # H6
        "q_report_heuristic": _on_report(R.report_heuristic),  # H7
        "q_report_revenue": _on_report(R.report_revenue),  # H8
        "q_stale_scatter": _on_report(R.stale_scatter),  # H9
    }
