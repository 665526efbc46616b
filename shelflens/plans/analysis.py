"""Entry points that mirror the reference's workflows, built from
the operators.  Paths may be any Hadoop-compatible URI; outputs default to
parquet, CSV (header, no index) on request.

* ``analyze`` / ``run_analysis``                 -- Entry 1 (inventory analysis)
* ``load_all_data`` / ``run_full_analysis``      -- Entry 2 (file-based analysis)
* ``profile_all_files`` / ``clean_data``         -- Entry 3 (profile and clean)
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens import constants as K
from shelflens.operators import cleaning as CLN
from shelflens.operators import profile as PR
from shelflens.operators import text_types as TT
from shelflens.plans import performance as PF
from shelflens.plans import reports as R
from shelflens.plans.clustering import cluster_inventory, clustered_report
from shelflens.plans.inventory_report import inventory_report
from shelflens.session import pin
from shelflens.sources import files as FS

# fixed values: input file names probed in order (first readable wins)
SALES_CLEANED = "cleaned/cleaned_SalesandTrafficByDate.csv"
SALES_ALTERNATES = ["DetailPageSalesandTrafficByDate.csv", "SalesandOrdersbyMonth.csv"]
INVENTORY_FILES = ["cleaned/cleaned_Inventory+Report+03-22-2025.txt",
                   "cleaned/cleaned_Open+Listings+Report+03-22-2025.txt",
                   "cleaned/cleaned_All+Listings+Report+03-22-2025.txt"]
PERFORMANCE_FILES = ["cleaned/cleaned_SellerPerformance.csv",
                     "cleaned/cleaned_UnitOnTimeDelivery_1282029020169.csv",
                     "cleaned/cleaned_OrderDefects_1282032020169.csv"]
RAW_SALES = ["SalesandTrafficByDate.csv", "DetailPageSalesandTrafficByDate.csv", "SalesandOrdersbyMonth.csv"]
RAW_INVENTORY = ["Inventory+Report+03-22-2025.txt", "Open+Listings+Report+03-22-2025.txt",
                 "All+Listings+Report+03-22-2025.txt"]
RAW_PERFORMANCE = ["SellerPerformance.csv", "UnitOnTimeDelivery_1282029020169.csv",
                   "OrderDefects_1282032020169.csv"]


log = logging.getLogger(__name__)


def _join(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name


# -- Entry 1 ------------------------------------------------------------------
def analyze(sales: DataFrame, inventory: DataFrame, as_of: datetime) -> DataFrame:
    """The per-item report (H1)."""
    return inventory_report(sales, inventory, as_of)


def run_analysis(sales: DataFrame, inventory: DataFrame, as_of: datetime) -> DataFrame:
    """Report plus cluster id/description (demo k rule; skipped below 5 items)."""
    return clustered_report(sales, inventory, as_of, rule="demo")


def base_reports(report: DataFrame) -> dict[str, DataFrame]:
    """H1-H6 and H8 as written by the inventory workflow."""
    out = {
        "inventory_analysis": report,
        "stale_items": R.report_stale(report),
        "bad_metadata": R.report_bad_metadata(report),
        "good_sellers": R.report_good_sellers(report),
        "sales_velocity": R.report_sales_velocity(report),
        "metadata_quality": R.report_metadata_quality(report),
    }
    if "Revenue Last 90d" in report.columns:
        out["revenue_analysis"] = R.report_revenue(report)
    return out


def write_reports(reports: dict[str, DataFrame], output_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """A10: one folder per report under ``output_dir/analysis_<timestamp>``."""
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S")
    root = _join(output_dir, f"analysis_{stamp}")
    return {name: FS.write_report(df, _join(root, name), fmt) for name, df in reports.items()}


def run_inventory_analysis(sales: DataFrame, inventory: DataFrame, as_of: datetime,
                           output_dir: str | None = None, fmt: str = "parquet") -> dict:
    report = analyze(sales, inventory, as_of)
    if output_dir:
        report = pin(report)      # several reports are written from it
    reports = base_reports(report)
    written = write_reports(reports, output_dir, fmt) if output_dir else {}
    return {"report": report, "reports": reports, "written": written,
            "flag_counts": R.flag_counts(report)}


# -- Entry 2 ------------------------------------------------------------------
def load_sales(spark: SparkSession, data_dir: str, as_of: datetime | None = None) -> DataFrame:
    path = _join(data_dir, SALES_CLEANED)
    if FS.path_exists(spark, path):
        return FS.read_sales_report(spark, path, as_of)

    def alt(p):
        # Alternates get the same normalisation as the main report (the
        # reference used them raw): daily-report columns -> typed sales lines.
        raw = spark.read.option("header", True).csv(p)
        if "Ordered Product Sales" in raw.columns or "Units Ordered" in raw.columns:
            return FS.sales_lines(raw, as_of)
        return CLN.clean_sales(raw)
    df = FS.first_readable(spark, [_join(data_dir, n) for n in SALES_ALTERNATES], alt)
    if df is None:
        log.warning("No sales data files found under %s; analysis will be limited", data_dir)
        return FS.empty_frame(spark, FS.EMPTY_SALES)
    return df


def load_inventory(spark: SparkSession, data_dir: str) -> DataFrame:
    df = FS.first_readable(spark, [_join(data_dir, n) for n in INVENTORY_FILES],
                           lambda p: FS.read_listing_tsv(spark, p))
    if df is None:
        log.warning("No inventory data files found under %s; analysis will be limited", data_dir)
        return FS.empty_frame(spark, FS.EMPTY_LISTINGS)
    return df


def load_performance(spark: SparkSession, data_dir: str) -> DataFrame | None:
    df = FS.first_readable(spark, [_join(data_dir, n) for n in PERFORMANCE_FILES],
                           lambda p: FS.read_performance(spark, p))
    if df is None:
        log.warning("No performance data files found under %s", data_dir)
    return df


def load_all_data(spark: SparkSession, data_dir: str, as_of: datetime | None = None) -> dict[str, DataFrame]:
    return {"sales": load_sales(spark, data_dir, as_of),
            "inventory": load_inventory(spark, data_dir),
            "performance": load_performance(spark, data_dir)}


def file_reports(report: DataFrame) -> dict[str, DataFrame]:
    """The file workflow's reports: strict rules (G7-G10), H5, H7, H8."""
    out = {
        "inventory_analysis": report,
        "stale_items": R.stale_items_strict(report),
        "bad_metadata": R.bad_metadata_strict(report),
        "good_sellers": R.good_sellers_strict(report),
        "sales_velocity": R.report_sales_velocity(report),
        "metadata_quality": R.report_heuristic(report),
    }
    if "Revenue Last 90d" in report.columns:
        out["revenue_analysis"] = R.report_revenue(report)
    return out


def run_full_analysis(spark: SparkSession, data_dir: str, as_of: datetime,
                      output_dir: str | None = None, fmt: str = "parquet") -> dict:
    data = load_all_data(spark, data_dir, as_of)
    sales, inventory, perf = data["sales"], data["inventory"], data["performance"]
    results: dict = {}
    report = analyze(sales, inventory, as_of)
    if output_dir:
        report = pin(report)      # several reports are written from it
    results["basic_analysis"] = report
    reports = file_reports(report)
    clusters = cluster_inventory(sales, inventory, as_of, rule="file")
    if clusters is not None:
        clusters = clusters.drop("item_id")
        results["clustering"] = clusters
        reports["inventory_clusters"] = clusters
    if perf is not None and len(perf.columns) > 0:
        results["performance"] = PF.performance_summary(perf)
        results["performance_trend"] = PF.performance_trend(perf)
        reports["performance_analysis"] = results["performance"]
    results["reports"] = reports
    if output_dir:
        results["written"] = write_reports(reports, output_dir, fmt)
    return results


# -- Entry 3 ------------------------------------------------------------------
def _separator(name: str) -> str:
    return "\t" if name.endswith(".txt") else ","


def profile_all_files(spark: SparkSession, data_dir: str) -> DataFrame | None:
    """D6 over every raw file present (sales, inventory, performance families): one
    aggregate a file for counts, types and issues, one top-k for the samples."""
    profiles, samples = [], []
    for family, names in (("sales", RAW_SALES), ("inventory", RAW_INVENTORY), ("performance", RAW_PERFORMANCE)):
        for name in names:
            path = _join(data_dir, name)
            if not FS.path_exists(spark, path):
                continue
            raw = FS.read_text_csv(spark, path, _separator(name))
            profile = PR.column_profile(raw, name, family, untyped=True)
            profiles.append(profile)
            samples.append(PR.file_samples(raw, name, profile))
    if not profiles:
        return None
    return PR.profile_report(profiles, samples)


def clean_data(spark: SparkSession, data_dir: str, output_dir: str | None = None) -> dict[str, str]:
    """C8-C10 for every raw file present; writes ``cleaned_<name>`` folders."""
    out_dir = output_dir or _join(data_dir, "cleaned")
    written = {}
    # every cleaner takes the file's text; types take one scan, the write the second
    for cleaner, names in ((lambda raw: CLN.clean_sales(TT.typed(raw)), RAW_SALES),
                           (lambda raw: CLN.clean_inventory(TT.typed(raw)), RAW_INVENTORY),
                           (CLN.clean_performance_text, RAW_PERFORMANCE)):
        for name in names:
            path = _join(data_dir, name)
            if not FS.path_exists(spark, path):
                continue
            df = cleaner(FS.read_text_csv(spark, path, _separator(name)))
            target = _join(out_dir, f"cleaned_{name}")
            w = df.write.mode("overwrite").option("header", True)
            if name.endswith(".txt"):
                w = w.option("sep", "\t")
            w.csv(target)
            written[name] = target
    return written


def flag_summary(report: DataFrame) -> DataFrame:
    """F-A6 + F-A8 style summary: items, flagged, good."""
    return report.agg(F.count(F.lit(1)).alias("items"),
                      F.count_if(F.col("Flag") == F.lit(K.FLAG_WARN)).alias("flagged"),
                      F.count_if(F.col("Flag") == F.lit(K.FLAG_OK)).alias("good"))


def cluster_count(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.countDistinct("Cluster").alias("n_clusters"))


__all__ = ["analyze", "run_analysis", "run_inventory_analysis", "load_all_data", "run_full_analysis",
           "profile_all_files", "clean_data", "flag_summary", "cluster_count"]
