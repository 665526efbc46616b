"""shelflens: Spark-native inventory and sales analytics.

Every public operator takes DataFrame(s) plus options and returns a lazy
DataFrame, so callers can chain them with ``DataFrame.transform`` and let
Catalyst optimise the whole plan.  Actions happen only where an algorithm
is iterative (K-means, PCA fit, DBSCAN components) or where a plan-time
decision genuinely needs a number (cluster count from the item count).

Entry points (see ``shelflens.plans.analysis``)::

    analyze(sales, listings, as_of)              per-item report
    run_analysis(sales, listings, as_of)         report + clusters
    run_inventory_analysis(..., output_dir)      report + derived reports written
    run_full_analysis(spark, data_dir, as_of)    vendor files -> all results
    profile_all_files / clean_data               profiling and cleaning of vendor files
"""

from shelflens.session import ensure_checkpoint_dir, get_session, scale_conf, scratch_dir

__all__ = ["get_session", "scratch_dir", "ensure_checkpoint_dir", "scale_conf",
           "analyze", "run_analysis", "run_inventory_analysis", "run_full_analysis",
           "load_all_data", "profile_all_files", "clean_data"]


def __getattr__(name):
    # Entry points are imported lazily so ``import shelflens`` stays light.
    if name in {"analyze", "run_analysis", "run_inventory_analysis", "run_full_analysis",
                "load_all_data", "profile_all_files", "clean_data"}:
        from shelflens.plans import analysis
        return getattr(analysis, name)
    raise AttributeError(name)
