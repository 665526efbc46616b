"""DBSCAN as Spark joins, aggregates and an iterative label propagation.

Definitions (scikit-learn's): a point is *core* when at least
``min_samples`` points (itself included) lie within distance ``eps``; core
points within ``eps`` of each other share a cluster; a non-core point within
``eps`` of a core point is a *border* point and joins a cluster; the rest is
noise (``-1``).  Cluster ids are made deterministic: the smallest core point
id of the cluster; a border point reachable from several clusters takes the
smallest such id (scikit-learn's choice depends on visit order).

Plan (no all-pairs step anywhere):

1. Grid of side ``eps / sqrt(d)``: any two points of one cell are within
   ``eps``.  A cell holding ``>= min_samples`` points is *dense*: all its
   points are core without looking at a single pair.  Only points of sparse
   cells (fewer than ``min_samples`` points each) probe the neighbouring
   cells, so the probe side is bounded per cell even when one cell holds a
   third of the data.
2. Probes meet neighbouring cells as sub-cell bounding boxes with counts
   (``_near_stats``): boxes wholly within ``eps`` are counted, boxes wholly
   beyond are dropped.  A straddling pair of at most ``POINT_WORK_PER_PAIR``
   point comparisons is compared point by point, a heavier one is split a
   level further (4 up to 256 sub-cells per axis): each pair by its own work.
3. The cluster graph has one node per cell that contains core points; an
   edge joins two neighbouring cells whose core points come within ``eps``,
   proven with the same box scheme on box pairs (``_cell_edges``).
4. Connected components by contraction (``components.py``): rounds follow the
   logarithm of the number of cells, not the diameter; each is written.
5. Border points take the smallest cluster among core points within ``eps``
   (boxes of core points carry their cell's cluster).
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.operators.components import connected_components
from shelflens.session import ensure_checkpoint_dir, written


def cell_side(d: int, eps: float) -> float:
    """Cell side a hair below ``eps / sqrt(d)`` so that two points of one cell
    are within ``eps`` even after floating-point rounding of the bucketing."""
    return eps / math.sqrt(d) * (1.0 - 1e-9)


def neighbour_offsets(d: int, eps: float) -> list[tuple[int, ...]]:
    """Cell offsets whose cells can hold a point within ``eps`` of a point."""
    side = cell_side(d, eps)
    reach = math.ceil(eps / side)
    out = []
    for o in itertools.product(range(-reach, reach + 1), repeat=d):
        gap2 = sum(max(abs(x) - 1, 0) ** 2 for x in o) * side * side
        if gap2 <= eps * eps * (1 + 1e-12):
            out.append(o)
    return out


def _cells(prefix: str, d: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _dist2(a: list[str], b: list[str]):
    terms = [(F.col(x) - F.col(y)) * (F.col(x) - F.col(y)) for x, y in zip(a, b)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _shifted(cells: list[str], offsets) -> F.Column:
    """Array of neighbour cell structs for each offset."""
    return F.array(*[F.struct(*[(F.col(c) + F.lit(o[i])).alias(f"n{i}") for i, c in enumerate(cells)])
                     for o in offsets])


# Box refinement: every cell is split into 2**level sub-cells per axis, from
# START_LEVEL (4 per axis) down to MAX_LEVEL (256 per axis).  A point (or box)
# meets a box in one of three ways: all of the box within eps (decided), none
# of it (dropped), or straddling the eps boundary (refined one level down).
# Only points of boxes still straddling at MAX_LEVEL -- boxes 1/256 of a cell
# wide -- are compared point by point.
START_LEVEL = 2
MAX_LEVEL = 8
# A straddling pair of at most this many point comparisons is not split further.
POINT_WORK_PER_PAIR = 16
# Neighbour cells grow as a power of the dimensions (841 at d = 4): project first.
MAX_DIMENSIONS = 3


def _with_fine_index(df: DataFrame, xs, cs, side: float) -> DataFrame:
    """Sub-cell index at MAX_LEVEL per axis (coarser levels are bit shifts)."""
    fine = side / (1 << MAX_LEVEL)
    top = (1 << MAX_LEVEL) - 1
    return df.withColumns({
        f"f{i}": F.least(F.greatest(F.floor((F.col(x) - F.col(c) * F.lit(side)) / F.lit(fine)), F.lit(0)),
                         F.lit(top)).cast(T.IntegerType())
        for i, (x, c) in enumerate(zip(xs, cs))})


def _level_keys(d: int, level: int, prefix: str = "k"):
    return [F.shiftright(F.col(f"f{i}"), MAX_LEVEL - level).alias(f"{prefix}{i}") for i in range(d)]


def _sum2(terms):
    return sum(terms[1:], terms[0])


def _near_stats(probes: DataFrame, targets: DataFrame, xs, cs, ns, eps2: float, value: str | None) -> DataFrame:
    """For each probe point, ``n`` = number of target points within eps and
    (if ``value``) ``v`` = the smallest ``value`` among them.

    ``probes``: (pid, x..., n...) -- one row per (probe, neighbouring cell).
    ``targets``: (x..., c..., f..., [value]) -- points with fine indices.
    """
    d = len(xs)
    ks = [f"k{i}" for i in range(d)]
    pks = [f"pk{i}" for i in range(d)]
    stat_aggs = [F.count(F.lit(1)).alias("bn")] + ([F.min(value).alias("bv")] if value else [])
    found = []
    pend = probes
    tgt = targets
    for level in range(START_LEVEL, MAX_LEVEL + 1):
        boxes = (tgt.select(*cs, *xs, *_level_keys(d, level), *([value] if value else []))
                 .groupBy(*cs, *ks).agg(*stat_aggs, *[F.min(x).alias(f"lo{i}") for i, x in enumerate(xs)],
                                        *[F.max(x).alias(f"hi{i}") for i, x in enumerate(xs)]))
        boxes = boxes.select(*[F.col(c).alias(n) for c, n in zip(cs, ns)], *ks, "bn",
                             *(["bv"] if value else []), *[f"lo{i}" for i in range(d)], *[f"hi{i}" for i in range(d)],
                             *[F.shiftright(F.col(k), 1).alias(pk) for k, pk in zip(ks, pks)])
        on = ns if level == START_LEVEL else ns + pks
        near2, far2 = _point_box_d2(xs, d)
        met = (pend.join(boxes, on).withColumn("__near2", near2).withColumn("__far2", far2)
               .where(F.col("__near2") <= F.lit(eps2)).transform(written))  # read three times below
        found.append(met.where(F.col("__far2") <= F.lit(eps2))
                     .select("pid", "bn", *([F.col("bv")] if value else [])))
        straddle = met.where(F.col("__far2") > F.lit(eps2)).select("pid", *xs, *ns, *ks, "bn")
        heavy = F.lit(False) if level == MAX_LEVEL else F.col("bn") > POINT_WORK_PER_PAIR
        n_light, n_heavy = straddle.agg(F.count_if(~heavy), F.count_if(heavy)).first()
        if n_light:
            ys = [f"y{i}" for i in range(d)]
            pts = tgt.select(*[F.col(c).alias(n) for c, n in zip(cs, ns)], *_level_keys(d, level),
                             *[F.col(x).alias(y) for x, y in zip(xs, ys)], *([value] if value else []))
            close = (straddle.where(~heavy).select("pid", *xs, *ns, *ks).join(pts, ns + ks)
                     .where(_dist2(xs, ys) <= F.lit(eps2)))
            found.append(close.select("pid", F.lit(1).cast(T.LongType()).alias("bn"),
                                      *([F.col(value).alias("bv")] if value else [])))
        if not n_heavy:
            break
        straddle = straddle.where(heavy)
        # only the points under straddling boxes go one level down
        keep = straddle.select(*[F.col(n).alias(c) for n, c in zip(ns, cs)], *ks).distinct()
        tgt = tgt.withColumns({k: F.shiftright(F.col(f"f{i}"), MAX_LEVEL - level)
                               for i, k in enumerate(ks)}).join(keep, cs + ks, "left_semi").drop(*ks)
        pend = straddle.select("pid", *xs, *ns, *[F.col(k).alias(pk) for k, pk in zip(ks, pks)])
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    aggs = [F.sum("bn").alias("n")] + ([F.min("bv").alias("v")] if value else [])
    return out.groupBy("pid").agg(*aggs)


def _cell_edges(core: DataFrame, xs, cs, side: float, eps2: float, half) -> DataFrame:
    """Undirected edges ``(u, v)`` between neighbouring cells whose core points
    come within ``eps``, decided without pairing two heavy cells point by point.

    Core points are summarised as boxes per sub-cell.  Two boxes whose
    *largest* distance is <= eps prove an edge; boxes whose *smallest*
    distance is > eps are dropped; straddling box pairs of cell pairs not yet
    proven are refined one level down (both boxes split), and only those still
    straddling at the finest level are checked point by point.
    """
    d = len(xs)
    ns = [f"n{i}" for i in range(d)]
    aks, bks = [f"ak{i}" for i in range(d)], [f"bk{i}" for i in range(d)]
    apk, bpk = [f"apk{i}" for i in range(d)], [f"bpk{i}" for i in range(d)]
    pts = core.select("node", *cs, *xs, *[f"f{i}" for i in range(d)])
    proven_all = []
    pend = None
    tgt = pts
    for level in range(START_LEVEL, MAX_LEVEL + 1):
        boxes = (tgt.select("node", *cs, *xs, *_level_keys(d, level))
                 .groupBy("node", *cs, *[f"k{i}" for i in range(d)])
                 .agg(F.count(F.lit(1)).alias("bn"),
                      *[F.min(x).alias(f"lo{i}") for i, x in enumerate(xs)],
                      *[F.max(x).alias(f"hi{i}") for i, x in enumerate(xs)]))
        a = boxes.select(F.col("node").alias("u"), *cs, F.col("bn").alias("an"),
                         *[F.col(f"k{i}").alias(k) for i, k in enumerate(aks)],
                         *[F.shiftright(F.col(f"k{i}"), 1).alias(k) for i, k in enumerate(apk)],
                         *[F.col(f"lo{i}").alias(f"alo{i}") for i in range(d)],
                         *[F.col(f"hi{i}").alias(f"ahi{i}") for i in range(d)])
        b = boxes.select(F.col("node").alias("v"), *[F.col(c).alias(n) for c, n in zip(cs, ns)], "bn",
                         *[F.col(f"k{i}").alias(k) for i, k in enumerate(bks)],
                         *[F.shiftright(F.col(f"k{i}"), 1).alias(k) for i, k in enumerate(bpk)],
                         *[F.col(f"lo{i}").alias(f"blo{i}") for i in range(d)],
                         *[F.col(f"hi{i}").alias(f"bhi{i}") for i in range(d)])
        if pend is None:
            a = (a.select("*", F.explode(_shifted(cs, half)).alias("nb"))
                 .select("*", *[F.col(f"nb.{n}").alias(n) for n in ns]).drop("nb"))
            pairs = a.join(b, ns)
        else:
            pairs = (pend.join(a, ["u"] + apk).join(b, ["v"] + bpk))
        gap = [F.greatest(F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}"), F.lit(0.0))
               for i in range(d)]
        span = [F.greatest(F.col(f"ahi{i}") - F.col(f"blo{i}"), F.col(f"bhi{i}") - F.col(f"alo{i}"))
                for i in range(d)]
        pairs = (pairs.select("u", "v", *aks, *bks, (F.col("an").cast("double") * F.col("bn")).alias("work"),
                              _sum2([g * g for g in gap]).alias("min2"), _sum2([w * w for w in span]).alias("max2"))
                 .where(F.col("min2") <= F.lit(eps2)).transform(written))  # read several times below
        proven = pairs.where(F.col("max2") <= F.lit(eps2)).select("u", "v").distinct()
        straddle = pairs.where(F.col("max2") > F.lit(eps2)).select("u", "v", *aks, *bks, "work")
        # what earlier levels proved is gone already, but for the last level's point checks
        for p_ in [proven, *proven_all[-1:]]:
            straddle = straddle.join(p_, ["u", "v"], "left_anti")
        proven_all.append(proven)
        straddle = straddle.transform(written)
        heavy = F.lit(False) if level == MAX_LEVEL else F.col("work") > POINT_WORK_PER_PAIR
        n_light, n_heavy = straddle.agg(F.count_if(~heavy), F.count_if(heavy)).first()
        if n_light:
            pa = tgt.select(F.col("node").alias("u"), *_level_keys(d, level, "ak"),
                            *[F.col(x).alias(f"ax{i}") for i, x in enumerate(xs)])
            pb = tgt.select(F.col("node").alias("v"), *_level_keys(d, level, "bk"),
                            *[F.col(x).alias(f"bx{i}") for i, x in enumerate(xs)])
            checked = (straddle.where(~heavy).join(pa, ["u"] + aks).join(pb, ["v"] + bks)
                       .where(_dist2([f"ax{i}" for i in range(d)], [f"bx{i}" for i in range(d)]) <= F.lit(eps2))
                       .select("u", "v").distinct())
            proven_all.append(checked.transform(written))
        if not n_heavy:
            break
        straddle = straddle.where(heavy)
        pend = straddle.select("u", "v", *[F.col(k).alias(pk) for k, pk in zip(aks, apk)],
                               *[F.col(k).alias(pk) for k, pk in zip(bks, bpk)])
        keys = [F.shiftright(F.col(f"f{i}"), MAX_LEVEL - level).alias(f"k{i}") for i in range(d)]
        need = (pend.select(F.col("u").alias("node"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(apk)])
                .unionByName(pend.select(F.col("v").alias("node"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(bpk)]))
                .distinct())
        tgt = (tgt.select("*", *keys).join(need, ["node"] + [f"k{i}" for i in range(d)], "left_semi")
               .drop(*[f"k{i}" for i in range(d)]))
    one_way = proven_all[0]
    for p_ in proven_all[1:]:
        one_way = one_way.unionByName(p_)
    one_way = one_way.distinct()
    return one_way.unionByName(one_way.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _point_box_d2(xs, d):
    """(smallest, largest) squared distance from a point to a box."""
    near = [F.greatest(F.col(f"lo{i}") - F.col(x), F.col(x) - F.col(f"hi{i}"), F.lit(0.0))
            for i, x in enumerate(xs)]
    far = [F.greatest(F.abs(F.col(x) - F.col(f"lo{i}")), F.abs(F.col(x) - F.col(f"hi{i}")))
           for i, x in enumerate(xs)]
    return _sum2([v * v for v in near]), _sum2([v * v for v in far])


def dbscan(points: DataFrame, id_col: str, coord_cols, eps: float = K.DBSCAN_EPS,
           min_samples: int = K.DBSCAN_MIN_SAMPLES) -> DataFrame:
    """``(id, cluster, is_core)`` for every input point; ids must be unique longs.

    A point with a NULL or NaN coordinate is near nothing: noise (-1).
    """
    if len(coord_cols) > MAX_DIMENSIONS:
        raise ValueError(f"at most {MAX_DIMENSIONS} coordinates; project more of them first (pca_dbscan)")
    spark = points.sparkSession
    ensure_checkpoint_dir(spark)
    d = len(coord_cols)
    side = cell_side(d, eps)
    eps2 = eps * eps
    xs, cs = _cells("x", d), _cells("c", d)
    offsets = neighbour_offsets(d, eps)
    half = [o for o in offsets if o > tuple([0] * d)]   # each unordered cell pair once

    pts = points.select(F.col(id_col).cast(T.LongType()).alias("pid"),
                        *[F.col(f"`{c}`").cast(T.DoubleType()).alias(x) for c, x in zip(coord_cols, xs)])
    whole = F.lit(True)
    for x in xs:
        whole = whole & F.col(x).isNotNull() & ~F.isnan(x)
    lost = pts.where(~whole).select(
        F.col("pid").alias(id_col), F.lit(-1).cast(T.LongType()).alias("cluster"), F.lit(False).alias("is_core"))
    pts = pts.where(whole)
    pts = pts.withColumns({c: F.floor(F.col(x) / F.lit(side)).cast(T.LongType()) for c, x in zip(cs, xs)})
    pts = _with_fine_index(pts, xs, cs, side)
    fs = [f"f{i}" for i in range(d)]
    # written before the joins, so that AQE can split a cell that holds a third of the points
    counts = pts.groupBy(*cs).agg(F.count(F.lit(1)).alias("cell_n")).transform(written)
    pts = pts.join(counts, cs).transform(written)
    ns = _cells("n", d)

    def probes_of(df):
        return (df.select("pid", *xs, F.explode(_shifted(cs, offsets)).alias("nb"))
                .select("pid", *xs, *[F.col(f"nb.{n}").alias(n) for n in ns]))

    # -- 1. core test: only points of sparse cells count their neighbours ----
    deg = _near_stats(probes_of(pts.where(F.col("cell_n") < min_samples)),
                      pts.select(*xs, *cs, *fs), xs, cs, ns, eps2, None)
    sparse_core = deg.where(F.col("n") >= min_samples).select("pid", F.lit(True).alias("sc"))
    pts = (pts.join(sparse_core, "pid", "left")
           .withColumn("is_core", (F.col("cell_n") >= min_samples) | F.coalesce("sc", F.lit(False)))
           .drop("sc").transform(written))

    # -- 2. cluster graph over cells with core points ------------------------
    core = pts.where("is_core")
    nodes = core.groupBy(*cs).agg(F.min("pid").alias("node")).transform(written)
    core = core.join(nodes, cs).select("pid", "node", *xs, *cs, *fs).transform(written)
    edges = _cell_edges(core, xs, cs, side, eps2, half).transform(written)

    # -- 3. connected components ------------------------------------------------
    joined = written(connected_components(edges), "components").withColumnRenamed("component", "label")
    labels = nodes.select("node").join(joined, "node", "left").select("node", F.coalesce("label", "node").alias("label"))

    core_cluster = core.join(labels, "node").select("pid", F.col("label").alias("cluster"), *xs, *cs, *fs)
    # -- 4. border points: smallest cluster among core points within eps -------
    near_core = _near_stats(probes_of(pts.where(~F.col("is_core"))),
                            core_cluster.select(*xs, *cs, *fs, "cluster"), xs, cs, ns, eps2, "cluster")
    border = near_core.where(F.col("n") > 0).select("pid", F.col("v").alias("border_cluster"))
    out = (pts.select("pid", "is_core")
           .join(core_cluster.select("pid", "cluster"), "pid", "left")
           .join(border, "pid", "left")
           .select(F.col("pid").alias(id_col),
                   F.coalesce("cluster", "border_cluster", F.lit(-1).cast(T.LongType())).alias("cluster"),
                   "is_core"))
    return out.unionByName(lost)
