"""Exact quantiles by distributed selection (F-A9): no sort, no group in one task.

The rule is that of pandas ``describe`` / SQL ``quantile_cont``: linear
interpolation between the order statistics ``floor(h)`` and ``ceil(h)`` of
``h = (n - 1) p``.

1. One aggregate per group gives whatever moments the caller wants, ``n`` and a
   mergeable quantile sketch, read slightly below and above every probability:
   brackets that hold the wanted order statistics.
2. One more aggregate counts the values inside the brackets by value and the
   others by the gap between brackets they lie in.  Partial aggregation makes
   the latter one row a task and gap, and brackets hold a fixed share of a few
   in ``ACCURACY`` of the rows, so little is shuffled; a value that a third of
   all rows repeat is one row.  The counts are written, and are exact whatever
   the sketch's error: a wanted rank outside its bracket is seen, and the
   group's bracket becomes its whole range.
3. A bracket of more than ``leaf`` distinct values is narrowed on the written
   counts: pivots from a sketch of its distinct values, exact counts between
   them, and on with the span between two pivots that holds the rank.  At most
   ``leaf`` distinct values a rank are then read.

The driver holds one row a group, probability and pivot, never data.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.session import written

ACCURACY = 10_000      # of the sketch: its rank error is at most n / ACCURACY
LEAF = 4096            # distinct values read per wanted rank
PIVOTS = 256


def to_long(df: DataFrame, value_cols, key_cols=()) -> DataFrame:
    """(keys..., metric, value double) rows, NULL/NaN values dropped."""
    typed = df.select(*[F.col(f"`{k}`") for k in key_cols],
                      *[F.col(f"`{c}`").try_cast(T.DoubleType()).alias(c) for c in value_cols])
    return (typed.unpivot([F.col(f"`{k}`") for k in key_cols], [F.col(f"`{c}`") for c in value_cols],
                          "metric", "value")
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def _brackets(row, probs) -> list[tuple[float, float]]:
    """Disjoint closed value ranges around the wanted ranks of one group."""
    if row["__n"] <= ACCURACY:
        return [(row["__min"], row["__max"])]
    found = sorted((row["__q"][2 * k], row["__q"][2 * k + 1]) for k in range(len(probs)))
    out = [found[0]]
    for low, high in found[1:]:
        if low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _zone_counts(values: DataFrame, brackets: dict, group_type) -> DataFrame:
    """``(__g, __z, __v, __c)``, written: rows by value inside bracket ``k``
    (``__z = 2k + 1``), rows between the brackets ``k - 1`` and ``k`` (``__z = 2k``)."""
    width = max(len(b) for b in brackets.values())
    rows = [(g, *[x for k in range(width) for x in (b[k] if k < len(b) else (None, None))])
            for g, b in brackets.items()]
    schema = T.StructType([T.StructField("__g", group_type)] + [
        T.StructField(f"{side}{k}", T.DoubleType()) for k in range(width) for side in ("__lo", "__hi")])
    # one row a group, two columns a probability: a proven bound for the broadcast
    bounds = F.broadcast(values.sparkSession.createDataFrame(rows, schema))
    zone = F.lit(0)
    for k in range(width):
        zone = (zone + F.coalesce((F.col("__v") >= F.col(f"__lo{k}")).cast("int"), F.lit(0))
                + F.coalesce((F.col("__v") > F.col(f"__hi{k}")).cast("int"), F.lit(0)))
    zoned = values.join(bounds, "__g").select("__g", zone.alias("__z"), "__v")
    kept = F.when(F.col("__z") % 2 == 1, F.col("__v"))
    return written(zoned.groupBy("__g", "__z", kept.alias("__v")).agg(F.count(F.lit(1)).alias("__c")), "quantiles")


def _narrow(counts: DataFrame, spans: dict, group_type) -> dict:
    """One step for spans of many distinct values: ``{(g, rank): (z, low, high, before)}``
    to the same with a span between two neighbouring pivots."""
    spark = counts.sparkSession
    schema = T.StructType([T.StructField("__g", group_type), T.StructField("__rank", T.LongType()),
                           T.StructField("__z", T.IntegerType()), T.StructField("__low", T.DoubleType()),
                           T.StructField("__high", T.DoubleType())])
    # one row per group and wanted rank
    wanted = spark.createDataFrame([(g, rank, z, low, high) for (g, rank), (z, low, high, _) in spans.items()], schema)
    inside = (counts.join(F.broadcast(wanted), ["__g", "__z"])
              .where((F.col("__v") >= F.col("__low")) & (F.col("__v") <= F.col("__high"))))
    pivots = inside.groupBy("__g", "__rank").agg(F.percentile_approx(
        "__v", [k / PIVOTS for k in range(PIVOTS + 1)], ACCURACY).alias("__p"))
    pivots = pivots.select("__g", "__rank", F.array_sort(F.array_distinct("__p")).alias("__p")).collect()
    at = {(r["__g"], r["__rank"]): r["__p"] for r in pivots}
    # PIVOTS + 1 numbers per group and wanted rank
    table = spark.createDataFrame([(g, rank, p) for (g, rank), p in at.items()], T.StructType([
        schema["__g"], schema["__rank"], T.StructField("__p", T.ArrayType(T.DoubleType()))]))
    # a pivot is a place of its own (odd), as is the open span before it (even)
    place = F.size(F.filter("__p", lambda x: x < F.col("__v"))) * 2 + F.array_contains("__p", F.col("__v")).cast("int")
    parts = (inside.join(F.broadcast(table), ["__g", "__rank"])
             .groupBy("__g", "__rank", place.alias("__place"))
             .agg(F.sum("__c").alias("__c"), F.min("__v").alias("__low"), F.max("__v").alias("__high")))
    out, seen = {}, {}
    for r in sorted(parts.collect(), key=lambda r: r["__place"]):
        key = (r["__g"], r["__rank"])
        z, _, _, before = spans[key]
        start = seen.get(key, before)
        seen[key] = start + r["__c"]
        if start <= key[1] < seen[key]:
            out[key] = (z, r["__low"], r["__high"], start)
    return out


def _order_statistics(counts: DataFrame, spans: dict, group_type, leaf: int) -> dict:
    """``{(g, rank): value}`` from the written counts."""
    spark, found = counts.sparkSession, {}
    schema = T.StructType([T.StructField("__g", group_type), T.StructField("__rank", T.LongType()),
                           T.StructField("__z", T.IntegerType()), T.StructField("__low", T.DoubleType()),
                           T.StructField("__high", T.DoubleType())])
    while spans:
        for key in [k for k, (_, low, high, _) in spans.items() if low == high]:
            found[key] = spans.pop(key)[1]
        if not spans:
            break
        wanted = spark.createDataFrame([(g, rank, z, low, high) for (g, rank), (z, low, high, _) in spans.items()], schema)
        inside = (counts.join(F.broadcast(wanted), ["__g", "__z"])
                  .where((F.col("__v") >= F.col("__low")) & (F.col("__v") <= F.col("__high"))))
        sizes = {(r["__g"], r["__rank"]): r["n"] for r in
                 inside.groupBy("__g", "__rank").agg(F.count(F.lit(1)).alias("n")).collect()}
        large = {k: v for k, v in spans.items() if sizes[k] > leaf}
        small = [k for k in spans if k not in large]
        if small:
            keys = spark.createDataFrame(small, T.StructType([schema["__g"], schema["__rank"]]))
            lists: dict = {}
            # at most ``leaf`` rows per group and wanted rank
            for r in inside.join(F.broadcast(keys), ["__g", "__rank"]).select("__g", "__rank", "__v", "__c").collect():
                lists.setdefault((r["__g"], r["__rank"]), []).append((r["__v"], r["__c"]))
            for key in small:
                end = spans[key][3]
                for value, n in sorted(lists[key]):
                    end += n
                    if key[1] < end:
                        found[key] = value
                        break
        spans = _narrow(counts, large, group_type) if large else {}
    return found


def select_quantiles(long_df: DataFrame, probs, aggs=(), group_col: str = "metric",
                     value_col: str = "value", leaf: int = LEAF) -> list[tuple]:
    """``(row of aggs, {p: quantile})`` per group; ``aggs`` are aggregates over
    ``value_col`` (named ``__v`` there) taken in the scan of the sketch.

    NULL and NaN values are left out; a NULL group is a group like any other to
    the moments but has no quantiles; no rows give an empty list.
    """
    probs = [float(p) for p in probs]
    group_type = long_df.schema[group_col].dataType
    values = (long_df.select(F.col(f"`{group_col}`").alias("__g"), F.col(f"`{value_col}`").cast(T.DoubleType()).alias("__v"))
              .where(F.col("__v").isNotNull() & ~F.isnan("__v")))
    around = [min(1.0, max(0.0, p + side * 4 / ACCURACY)) for p in probs for side in (-1, 1)]
    rows = values.groupBy("__g").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.percentile_approx("__v", around, ACCURACY).alias("__q"), *aggs).collect()
    stats = {r["__g"]: r for r in rows if r["__g"] is not None}
    if not stats:
        return [(r, {}) for r in rows]
    ranks = {g: {p: (r["__n"] - 1) * p for p in probs} for g, r in stats.items()}
    brackets = {g: _brackets(r, probs) for g, r in stats.items()}
    known: dict = {}
    pending = dict(brackets)
    while pending:
        counts = _zone_counts(values, pending, group_type)
        ends: dict = {}
        # at most two zones a bracket and group
        for r in sorted(counts.groupBy("__g", "__z").agg(F.sum("__c").alias("__c")).collect(), key=lambda r: r["__z"]):
            if r["__g"] in pending:
                had = ends.setdefault(r["__g"], [])
                had.append((r["__z"], (had[-1][1] if had else 0) + r["__c"]))
        spans, missed = {}, {}
        for g in pending:
            found = {}
            for h in ranks[g].values():
                for rank in {math.floor(h), math.ceil(h)}:
                    k = bisect_left([end for _, end in ends[g]], rank + 1)
                    z = ends[g][k][0]
                    if z % 2 == 0:                       # the sketch erred: take the whole range
                        missed[g] = [(stats[g]["__min"], stats[g]["__max"])]
                        break
                    low, high = pending[g][z // 2]
                    found[g, rank] = (z, low, high, ends[g][k - 1][1] if k else 0)
            if g not in missed:
                spans.update(found)
        known.update(_order_statistics(counts, spans, group_type, leaf))
        pending = missed
    out = []
    for r in rows:
        g, qs = r["__g"], {}
        for p, h in ranks.get(g, {}).items():
            low, high = known[g, math.floor(h)], known[g, math.ceil(h)]
            qs[p] = low if low == high else low + (high - low) * (h - math.floor(h))
        out.append((r, qs))
    return out


def exact_quantiles(long_df: DataFrame, probs, group_col: str = "metric",
                    value_col: str = "value", leaf: int = LEAF) -> DataFrame:
    """``(group, p, quantile)`` rows; see the module's head for the method."""
    rows = [(r["__g"], p, q) for r, qs in select_quantiles(long_df, probs, (), group_col, value_col, leaf)
            for p, q in qs.items()]
    return long_df.sparkSession.createDataFrame(rows, T.StructType([
        T.StructField(group_col, long_df.schema[group_col].dataType), T.StructField("p", T.DoubleType()),
        T.StructField("quantile", T.DoubleType())]))
