"""Shared helpers: tables kept in the shared folder, global row numbers,
connected components.  No helper collects rows that grow with the input."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelflens.session import scratch_dir


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies in a folder that
    they see too (local sessions, shared mounts); elsewhere install the package
    on the executors or pass it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in [*paths, root] if p])


def arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers.  ``fn`` takes the
    columns by position (PySpark cannot pass names with dots)."""
    ship(df.sparkSession)
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, compressed on disk."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_clash(df: DataFrame, names) -> DataFrame:
    """Drop input columns that an operator is about to add (any letter case)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while a column of ``df`` is called so (any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def windows(text, chars: int, pieces: int, seed):
    """The whole text if it has at most ``chars`` characters, else as many of them in
    ``pieces`` windows, one at a place drawn by ``seed`` in each equal part of the text,
    so that no part of a long text is left out by its place."""
    n, each = F.length(text), chars // pieces
    part = F.floor(n / pieces).cast("int")
    cut = [F.substring(text, (F.lit(k) * part + F.pmod(F.xxhash64(seed, F.lit(k)), (part - each + 1).cast("long")).cast("int") + 1), F.lit(each))
           for k in range(pieces)]
    return F.when(n > chars, F.concat_ws(" ", *cut)).otherwise(text)


def numbered(df: DataFrame, order_cols, name: str = "row_number",
             partitions: int | None = None) -> DataFrame:
    """Append a gapless global row number (from 0) following ``order_cols``.

    One range shuffle sorts the rows; each sorted partition is written once
    with its partition number and the row's place in it, and the partitions'
    row counts (one row per partition: a proven bound for the broadcast) turn
    places into global numbers.  The last tie-break is the whole row, so only
    rows equal in every column are interchangeable.  A column called ``name``
    is replaced, all others stay.
    """
    df = no_clash(df, [name])
    columns = [F.col(f"`{c}`") for c in df.columns]
    all_, pos, pid, off = (unused(df, n) for n in ("__all", "__pos", "__pid", "__off"))
    order = [*order_cols, F.col(all_)]
    ranged = df.withColumn(all_, F.xxhash64(*columns))
    ranged = (ranged.repartitionByRange(partitions, *order) if partitions
              else ranged.repartitionByRange(*order))
    ranged = (ranged.sortWithinPartitions(*order).drop(all_)
              .withColumn(pos, F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition << 33) + place in the partition
    kept = stash(ranged, "numbered").withColumn(pid, F.shiftright(pos, 33))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (kept.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
               .select(pid, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(off)))
    place = F.col(pos) - F.shiftleft(F.col(pid), 33)
    return (kept.join(F.broadcast(offsets), pid)
            .select(*columns, (F.col(off) + place).cast("long").alias(name)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs) -> ``(node, component)``,
    the component being one of its nodes.  Nodes without an edge are absent.

    Each round hooks every node to its neighbour (or itself) of smallest hash
    and contracts the edges.  In this random order a star takes two rounds and a
    path loses a constant share of its nodes each round, so the rounds are
    logarithmic.  All tables stay distributed; node tables are written before
    they are joined so that AQE can split a hub's edges.
    """
    spark = edges.sparkSession
    work = stash(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .distinct(), "edges")
    hooks = []
    while not work.isEmpty():
        both = work.unionAll(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        hook = stash(both.groupBy("a").agg(F.min(rank("b")).alias("m"))
                     .select(F.col("a").alias("node"), F.least(rank("a"), "m")["n"].alias("parent")), "hooks")
        hooks.append(hook)
        left = hook.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = hook.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        work = stash(work.join(left, "a").join(right, "b").where("pa <> pb")
                     .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                     .distinct(), "edges")
    if not hooks:
        return spark.createDataFrame([], "node long, component long")
    found = hooks[0].select("node", F.col("parent").alias("component"))
    for hook in hooks[1:]:
        up = hook.select(F.col("node").alias("component"), F.col("parent").alias("__up"))
        found = (found.join(up, "component", "left")
                 .select("node", F.coalesce("__up", "component").alias("component")))
    return stash(found, "components")
