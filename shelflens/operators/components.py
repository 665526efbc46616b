"""Connected components as a contraction over written tables.

Each round hooks every node to the smallest of itself and its neighbours in a
hash order, follows that hook once more, and keeps the edges between different
hooks.  In a random order a star is gone after one round and a path keeps about a
third of its nodes, so the number of rounds follows the logarithm of the number of
nodes whatever the diameter.  Every round is written and read back: a lost executor
re-reads files, and the plan (and its size estimate) starts anew each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.session import written


def _rank(node):
    """Hash order with the node itself as last tie-break."""
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("n"))


def connected_components(edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """``edges(u, v)`` of longs, any direction, repeats and loops allowed ->
    ``(node, component)``, the component being its smallest node.

    Nodes without an edge to another node are absent.  ``rounds``, if given, gets
    one DataFrame of hooks per round."""
    spark = edges.sparkSession
    hooks = [] if rounds is None else rounds
    work = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    while not work.isEmpty():
        both = work.unionAll(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = written(both.groupBy(F.col("u").alias("node")).agg(F.min(_rank("v")).alias("m"))
                       .select("node", F.least(_rank("node"), "m")["n"].alias("parent")), "hooks")
        # hooks end in nodes that hook to themselves or are followed again in the next round
        onward = hook.select(F.col("node").alias("parent"), F.col("parent").alias("beyond"))
        hook = written(hook.join(onward, "parent").select("node", F.col("beyond").alias("parent")), "hooks")
        hooks.append(hook)
        ends = [hook.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}")) for c in "uv"]
        work = written(work.join(ends[0], "u").join(ends[1], "v").where("pu <> pv")
                       .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "edges")
    if not hooks:
        return spark.createDataFrame([], "node long, component long")
    root = hooks[-1].select("node", F.col("parent").alias("root"))
    for hook in reversed(hooks[:-1]):  # the last rounds' tables are the smallest
        up = root.select(F.col("node").alias("parent"), "root")
        root = written(hook.join(up, "parent", "left").select("node", F.coalesce("root", "parent").alias("root")), "roots")
    smallest = written(root.groupBy("root").agg(F.min("node").alias("least")), "smallest")
    return root.join(smallest, "root").select("node", F.least("least", "root").alias("component"))
