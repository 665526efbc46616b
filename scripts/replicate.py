"""Replicate the sf0.1 tables N times with fresh keys per copy (for scaling runs).

Usage: python scripts/replicate.py <src_sf_dir> <out_dir> <copies>
Writes part/lineitem/events/embeddings.parquet folders under <out_dir>; point
BENCH_SF_DIR at it.  Keys are shifted per copy, so the number of SKUs, orders,
events and vectors grows with the data (embeddings are exact duplicates).
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shelflens.session import get_session  # noqa: E402


def replicate(df, copies: int, shifts: dict[str, int]):
    out = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    for col, step in shifts.items():
        out = out.withColumn(col, F.col(col) + F.col("__copy").cast("long") * F.lit(step))
    return out.drop("__copy")


def main() -> None:
    src, out, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = get_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    step = lambda df, c: df.agg(F.max(c)).first()[0] + 1        # noqa: E731
    part, li, ev, em = read("part"), read("lineitem"), read("events"), read("embeddings")
    pk, ok, ek, vk = step(part, "p_partkey"), step(li, "l_orderkey"), step(ev, "event_id"), step(em, "vec_id")
    replicate(part, copies, {"p_partkey": pk}).write.parquet(f"{out}/part.parquet")
    replicate(li, copies, {"l_partkey": pk, "l_orderkey": ok}).write.parquet(f"{out}/lineitem.parquet")
    replicate(ev, copies, {"event_id": ek}).write.parquet(f"{out}/events.parquet")
    replicate(em, copies, {"vec_id": vk}).write.parquet(f"{out}/embeddings.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
