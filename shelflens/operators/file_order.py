"""Order of rows as the files hold them (B8, D4): path, place of the split, place in it.

A scan's row carries its place from the reader (no sort, no shuffle): the path, the byte
at which its split starts, and an increasing number inside the split.  ``with_file_index``
turns places into contiguous numbers; it writes the rows first, as the splits of a second
scan need not be those of the first (their size follows the number of executors).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.session import written

PLACE = "__place"


def placed(scan: DataFrame, name: str = PLACE) -> tuple[DataFrame, str]:
    """A file scan with the place of each row as a struct column that sorts in file
    order, and that column's name (underscores are added while a column has it)."""
    taken = {c.lower() for c in scan.columns}
    while name.lower() in taken:
        name += "_"
    about = scan.metadataColumn("_metadata")
    place = F.struct(about["file_path"].alias("path"), about["file_block_start"].alias("start"),
                     F.monotonically_increasing_id().alias("at"))
    return scan.select("*", place.alias(name)), name


def with_file_index(df: DataFrame, place: str, name: str = "row_index") -> DataFrame:
    """The place column replaced by a contiguous 0-based number in file order (files by
    path).  ``df`` holds every row of its scan; no rows give an empty table."""
    kept = [c for c in df.columns if c != place]
    rows = written(df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)],
                             F.col(f"`{place}`.path").alias("path"), F.col(f"`{place}`.start").alias("start"),
                             F.col(f"`{place}`.at").alias("at")), "file-order")
    splits = rows.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # one row per split of the scan, a list that the driver already planned from
    before = Window.orderBy("path", "start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    out = rows.join(splits, ["path", "start"])
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)],
                      (F.col("at") + F.col("shift")).cast(T.LongType()).alias(name))
