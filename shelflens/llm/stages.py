"""The pipeline's stages: ``(spark, docs, sf_dir) -> DataFrame``.  Each works on
all rows it is given; all but the last return the columns of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.llm import decontaminate, jaccard_join, language_id, mixing, sharding
from shelflens.llm.common import stash, table, unused

SHARDS = 24
WEIGHTS = (5, 2, 1)


def language_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier can tell; null texts, texts
    without letters and those with a narrow margin go.  Copies go or stay together,
    repeated rows stay repeated; an empty table gives an empty table."""
    model = language_id.train(docs)
    return language_id.identify(docs, model).where("accepted").select(*[F.col(f"`{c}`") for c in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one that names the
    group, i.e. has its smallest id (rows equal in id and text are one document)."""
    known = F.col("doc_id").cast("long")
    # rows without an id are told apart by their text, behind all real ids
    own = F.coalesce(known, F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 62)))
    key = unused(docs, "__id")
    keyed = docs.withColumn(key, own)
    groups = jaccard_join.near_duplicates(keyed, id_col=key)
    keep = stash(groups.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct(), "keep")
    return keyed.join(keep, key, "left_semi").dropDuplicates([key, "text"]).drop(key)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited.  Null and empty texts
    hold none and stay; repeated rows go or stay together; without items or documents
    nothing goes."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matches") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (not at all, once or more).  A null
    source is a source of its own; null and empty texts take no words; repeated rows are
    taken together; an empty table gives an empty table."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    h, g, n, k = (unused(docs, x) for x in ("__h", "__g", "__n", "__k"))
    keyed = docs.withColumn(h, F.xxhash64(*names)).withColumn(g, F.xxhash64(F.lit(1), *names))
    taken = mixing.mix(keyed, WEIGHTS, key_cols=(h, g)).groupBy(h, g).agg(F.sum("copies").cast("int").alias(n))
    taken = stash(taken.where(F.col(n) > 0), "taken")
    # equal rows are taken together: one row of them, repeated as often as all are taken
    each = keyed.dropDuplicates([h, g]).join(taken, [h, g])
    return each.select(*names, F.explode(F.sequence(F.lit(1), F.col(n))).alias(k)).drop(k)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its place: row_number, shard (of 24 with equal row counts) and slot
    (columns of these names are replaced).  Null ids come first, repeated rows take
    adjacent numbers; an empty table gives an empty table."""
    return sharding.shard(docs, SHARDS)
