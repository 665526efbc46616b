"""Corpus pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelflens.llm import stages as S
from shelflens.llm.common import stash, table

STAGES = [
    ("language ID", S.language_identified),
    ("n-gram Jaccard join", S.deduplicated),
    ("benchmark decontamination", S.decontaminated),
    ("mixing sources to target weights", S.mixed),
    ("sharding", S.sharded),
]

# Compression sizes, alignments and hashes cannot be expressed in SQL; the
# stages are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
