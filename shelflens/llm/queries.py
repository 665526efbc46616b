"""The registered ``opN_*`` queries: each applies its operator, with production
parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflens.llm import (chat_format, decontaminate, fingerprints, jaccard_join, language_id, licenses, mixing, oracles, periodic_runs, quality,
                            sharding, token_alignment, token_files, url_filters)
from shelflens.llm.common import stash, table

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id="doc_id"):
    """Rows kept from all learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where("doc_id is not null").where(~held_out()))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents"), tokenizer_file())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(F.coalesce(text, F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"))
    return sharding.shard(rows, 24).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                           F.lit(None).cast("int").alias("grown_shard"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), (5, 2, 1)).select(
        "doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels").where("doc_id is not null").where(~held_out()))
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


PLANTED_CHAT = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(PLANTED_CHAT, "conv_id long, turn long, role string, text string"))
    return chat_format.chat_digest(stash(chat_format.format_chats(rows), "chats"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.run_digest(periodic_runs.find_runs(docs, extend=periodic_runs.periodic_extension))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_file(), piece_file())


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontaminate, op3_fingerprints, op4_token_files, op5_sharding,
                                  op6_url_filters, op7_mixing, op8_licenses, op9_quality, op10_jaccard_join, op11_chat_format, op12_periodic_runs,
                                  op13_token_alignment)}
ORACLE_SQL = {"op6_url_filters": oracles.url_filters(URL_RULES), "op8_licenses": oracles.licenses(),
              "op10_jaccard_join": oracles.jaccard_join()}
