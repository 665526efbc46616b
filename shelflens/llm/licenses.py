"""License scans (operator 8), DataFrame functions only: diagonal voting.

Every rolling k-gram of a text's words is hashed and joined to the places
where the license templates have it.  A match of a text place ``p`` with a
template place ``t`` votes for the diagonal ``p - t``; a copied template, with
words added or left out, shows as many votes on a few neighbouring diagonals.
Those are merged, and a span counts if it holds enough of the template's
k-grams in a stretch that is not much longer than the template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 3
DRIFT = 3  # words by which merged diagonals may lie apart
COVERAGE = 0.6  # of a template's k-grams
STRETCH = 1.5  # length of the span against the template's

# Fixed phrases of the base scan (all words consecutive).
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

# Wording of common license notices.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
]


def words_of(text):
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _hash(words, i, n):
    return F.xxhash64(*[F.get(words, i + j) for j in range(n)])


def phrase_places(words, joined, phrase: str):
    """Places of a phrase; the search by word runs only where the text has it."""
    parts = phrase.split()
    places = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), lambda i: _all(
        [F.get(words, i + j) == F.lit(p) for j, p in enumerate(parts)]))
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), places).otherwise(F.expr("cast(array() as array<int>)"))


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def template_grams(spark: SparkSession, templates) -> DataFrame:
    """``(template, label, gram, at, n)``: bounded by the templates given."""
    rows = [(k, label, text.split()) for k, (label, text) in enumerate(templates) if len(text.split()) >= GRAM]
    if not rows:
        return spark.createDataFrame([], "template int, label string, gram long, at int, n int")
    words = spark.createDataFrame(rows, "template int, label string, words array<string>")
    at = F.explode(F.sequence(F.lit(0), F.size("words") - GRAM)).alias("at")
    return words.select("template", "label", "words", at).select(
        "template", "label", _hash(F.col("words"), F.col("at"), GRAM).alias("gram"), "at", (F.size("words") - GRAM + 1).alias("n"))


def spans(df: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``(key, label, template, first_word, last_word, coverage)`` of verified
    spans in ``df(key, text)``; rows with equal keys count once."""
    words = df.select("key", words_of(F.col("text")).alias("words"))
    grams = words.where(F.size("words") >= GRAM).select("key", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("words") - GRAM),
        lambda i: F.struct(i.alias("p"), _hash(F.col("words"), i, GRAM).alias("gram")))).alias("x"))
    votes = (grams.select("key", "x.p", "x.gram").join(F.broadcast(template_grams(df.sparkSession, templates)), "gram")
             .groupBy("key", "template", "label", "n", (F.col("p") - F.col("at")).alias("diagonal"))
             .agg(F.collect_set("at").alias("hit"), F.min("p").alias("first"), F.max("p").alias("last")))
    row = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(row) > DRIFT).cast("int")
    merged = (votes.withColumn("apart", F.coalesce(apart, F.lit(0)))
              .withColumn("group", F.sum("apart").over(row)).groupBy("key", "template", "label", "n", "group")
              .agg(F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hits"),
                   F.min("first").alias("first"), F.max("last").alias("last")))
    coverage = F.col("hits") / F.col("n")
    return (merged.withColumn("coverage", coverage)
            .where((F.col("coverage") >= COVERAGE) & (F.col("last") - F.col("first") + 1 <= F.lit(STRETCH) * F.col("n") + DRIFT))
            .select("key", "label", "template", F.col("first").cast("long").alias("first_word"),
                    (F.col("last") + GRAM - 1).cast("long").alias("last_word"), "coverage"))


def scan(df: DataFrame, phrases=PHRASES, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: word count, base phrase places, and the labels of phrases and
    verified spans.  Null and empty texts have no words, no labels and score 0;
    repeated rows are judged alike; ``score`` is 1 for a phrase, else the best
    span's coverage."""
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    found = (spans(docs, templates).groupBy("key")
             .agg(F.collect_set("label").alias("span_labels"), F.max("coverage").alias("coverage")))
    base = docs.select("doc_id", "key", words_of(F.col("text")).alias("words"))
    base = base.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    places = [phrase_places(F.col("words"), F.col("joined"), p).alias(f"p{k}") for k, (_, p) in enumerate(phrases)]
    base = base.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), *places)
    every = F.flatten(F.array(*[F.col(f"p{k}") for k in range(len(phrases))]))
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (label, _) in enumerate(phrases)]))
    base = base.select("doc_id", "key", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
                       F.array_max(every).cast("long").alias("last_word"), F.array_distinct(labels).alias("base"))
    out = base.join(found, "key", "left")
    both = F.array_union("base", F.coalesce("span_labels", F.expr("cast(array() as array<string>)")))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join(F.sort_array("base"), ",").alias("base_labels"), F.array_join(F.sort_array(both), ",").alias("labels"),
                      F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"))
