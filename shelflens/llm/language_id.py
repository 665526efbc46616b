"""Language identification (operator 1): compression classification.

Each language has a raw-content zstandard dictionary cut from labelled texts.
A text is compressed once per dictionary, in pieces so short that the
dictionary, not the text's own history, decides the size; the language with
the smallest total wins.  A narrow margin to the runner-up rejects the text.
"""

from __future__ import annotations

import dataclasses
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm.common import arrow, no_clash, windows

UNKNOWN = "und"
PIECE = 1024  # bytes compressed at a time
LEVEL = 6
SAMPLE_DOCUMENTS = 500  # labelled texts per language that a dictionary is cut from, about
SAMPLE_CHARS = 1000  # of each of them, in windows over the whole text
WINDOWS = 4
DICTIONARY_BYTES = 512 << 10  # of one language
MIN_MARGIN = 0.005  # of the smallest size; below, the text is rejected
TEMPERATURE = 4.0  # bytes of difference per factor e of the score
_NO_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str | None) -> bytes:
    """Lower-case words of letters, one space between them: marks, digits and
    upper case say little about the language."""
    return _NO_LETTERS.sub(" ", (text or "").lower()).strip().encode("utf-8", "replace")


@dataclasses.dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]  # the one with most labelled texts first
    dictionaries: tuple[bytes, ...]


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel:
    """Dictionaries from a bounded sample of rows with a language and a text.

    The sample takes, per language, the texts whose hash lies below a share
    that gives about SAMPLE_DOCUMENTS distinct texts (copies count once); the
    driver gets one row per language and the sample: at most SAMPLE_CHARS characters
    of a text, a longer one in WINDOWS windows spread over all of it.  Texts that say
    several languages teach each; repeated rows count once.  An empty table, or one
    without a language or text, gives a model without languages, which knows nothing.
    """
    rows = labelled.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(
        "lang is not null and text is not null and text <> ''")
    rows = rows.withColumn("h", F.xxhash64("text"))
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not found:
        return LanguageModel((), ())
    scale = 1 << 30
    bound = F.create_map(*[F.lit(x) for lang, n in found.items()
                           for x in (lang, int(scale * min(1.0, 1.3 * SAMPLE_DOCUMENTS / max(n, 1))))])
    sample = (rows.where(F.pmod("h", F.lit(scale)) < bound[F.col("lang")])
              .groupBy("lang", "h").agg(F.min(windows(F.col("text"), SAMPLE_CHARS, WINDOWS, F.col("h"))).alias("text"))
              .orderBy("h", "lang").limit(4 * SAMPLE_DOCUMENTS * len(found)).collect())
    cut: dict[str, list[bytes]] = {}
    for r in sample:
        cut.setdefault(r["lang"], []).append(normal(r["text"]))
    languages = tuple(sorted(cut, key=lambda k: (-found[k], k)))
    return LanguageModel(languages, tuple(b" ".join(cut[k])[:DICTIONARY_BYTES] for k in languages))


def sizes(texts, model: LanguageModel) -> np.ndarray:
    """Compressed bytes of each text under each language's dictionary."""
    import zstandard as z
    made = []
    for data in model.dictionaries:
        d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
        params = z.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        made.append(z.ZstdCompressor(dict_data=d, compression_params=params).compress)
    out = np.zeros((len(texts), len(made)), np.int64)
    for i, text in enumerate(texts):
        raw = normal(text)
        for a in range(0, len(raw), PIECE):
            piece = raw[a:a + PIECE]
            out[i] += np.array([len(c(piece)) for c in made], np.int64)
    return out


def decide(size: np.ndarray, has_letter: np.ndarray, languages):
    """(language, score, margin, accepted) per row of ``sizes``."""
    n = len(size)
    if not languages:
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.zeros(n, bool)
    best = size.argmin(axis=1)  # ties: the most common language
    least = size.min(axis=1)
    score = 1.0 / np.exp(-np.minimum((size - least[:, None]) / TEMPERATURE, 700.0)).sum(axis=1)
    if len(languages) > 1:
        margin = (np.partition(size, 1, axis=1)[:, 1] - least) / np.maximum(least, 1)
    else:
        margin = np.ones(n)
    score, margin = np.where(has_letter, score, 0.0), np.where(has_letter, margin, 0.0)
    names = [languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
    return names, score, margin, has_letter & (margin >= MIN_MARGIN)


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All rows with ``lang_pred, score, margin, accepted`` (input columns of
    these names are replaced).  Null texts and texts without a letter are
    ``und`` with score 0 and never accepted; equal texts are judged alike, very long
    ones whole; an empty table gives an empty table.  Sizes that tie go to the language
    with most labelled texts, then the first by name, and are not accepted."""
    df = no_clash(df, ["lang_pred", "score", "margin", "accepted", "__letter"])
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("margin", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    keep, at = len(df.columns), df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                names, score, margin, ok = decide(sizes(part.column(at).to_pylist(), model),
                                                  part.column(keep).to_numpy(zero_copy_only=False).astype(bool), model.languages)
                added = [pa.array(names, pa.string()), pa.array(score), pa.array(margin), pa.array(ok)]
                yield pa.RecordBatch.from_arrays([*part.columns[:keep], *added], names=schema.names)

    letter = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    return arrow(df.withColumn("__letter", letter), run, schema)
