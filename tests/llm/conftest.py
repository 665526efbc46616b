import random
import zlib

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use themselves
                     T.StructField("score", T.StringType()), T.StructField("shard", T.StringType()),
                     T.StructField("matches", T.StringType()), T.StructField("node", T.LongType()),
                     T.StructField("a.b", T.StringType())])


def sentence(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, copies, repeated rows, odd white space."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    long = sentence(rng, 30_000)
    texts = [None, "", "   \n", "one", "one two  three\tfour", base, base, base.upper(), base + " extra",
             base.replace(" ", "\n", 1), long, long[:-5] + " end", "12 34 !!", "ÄÖ ü 漢字かな", "x" * 5000, "under the MIT License"]
    rows = [(i, t, "en" if i % 3 else None, ["a", "b", None][i % 3], len(t) if t else None, "s", "t", "m", 1, "z")
            for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, base, "en", "a", 1, "s", "t", "m", 1, "z"), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def rng():
    return random.Random(11)
