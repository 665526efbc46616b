"""Quality classifier (operator 9): supervised subword embeddings.

Words and character n-grams are hashed into one table of learned vectors; a
document is the average of its features' vectors, a linear layer and softmax
give the class probabilities, and numpy stochastic gradient descent learns
both on a bounded labelled sample.  Scoring needs only each feature's share of
the logit difference (its vector times the class weights), so a whole text is
scored by table lookups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm import words as W
from shelflens.llm.common import arrow, no_clash, windows

BUCKET_BITS = 18
DIM = 8
GRAMS = (2, 3, 4)  # characters
REPEATED = 7  # the bucket of a word that repeats the one before it
EPOCHS = 12
RATE = 0.5
SAMPLE_DOCUMENTS = 3000  # labelled documents that are learned from, at most
SAMPLE_CHARS = 20_000  # of each of them, in windows over the whole text
WINDOWS = 8
PREDICT_AT = 0.7
_SPACES = np.array([32, 9, 10, 11, 12, 13], np.uint32)
_CODES = 1 << 20  # code points hashed at a time


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _features(texts):
    """Per feature kind: (buckets, document numbers' first feature), over all texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    codes = _code_points("".join(texts))
    letter = W.mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for n in GRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        total = letter[:m] * W._GRAM[0]
        for k in range(1, n):
            total += letter[k:k + m] * W._GRAM[k]
        total = W.mix(total + W._GRAM[40 + n])
        yield (total >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.minimum(starts, m), np.clip(ends - n + 1, np.minimum(starts, m), m)
    space = np.isin(codes, _SPACES)
    edge = np.zeros(len(codes) + 1, bool)
    edge[starts], edge[len(codes)] = True, True
    first, last = ~space, ~space
    first[1:] &= space[:-1] | edge[1:-1]
    last[:-1] &= space[1:] | edge[1:-1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = W._power(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(letter * power[:-1], out=sums[1:])
    hashes = W.mix((sums[b] - sums[a]) * inverse[a] + np.uint64(77))
    first = np.searchsorted(a, starts)
    yield (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), first, np.searchsorted(a, ends)
    # a word that repeats the one before it: one feature for all words
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[first < len(hashes)]] = False
    at = a[again]
    yield np.full(len(at), REPEATED, np.int64), np.searchsorted(at, starts), np.searchsorted(at, ends)


def _pieces(texts):
    """Lists of whole texts with about _CODES characters (one longer text is a list of its own)."""
    a, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= _CODES:
            yield a, texts[a:k + 1]
            a, held = k + 1, 0
    if a < len(texts):
        yield a, texts[a:]


def fit(texts, labels, seed: int = 0):
    """(share of the logit difference per bucket, bias) learned by SGD.
    Without both classes the score is the constant share of label 1."""
    labels = np.asarray(labels, np.int64)
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    flat = np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return flat
    bags = []
    for text in texts:
        parts = [b[s[0]:e[0]] for b, s, e in _features([text])] if text else []
        both = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        at, n = np.unique(both, return_counts=True)
        bags.append((at, (n / max(len(both), 1)).astype(np.float32)[:, None]))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / DIM, 1.0 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    weights, bias = np.zeros((2, DIM), np.float32), np.array([np.log(1 - share), np.log(share)], np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            at, portion = bags[k]
            rate, done = RATE * (1 - done / steps), done + 1
            mean = (vectors[at] * portion).sum(axis=0)
            logits = weights @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1.0
            back = weights.T @ p
            weights -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            # the features' average is what is stepped: scale by the bag's own weight of each feature
            vectors[at] -= (rate * 20.0) * portion * back
    return (vectors @ (weights[1] - weights[0])).astype(np.float32), float(bias[1] - bias[0])


def score_texts(texts, model) -> np.ndarray:
    """Probability of label 1 for each whole text (null and empty: the bias alone)."""
    share, bias = model
    out = np.zeros(len(texts))
    texts = [t or "" for t in texts]
    for row, some in _pieces(texts):
        total, count = np.zeros(len(some)), np.zeros(len(some))
        for buckets, start, end in _features(some):
            sums = np.concatenate([[0.0], np.cumsum(share[buckets], dtype=np.float64)])
            total += sums[end] - sums[start]
            count += end - start
        out[row:row + len(some)] = total / np.maximum(count, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(out + bias, -700, 700)))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """Model from at most SAMPLE_DOCUMENTS labelled documents, those whose id
    has the smallest hash.  Null ids, labels and texts teach nothing; an id
    with several labels counts by their mean, a repeated document once."""
    wanted = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
              .where("id is not null and label is not null").groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCUMENTS))
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # SAMPLE_DOCUMENTS rows of two numbers: a proven bound for the broadcast
    sample = (texts.where("text is not null").join(F.broadcast(wanted), "id").groupBy("id", "label")
              .agg(F.min(windows(F.col("text"), SAMPLE_CHARS, WINDOWS, F.col("id"))).alias("text")).orderBy(F.xxhash64("id"), "id").collect())
    return fit([r["text"] for r in sample], [r["label"] for r in sample])


def score(df: DataFrame, model, text_col: str = "text") -> DataFrame:
    """All rows with ``score`` and ``predicted`` (input columns of these names are replaced).
    Null and empty texts get the bias alone, very long ones are scored whole, equal texts
    alike; an empty table gives an empty table."""
    df = no_clash(df, ["score", "predicted"])
    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                s = score_texts(part.column(at).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= PREDICT_AT).astype(np.int32))], names=schema.names)

    return arrow(df, run, schema)
