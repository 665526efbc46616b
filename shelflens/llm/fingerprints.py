"""Document fingerprints (operator 3), DataFrame functions only.

Closed syncmers over words: a k-mer of K consecutive words is kept when the
smallest hash among its inner S-word substrings lies at its first or last
place.  Whether a k-mer is kept depends on its own words alone, so the same
passage gives the same anchors in any context, and any stretch of words holds
one at short distance.  The fingerprint string is the SKETCH smallest anchor
hashes; two texts are compared by all their anchors and the anchors' positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.llm.common import numbered

K, S = 6, 2  # words of a k-mer and of its inner substrings
INNER = K - S + 1
SUPPORT = 2  # anchors that must agree on an offset (fewer if a text has fewer)
_PAIRS = "array<struct<position:int,anchor:bigint>>"
_OTHER = 1 << 32  # added to the positions of the second text
#: scripts written without spaces: every character is a word of its own.  All lie
#: from U+0E00 on; the range spares the characters before it a look-up for each script
_UNSPACED = r"[\x{E00}-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]"


def words_of(text):
    text = F.coalesce(text, F.lit(""))
    spaced = F.when(text.rlike(_UNSPACED), F.regexp_replace(text, f"({_UNSPACED})", " $1 ")).otherwise(text)
    return F.array_remove(F.split(spaced, r"[\x20\x09-\x0D]+"), "")


def with_anchors(df: DataFrame, text, name: str = "anchors") -> DataFrame:
    """Add the array of ``(position, anchor)`` of all closed syncmers; a text of
    fewer than K words has one anchor for all its words, one without words none.

    The hashes are columns of their own so that no lambda computes them anew.
    """
    w, h, g = f"__{name}_w", f"__{name}_h", f"__{name}_g"
    df = df.withColumn(w, words_of(text)).withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    df = df.withColumn(g, F.when(F.size(h) >= K, F.transform(F.slice(h, 1, F.size(h) - S + 1), lambda x, i: F.xxhash64(
        x, *[F.get(h, i + j) for j in range(1, S)]))))
    inner = lambda i, j: F.get(g, i + j)
    closed = F.filter(F.sequence(F.lit(0), F.size(g) - INNER), lambda i: F.least(inner(i, 0), inner(i, INNER - 1))
                      <= F.least(*[inner(i, j) for j in range(1, INNER - 1)]))
    many = F.transform(closed, lambda i: F.struct(i.alias("position"), F.xxhash64(
        *[inner(i, j) for j in range(0, INNER, S)]).alias("anchor")))
    one = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(F.array_join(w, " ")).alias("anchor")))
    none = F.expr(f"cast(array() as {_PAIRS})")
    return df.withColumn(name, F.when(F.col(g).isNotNull(), many).when(F.size(h) > 0, one).otherwise(none)).drop(w, h, g)


def anchors(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, position, anchor)`` rows for positional matching.

    An outer generator: the filter on the array's size that Spark infers for an
    inner one would be pushed below the hash columns and compute them per element.
    """
    return (with_anchors(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), F.col("text"))
            .select("doc_id", F.inline_outer("anchors")).where("position is not null"))


def with_matching(df: DataFrame, a, b, name: str) -> DataFrame:
    """Add the likeness of two ``(position, anchor)`` columns: matched pairs over
    all pairs of both (a matched one once); 1 for two empty texts.

    Of equal anchors the first of one text meets the first of the other, the
    second the second and so on.  Such a match counts if SUPPORT matches have its
    offset (difference of positions), so a passage counts wherever it lies.
    """
    u, s, o = f"__{name}_u", f"__{name}_s", f"__{name}_o"
    placed = lambda x, base: F.struct(x["anchor"].alias("anchor"), (x["position"].cast("long") + F.lit(base)).alias("place"))
    df = df.withColumn(u, F.sort_array(F.concat(F.transform(a, lambda x: placed(x, 0)), F.transform(b, lambda x: placed(x, _OTHER)))))
    at = lambda i: F.get(F.col(u), i)
    # equal anchors lie together, the first text's before the second's
    df = df.withColumn(s, F.filter(F.transform(u, lambda x, i: i), lambda i: F.coalesce(at(i)["anchor"] != at(i - 1)["anchor"], F.lit(True))))
    runs = F.transform(s, lambda x, k: F.struct(x.alias("from"), F.coalesce(F.get(F.col(s), k + 1), F.size(u)).alias("to")))
    both = F.filter(runs, lambda r: (at(r["from"])["place"] < _OTHER) & (at(r["to"] - 1)["place"] >= _OTHER))
    parts = F.transform(both, lambda r: F.struct(r["from"].alias("from"), r["to"].alias("to"), (r["from"] + F.size(F.filter(
        F.sequence(r["from"], r["to"] - 1), lambda i: at(i)["place"] < _OTHER))).alias("other")))
    offsets = F.flatten(F.transform(parts, lambda r: F.transform(
        F.sequence(F.lit(0), F.least(r["other"] - r["from"], r["to"] - r["other"]) - 1),
        lambda k: at(r["other"] + k)["place"] - at(r["from"] + k)["place"])))
    df = df.withColumn(o, F.sort_array(offsets))
    near = lambda x, i: F.coalesce(F.get(F.col(o), i) == x, F.lit(False))
    supported = F.size(F.filter(o, lambda x, i: near(x, i - SUPPORT + 1) | near(x, i + SUPPORT - 1)))
    matched = F.when(F.least(F.size(a), F.size(b)) < SUPPORT, F.size(o)).otherwise(supported)
    whole = F.size(a) + F.size(b)
    return df.withColumn(name, F.when(whole == 0, F.lit(1.0)).otherwise(matched / (whole - matched))).drop(u, s, o)


def as_fingerprint(anchors):
    """``{position, anchor}, {position, anchor}`` in order of position; empty without anchors."""
    return F.btrim(anchors.cast("string"), F.lit("[]"))


def read_fingerprint(fingerprint):
    """The ``(position, anchor)`` array of a fingerprint."""
    pair = lambda x: F.struct(F.substring_index(x, ", ", 1).cast("int").alias("position"),
                              F.substring_index(x, ", ", -1).cast("bigint").alias("anchor"))
    pairs = F.transform(F.split(F.regexp_replace(fingerprint, r"^\{|\}$", ""), r"\}, \{"), pair)
    return F.when(fingerprint != "", pairs).otherwise(F.expr(f"cast(array() as {_PAIRS})"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text: the last half of its
    code points replaced by the first as many of the next document's.

    The next document follows in descending id (nulls last, ties by hash;
    after the last comes the first).  Rows equal in id and text count as one
    document in that order.  A null text counts as empty; a single document
    is its own next.  Only ids, lengths and hashes are sorted; the texts are
    shuffled once by their hash and once more to the document before; anchors,
    larger than the texts they come from, are made after that.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    keys = (docs.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")))
    order = numbered(keys, [F.col("doc_id").desc_nulls_last(), F.col("key")], "place")
    count, repeated = order.agg(F.count(F.lit(1)), F.coalesce(F.max("copies"), F.lit(0))).first()
    before = order.select(F.pmod(F.col("place") + 1, F.lit(max(count, 1))).alias("place"), F.col("key").alias("before"))
    pairs = order.select("place", "key").join(before, "place").select("key", "before")

    # the same columns as below, so that both joins read one shuffle of the texts
    given = docs.select("key", "doc_id", "text")
    ahead = given.join(pairs, "key").select(F.col("before").alias("key"), F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    if repeated > 1:
        ahead = ahead.dropDuplicates(["key"])
    out = given.join(ahead, "key").withColumn("n_chars", F.char_length("text").cast("long"))
    half = "cast(n_chars div 2 as int)"
    out = out.withColumn("edited", F.concat(F.expr(f"substring(text, 1, cast(n_chars as int) - {half})"), F.expr(f"substring(next_text, 1, {half})")))
    for text in ("text", "next_text", "edited"):
        out = with_anchors(out, F.col(text), f"{text}_anchors")
    whole, ahead, edited = (F.col(f"{text}_anchors") for text in ("text", "next_text", "edited"))
    out = with_matching(with_matching(out, whole, edited, "near_edited"), whole, ahead, "near_next")
    return out.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                      as_fingerprint(whole).alias("fingerprint"), as_fingerprint(edited).alias("edited_fingerprint"),
                      "near_edited", "near_next", "next_id")
