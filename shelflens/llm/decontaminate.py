"""Benchmark decontamination (operator 2): rare word-pair seeds, then alignment.

A seed is an ordered pair of words, next to each other or with one word between
them, in the item and in the text alike.  An alignment that reaches THRESHOLD
has a known number of steps from one matched word to the next that skip at most
one word on either side (`least_pairs`), so a text that holds a copy holds that
many of the item's pairs, however it was edited.  Pairs are counted over the
corpus and each item's most frequent ones are left out, but never so many that
a copy could lose all of its own: by the pigeonhole principle at least
`needed_seeds` of the kept ones lie in any copy.  Nothing but this exact bound
decides where a window opens; Smith-Waterman alignment scores the windows, so
that edited and paraphrased copies count by how much of the item they keep.

Items are taken in blocks of a bounded size, so neither driver nor executors
ever hold more than one block of the benchmark.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm import words as W
from shelflens.llm.common import arrow, no_clash

LEAST_WORDS = 3  # shorter items cannot be told from ordinary language
APART = (1, 2)  # distances of a pair's words: a step of alignment cost 0 or 1
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5  # of the item's score against itself
ITEMS_PER_BLOCK = 20_000
ENTRIES = 2_000_000  # seed places looked at together (one document's at least)
# words here are runs of ASCII letters, digits and all other characters beyond ASCII
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[48:58] = _SEPARATOR[65:91] = _SEPARATOR[97:123] = _SEPARATOR[128:] = False


def _word_rows(array):
    """Per chunk of texts: (first row, word hashes, each row's first word number)."""
    for row, _, data, offsets in W.chunks(array):
        starts, ends, first = W.word_spans(data, offsets, _SEPARATOR)
        yield row, W.hash_spans(data, starts, ends), first


def need(n: int) -> float:
    """Score from which a copy of an item of n words counts."""
    return THRESHOLD * MATCH * n


def least_pairs(n):
    """Steps over at most one word in any alignment that reaches `need`.

    M matched words make M - 1 steps, and MATCH * M less their costs is the
    score, so at most (MATCH * M - need) / 2 steps cost 2 or more.
    """
    return np.ceil(THRESHOLD * MATCH * n / 2).astype(np.int64) - 1


def needed_seeds(n):
    """How many of an item's seeds any copy holds, once `rarest` has chosen them."""
    return (least_pairs(n) + 1) // 2


def _pairs(words: np.ndarray, apart: int) -> np.ndarray:
    """Hash of the words at each position and ``apart`` further on."""
    return W.mix(words[:-apart] * W._GRAM[0] + words[apart:] * W._GRAM[1])


@dataclasses.dataclass
class Block:
    """Items of one block and their seeds, sorted by pair hash."""
    item_ids: list
    words: list  # of each item: word hashes
    grams: np.ndarray
    gram_item: np.ndarray
    gram_at: np.ndarray

    def lookup(self):
        """Distinct pairs, their slices, and a bit table that rules out most others."""
        distinct, first = np.unique(self.grams, return_index=True)
        bits = np.zeros(1 << 20, bool)
        bits[(distinct >> np.uint64(44)).astype(np.int64)] = True
        return distinct, np.append(first, len(self.grams)), bits


def make_block(ids, texts) -> Block:
    grams, item, at, kept = [], [], [], []
    for row, hashes, first in _word_rows(pa.array(texts, pa.string())):
        for k in range(len(first) - 1):
            kept.append(hashes[first[k]:first[k + 1]])
    for k, w in enumerate(kept):
        for apart in APART if len(w) >= LEAST_WORDS else ():
            g = _pairs(w, apart)
            grams.append(g), item.append(np.full(len(g), k)), at.append(np.arange(len(g)))
    grams, item, at = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (grams, item, at))
    order = np.argsort(grams, kind="stable")
    return Block(list(ids), kept, grams[order], item[order].astype(np.int64), at[order].astype(np.int64))


def _found(hashes, first, lookup):
    """(positions, numbers of distinct pairs) of the block's pairs in the chunk."""
    distinct, _, bits = lookup
    places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for apart in APART if len(distinct) else ():
        grams = _pairs(hashes, apart)
        at = np.flatnonzero(bits[(grams >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(distinct, grams[at]), len(distinct) - 1)
        hit = distinct[k] == grams[at]
        at, k = at[hit], k[hit]
        row_end = first[np.searchsorted(first, at, "right")]  # a pair must not run into the next text
        inside = at + apart < row_end
        places.append(at[inside]), numbers.append(k[inside])
    return np.concatenate(places), np.concatenate(numbers)


def corpus_counts(texts: DataFrame, block: Block) -> np.ndarray:
    """Occurrences of each distinct pair of the block in all texts."""
    lookup = block.lookup()
    n = len(lookup[0])

    def run(batches):
        total = np.zeros(n, np.int64)
        for batch in batches:
            for _, hashes, first in _word_rows(batch.column(0)):
                total += np.bincount(_found(hashes, first, lookup)[1], minlength=n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["k", "n"])

    counts = np.zeros(n, np.int64)
    # one row per pair of the block: bounded by the block
    for r in arrow(texts, run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r["k"]] = r["n"]
    return counts


def rarest(block: Block, counts: np.ndarray) -> Block:
    """The block with its seeds: the pairs of each item's rarest positions (ties by place).

    Of an item's n - 1 positions with a pair a copy holds `least_pairs`; it
    holds `needed_seeds` of the kept ones if as many positions are left out as
    the difference, whichever they are.
    """
    _, first, _ = block.lookup()
    size = np.array([len(w) for w in block.words], np.int64)
    begin = np.cumsum(size) - size  # positions of all items in one row
    place = begin[block.gram_item] + block.gram_at
    uses = np.bincount(place, np.repeat(counts, np.diff(first)), size.sum())
    item = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(item)) - begin[item]
    paired = np.flatnonzero(at < size[item] - 1)
    order = paired[np.lexsort((at[paired], uses[paired], item[paired]))]
    rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
    n = size[item[order]]
    chosen = np.zeros(len(item), bool)
    chosen[order[rank < n - 1 - least_pairs(n) + needed_seeds(n)]] = True
    keep = chosen[place]
    return Block(block.item_ids, block.words, block.grams[keep], block.gram_item[keep], block.gram_at[keep])


def _openings(doc, item, at, item_at, size):
    """(document, item, where the item would begin) of the seeds that can be the
    first of a copy: `needed_seeds` from it on within the longest copy's words."""
    order = np.lexsort((item_at, at, item, doc))
    doc, item, at, item_at = doc[order], item[order], at[order], item_at[order]
    # a pair of equal words may be found by both distances
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(at) != 0) | (np.diff(item_at) != 0)
    doc, item, at, item_at = doc[new], item[new], at[new], item_at[new]
    n = size[item]
    last = np.arange(len(doc)) + needed_seeds(n) - 1
    to = np.minimum(last, len(doc) - 1)
    opens = (last == to) & (doc[to] == doc) & (item[to] == item) & (at[to] - at < n + _slack(n))
    return doc[opens], item[opens], (at - item_at)[opens]


def _slack(n):
    """Words that a copy of an item of n words can have put in."""
    return np.floor((MATCH - THRESHOLD * MATCH) * n).astype(np.int64)


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman with linear gaps: best local score and where it ends in the window."""
    slope = -GAP * np.arange(len(window) + 1)
    above = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        here = above + GAP
        here[1:] = np.maximum(here[1:], above[:-1] + np.where(window == w, MATCH, MISMATCH))
        here[0] = 0
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + slope) - slope  # gaps along the window
        k = int(here.argmax())
        if here[k] > best:
            best, end = int(here[k]), k
        above = here
    return best, end


def _matches(words: np.ndarray, items, begins, block: Block):
    """Best alignment per item of one document, from its openings."""
    out = []
    for i in np.unique(items):
        item = block.words[i]
        n = len(item)
        lows, slack, least = np.sort(begins[items == i]), int(_slack(np.int64(n))), need(n)
        best = (0, 0, 0)
        # a copy through an opening lies from slack words before the item's place to slack words behind it
        group = np.flatnonzero(np.diff(lows, prepend=lows[0] - 3 * (n + slack)) > n + 2 * slack)
        for a, b in zip(group, np.append(group[1:], len(lows))):
            lo, hi = max(0, lows[a] - slack), min(len(words), lows[b - 1] + n + slack)
            window = words[lo:hi]
            if MATCH * min(n, int(np.isin(window, item).sum())) < least:
                continue
            s, end = align(item, window)
            if s >= least and s > best[0]:
                _, back = align(item[::-1], window[:end][::-1])
                best = (s, lo + end - back, lo + end - 1)
        if best[0]:
            out.append({"item_id": block.item_ids[i], "score": best[0] / (MATCH * n), "first_word": int(best[1]), "last_word": int(best[2])})
    return out


def _blocks(items: DataFrame, id_col, text_col):
    rows = items.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where("t is not null").distinct()
    n = -(-rows.count() // ITEMS_PER_BLOCK)
    part = F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1)))
    for k in range(n):
        got = rows.where(part == k).orderBy("i", "t").collect()  # about ITEMS_PER_BLOCK items
        yield make_block([r["i"] for r in got], [r["t"] for r in got])


def scan(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows with ``matches``: item_id, score (share of the item's own
    alignment score, THRESHOLD at least) and the first and last word of the
    copy, for each test item that the text holds; empty for clean texts.

    Null and empty texts are clean; null items are skipped, items of fewer
    than LEAST_WORDS words are not looked for; repeated rows are judged alike; an
    input column ``matches`` is replaced.
    """
    df = no_clash(df, ["matches"])
    kind = T.ArrayType(T.StructType([T.StructField("item_id", items.schema[item_id].dataType), T.StructField("score", T.DoubleType()),
                                     T.StructField("first_word", T.IntegerType()), T.StructField("last_word", T.IntegerType())]))
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_kind = to_arrow_type(kind)
    schema = T.StructType([*df.schema.fields, T.StructField("matches", kind)])
    columns, at = len(df.columns), df.columns.index(text_col)
    out = df.withColumn("matches", F.array().cast(kind))
    for block in _blocks(items, item_id, item_text):
        if not len(block.grams):
            continue
        seeds = rarest(block, corpus_counts(df.select(F.col(f"`{text_col}`")), block))

        def run(batches, block=seeds):
            lookup, size = block.lookup(), np.array([len(w) for w in block.words], np.int64)
            for batch in batches:
                found = batch.column(columns).to_pylist()
                for row, hashes, first in _word_rows(batch.column(at)):
                    where, k = _found(hashes, first, lookup)
                    order = np.argsort(where, kind="stable")
                    where, k = where[order], k[order]
                    # one entry per place of the pair in an item
                    times = np.diff(lookup[1])[k]
                    doc = np.searchsorted(first, where, "right") - 1
                    part = np.cumsum(times) // ENTRIES
                    cuts = np.flatnonzero(np.diff(doc, prepend=-1))  # whole documents together
                    cuts = cuts[np.diff(part[cuts], prepend=-1) != 0]
                    for a, b in zip(cuts, np.append(cuts[1:], len(doc))):
                        many = times[a:b]
                        entry = np.repeat(lookup[1][k[a:b]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                        of, items, begins = _openings(np.repeat(doc[a:b], many), block.gram_item[entry], np.repeat(where[a:b], many),
                                                      block.gram_at[entry], size)
                        ends = np.flatnonzero(np.diff(of, prepend=-1))
                        for c, e in zip(ends, np.append(ends[1:], len(of))):
                            d = of[c]
                            got = _matches(hashes[first[d]:first[d + 1]], items[c:e], begins[c:e] - first[d], block)
                            if got:
                                found[row + d] = found[row + d] + got
                yield pa.RecordBatch.from_arrays([*batch.columns[:columns], pa.array(found, arrow_kind)], names=schema.names)

        out = arrow(out, run, schema)
    return out
