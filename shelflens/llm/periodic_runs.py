"""Periodic runs of words (operator 12): enhanced suffix array, branching tandems.

A run is a maximal stretch of words with smallest period ``q`` (words ``q``
apart are identical) of at least ``max(MIN_WORDS, MIN_POWER * q)`` words.  Runs
are found without a tree: each boundary of the suffix array with an LCP of
``q`` words parts its LCP interval in two; the suffixes of the smaller part are
tested for a partner ``q`` words on or back in the other part, by the inverse
suffix array (``O(n log n)`` tests in all).  Such a pair is a branching square;
it is rotated to the left as far as it goes, which gives the whole run.

Many documents share one suffix array: ranks start with the document's number,
so no comparison leaves a document and copies cost nothing extra.  A task holds
one chunk of texts at a time (about ``words.CHUNK_BYTES``, or one longer text:
some 150 bytes a word, plus 4 for each doubling of its longest repeat).

Null and empty texts have no words and no runs; a null id takes no part in
anything but the output; repeated rows are handled row by row; extra columns
are ignored whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelflens.llm import words as W
from shelflens.llm.common import arrow

MIN_WORDS, MIN_POWER = 6, 4
TESTS = 1 << 21  # membership tests made at a time


def _ragged(starts, sizes):
    """All numbers of the ranges ``starts[k] .. starts[k] + sizes[k]``, and each one's k."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return np.arange(len(of)) - before[of] + starts[of], of


def _groups(keys):
    """Of sorted keys: the place where each one's group of equals starts, and whether it has others."""
    at = np.arange(len(keys))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    shared = ~first
    shared[:-1] |= ~first[1:]
    return np.maximum.accumulate(np.where(first, at, 0)), shared


def suffix_ranks(ids, first):
    """Ranks of all suffixes by their first 1, 2, 4, ... words within their own
    document (rank: place of the first equal one), up to where all differ."""
    n = len(ids)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = np.asarray(first)[1:][doc]
    key = doc * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key, kind="stable")
    start, shared = _groups(key[order])
    rank = np.empty(n, np.int32)
    rank[order] = start
    levels, active, k = [rank], order[shared], 1
    while len(active):
        on = active + k
        second = np.where(on < end[active], rank[np.minimum(on, n - 1)], -1).astype(np.int64)
        key = rank[active].astype(np.int64) * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        start, shared = _groups(key)
        outer, _ = _groups(key // (n + 1))
        rank = rank.copy()
        rank[active] = levels[-1][active] + (start - outer)
        levels.append(rank)
        active, k = active[shared], 2 * k
    return levels


def _lcp(levels, sa):
    """Words that the suffixes ``sa[k - 1]`` and ``sa[k]`` have in common (0 for k = 0)."""
    n = len(sa)
    out = np.zeros(n, np.int64)
    pairs = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b = sa[pairs - 1].astype(np.int64), sa[pairs].astype(np.int64)
    for j in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[j], -1)
        on = np.where(rank[a] == rank[b], 1 << j, 0)
        a += on
        b += on
    out[pairs] = a - sa[pairs - 1]
    return out


def _interval_parts(lcp, nodes):
    """For each boundary of ``nodes`` the left and right part of its LCP interval as
    suffix array places ``(l, r)``: l..k-1 and k..r.  Equal boundaries to the left
    belong to the left part, so that an interval of many children falls into pairs."""
    n, v = len(lcp), lcp[nodes]
    left, right = nodes.copy(), nodes + 1
    flat = np.flatnonzero(np.append(lcp, 0) == 0)
    longest = int(np.diff(flat).max(initial=1)) if len(flat) > 1 else n
    table = [lcp.astype(np.int32)]
    while 1 << len(table) <= longest:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]) if len(table[-1]) > half else np.zeros(0, np.int32))
    for j in range(len(table) - 1, -1, -1):
        low, size = table[j], len(table[j])
        if not size:
            continue
        at = left - (1 << j)
        left = np.where((at >= 1) & (at < size) & (low[np.clip(at, 0, size - 1)] >= v), at, left)
        right = np.where((right < size) & (low[np.minimum(right, size - 1)] > v), right + (1 << j), right)
    return left - 1, right - 1


def branching_squares(ids, first):
    """``(start, period)`` of all squares whose two halves differ in the word behind
    them (or end with the text), of periods that a long enough run can have."""
    none = np.zeros(0, np.int64)
    if len(ids) < MIN_POWER:
        return none, none
    levels = suffix_ranks(ids, first)
    rank = levels[-1].astype(np.int64)
    sa = np.empty(len(ids), np.int64)
    sa[rank] = np.arange(len(ids))
    lcp = _lcp(levels, sa)
    del levels
    size = np.repeat(np.diff(first), np.diff(first))[sa]
    nodes = np.flatnonzero((lcp > 0) & (lcp * MIN_POWER <= size))
    if not len(nodes):
        return none, none
    l, r = _interval_parts(lcp, nodes)
    small_left = nodes - l <= r - nodes + 1
    lo, many = np.where(small_left, l, nodes), np.where(small_left, nodes - l, r - nodes + 1)
    other_lo, other_hi = np.where(small_left, nodes, l), np.where(small_left, r, nodes - 1)
    period, total = lcp[nodes], np.cumsum(many)
    found, a = [], 0
    while a < len(nodes):
        done = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + TESTS, "right")))
        at, of = _ragged(lo[a:b], many[a:b])
        i, d, x, y = sa[at], period[a:b][of], other_lo[a:b][of], other_hi[a:b][of]
        for partner, start in ((i + d, i), (i - d, i - d)):
            fits = np.flatnonzero((partner >= 0) & (partner < len(ids)))
            place = rank[partner[fits]]
            fits = fits[(place >= x[fits]) & (place <= y[fits])]
            found.append((start[fits], d[fits]))
        a = b
    return tuple(np.concatenate(x) for x in zip(*found))


def rotated(ids, first, start, period):
    """The leftmost start to which each square can be rotated, step sizes doubling."""
    least = np.asarray(first)[np.searchsorted(first, start, "right") - 1]
    at, live, step = start.copy(), np.arange(len(start)), 1
    while len(live):
        size = np.minimum(step, at[live] - least[live])
        back, of = _ragged(np.zeros(len(live), np.int64), size)  # words back from the start, nearest first
        j = at[live][of] - 1 - back
        differs = np.flatnonzero(ids[j] != ids[j + period[live][of]])
        moved = size.copy()
        owner = of[differs]
        nearest = np.ones(len(owner), bool)
        nearest[1:] = owner[1:] != owner[:-1]
        moved[owner[nearest]] = back[differs[nearest]]
        at[live] -= moved
        live, step = live[(moved == size) & (size == step)], 2 * step
    return at


def runs(ids, first):
    """``(start, end, period)`` of all runs, by start, then period; starts are places in ``ids``."""
    square, period = branching_squares(ids, first)
    start, end = rotated(ids, first, square, period), square + 2 * period
    long = end - start >= np.maximum(MIN_WORDS, MIN_POWER * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))  # a multiple of a run's period covers the same words
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _words_of(data, offsets, separators):
    """Words as an Arrow array and each row's first word number."""
    starts, ends, first = W.word_spans(data, offsets, separators)
    sizes = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = data[~separators[data]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(letters)])
    return words, first


def periodic_extension(doc_id, n: int):
    """The contract's edit of a document's words: ``(a, p)``, or None for no edit."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    return None if h % 10 else (a, 1 + (n - a) // (3 + g % 8))


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", extend=None) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, all ``runs`` (start, length, period by start,
    then period) and the ``collapsed`` text: words that a run holds behind its first
    period are dropped, the kept ones joined by one space.  ``extend(doc_id, n)`` may
    give ``(a, p)``: the words from ``a`` on are first replaced by repeats of ``p`` words."""
    run_type = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", run_type), T.StructField("collapsed", T.StringType())])
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for row, to, data, offsets in W.chunks(batch.column(1)):
                doc_ids = batch.column(0).slice(row, to - row)
                words, first = _words_of(data, offsets, W._SPACE)
                ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                source = np.arange(len(ids))
                if extend is not None:
                    for k, doc_id in enumerate(doc_ids.to_pylist()):
                        edit = extend(doc_id, int(first[k + 1] - first[k]))
                        if edit:
                            a, p = int(first[k]) + edit[0], edit[1]
                            source[a:first[k + 1]] = a + np.arange(first[k + 1] - a) % p
                    ids = ids[source]
                start, end, period = runs(ids, first)
                drop = np.zeros(len(ids) + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, end, -1)
                kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
                rows = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, first), pa.int64()), words.take(pa.array(source[kept])))
                texts = pc.binary_join(rows, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string())
                doc = np.searchsorted(first, start, "right") - 1
                fields = [pa.array(x, pa.int64()) for x in (start - first[doc], end - start, period)]
                found = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(to - row + 1)), pa.int32()),
                                                 pa.StructArray.from_arrays(fields, fields=list(out.field("runs").type.value_type)))
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(np.diff(first), pa.int64()), found, texts], schema=out)

    return arrow(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), run, schema)


def run_digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one (ties: smallest start, then
    period) and checksums of all runs and of the collapsed text."""
    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    nothing = hexed(b"")

    def run(batches):
        for batch in batches:
            rows = []
            texts = batch.column(2).cast(pa.binary())
            for i, got, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                lines = [(r["start"], r["length"], r["period"]) for r in got]
                s, l, p = min(lines, key=lambda r: (-r[1], r[0], r[2])) if lines else (None, None, None)
                listed = hexed("".join(f"{a},{b},{c}\n" for a, b, c in lines).encode()) if lines else nothing
                rows.append((i, len(lines), s, l, p, None if l is None else 1000 * l // p, listed, hexed(text.as_buffer())))
            names = [f.split()[0] for f in schema.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(8)], names=names)

    return arrow(found.select("doc_id", "runs", "collapsed"), run, schema)
