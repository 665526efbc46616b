"""Cross-tokenizer alignment (operator 13): tokenizer spans, refined by decoded bytes.

``A`` is a tokenizers file (byte-level BPE), ``B`` a sentencepiece model with byte
fallback; both see the same characters (``B`` puts a space before the text itself).
Coarse cuts are the places where a token's span of characters ends and the next
one's begins: ``A``'s character offsets, ``B``'s spans of its proto (this version of
sentencepiece gives them as ``return_type="proto"``; the immutable proto is
gone).  Between two coarse cuts, where several tokens share a multibyte
character or spell it in byte-fallback tokens, the lengths of the decoded bytes
refine the cuts.  Then the tokens' bytes are compared with the text.

Both tokenizers cut before a single space or line feed between words, so each
distinct word with the separator before it is aligned once per Python worker,
thousands in one text; a word whose ends are not token ends of both, and a text with
other white space, is aligned as a whole.  ``tests/llm`` compare with whole texts.

Counts: a chunk of documents (about ``CHUNK_CHARS`` characters) first sums its own
pairs; only its distinct pairs are shuffled to be counted and to fetch their
counts.  Null, empty and not restorable texts have no tokens; repeated rows
count as documents of their own; a null id is kept; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm.common import arrow, ship, stash
from shelflens.llm.periodic_runs import _ragged
from shelflens.llm.token_files import pieces

CHUNK_CHARS = 4 << 20  # of texts whose pairs are summed together
CACHE = 600_000  # words whose alignment a Python worker keeps
LEARN = 5000  # new words aligned in one text
PAIR = 1 << 32  # a pair's code: A id * PAIR + B id

# Texts with other white space than single spaces and line feeds between words, or
# with the mark that sentencepiece puts for a space, are aligned as wholes.
_OTHER = re.compile("  |\n\n| \n|\n |^[ \n]|[ \n]$|[\t\v\f\r\x1c-\x1f\x85\xa0  -     　▁]")
_aligners: dict = {}


def _byte_level() -> dict[str, int]:
    """Characters of a byte-level vocabulary -> bytes: printable Latin-1 stands for
    itself, the other bytes in order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def refine(start, end, size):
    """Byte ends of tokens from their coarse byte spans and decoded sizes: between two
    coarse cuts (the next token begins where all before have ended, the last of them
    with a span that is not empty) sizes add up."""
    n = len(size)
    if not n:
        return np.zeros(0, np.int64)
    reach = np.maximum.accumulate(end)
    cut = np.ones(n, bool)  # tokens that a coarse cut precedes
    cut[1:] = (start[1:] >= reach[:-1]) & (end[:-1] > start[:-1])
    of = np.cumsum(cut) - 1
    first = np.flatnonzero(cut)
    total = np.cumsum(size)
    return start[first][of] + total - (total - size)[first][of]


class Aligned:
    """Tokens of one text: ids and byte ends (in space + text) of both tokenizers."""

    def __init__(self, a, a_end, b, b_end):
        self.a, self.a_end, self.b, self.b_end = a, a_end, b, b_end
        self.cuts = np.intersect1d(a_end, b_end)  # where both end
        low = np.searchsorted(b_end, np.concatenate([[0], a_end[:-1]]), "right")  # first B token that ends behind A's start
        high = np.searchsorted(b_end, a_end, "left")  # the one that reaches its end
        at, of = _ragged(low, high - low + 1)
        self.links, self.link_end = a[of].astype(np.int64) * PAIR + b[at], np.minimum(a_end[of], b_end[at])

    def group_strings(self) -> list[str]:
        """``a1,a2|b1`` of each group."""
        x, y = np.searchsorted(self.a_end, self.cuts, "right"), np.searchsorted(self.b_end, self.cuts, "right")
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        out, i, j = [], 0, 0
        for p, q in zip(x.tolist(), y.tolist()):
            out.append(f"{','.join(a[i:p])}|{','.join(b[j:q])}")
            i, j = p, q
        return out


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(a_path)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        a_bytes = [b""] * self.tokenizer.get_vocab_size()
        for piece, k in self.tokenizer.get_vocab().items():
            a_bytes[k] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
        piece = self.model.id_to_piece
        b_bytes = [bytes([int(piece(k)[3:5], 16)]) if self.model.is_byte(k) else piece(k).replace("▁", " ").encode()
                   for k in range(self.model.get_piece_size())]
        self.bytes = (a_bytes, b_bytes)
        self.sizes = tuple(np.array([len(x) for x in y], np.int64) for y in self.bytes)
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.strings: list[str] = []  # groups of each word
        self.stats, self.pairs = [np.zeros((0, 4), np.int64)], [np.zeros(0, np.int64)]  # of each batch of words

    def align(self, text: str) -> Aligned | None:
        """None if the bytes of the tokens are not those of space + text."""
        raw = (" " + text).encode()
        found = self.tokenizer.encode(" " + text, add_special_tokens=False)
        a, spans = np.array(found.ids, np.int64), np.array(found.offsets, np.int64).reshape(-1, 2)
        byte_at = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))  # of each character
        a_end = refine(byte_at[spans[:, 0]], byte_at[spans[:, 1]], self.sizes[0][a])
        b, b_start, b_stop = self._pieces(text)
        b_end = refine(b_start, b_stop, self.sizes[1][b])
        for ids, end, token, size in ((a, a_end, self.bytes[0], self.sizes[0]), (b, b_end, self.bytes[1], self.sizes[1])):
            if b"".join([token[k] for k in ids.tolist()]) != raw or (np.diff(end, prepend=0) != size[ids]).any():
                return None
        return Aligned(a, a_end, b, b_end)

    def _pieces(self, text: str):
        """B's ids and byte spans in space + text."""
        found = self.model.encode(text, return_type="proto").pieces
        b = np.array([p.id for p in found], np.int64)
        start, stop = np.array([p.begin for p in found], np.int64) + 1, np.array([p.end for p in found], np.int64) + 1
        start[:1] = 0  # the space before the text
        return b, start, stop

    def _learn(self, units: list[bytes]) -> None:
        """Units: words with the space or line feed before them."""
        found = self.align("x" + b"".join(units).decode())
        stops = np.cumsum([2, *map(len, units)])
        if found is None or not np.isin(stops, found.cuts).all():
            if len(units) > 1:  # look for the odd ones
                half = len(units) // 2
                self._learn(units[:half])
                self._learn(units[half:])
            else:
                self.known[units[0]] = -1
            return
        strings = found.group_strings()
        at = [np.searchsorted(x, stops, "right") for x in (found.a_end, found.b_end, found.cuts, found.link_end)]
        self.stats.append(np.diff(np.stack(at, axis=1), axis=0))
        self.pairs.append(found.links[at[3][0]:])
        known = len(self.strings)
        self.known.update(zip(units, range(known, known + len(units))))
        cuts = at[2].tolist()
        self.strings += [";".join(strings[g:h]) for g, h in zip(cuts, cuts[1:])]

    def documents(self, texts):
        """Per text ``(n_a, n_b, n_groups, n_links, groups_sha256)``, and of all texts
        the distinct pairs of each: (place of the text, pair, occurrences)."""
        if len(self.known) > CACHE:
            self.clear()
        rows, keys, owner, weight, plain = [(0, 0, 0, 0, "")] * len(texts), [], [], [], []
        whole = []
        for k, text in enumerate(texts):
            if text:
                (whole if _OTHER.search(text) else plain).append(k)
        if plain:  # every word starts at a space or line feed, the first one at A's space
            raws = [b" " + texts[k].encode() for k in plain]
            raw = b"".join(raws)
            data = np.frombuffer(raw, np.uint8)
            starts = np.flatnonzero((data == 32) | (data == 10))
            cuts = np.append(starts, len(data)).astype(np.int64)
            coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
            units, at = pieces(coded.dictionary), coded.indices.to_numpy()
            new = [u for u in units if u not in self.known]
            for k in range(0, len(new), LEARN):
                self._learn(new[k:k + LEARN])
            number = np.array([self.known[u] for u in units], np.int64)
            self.stats, self.pairs = [np.concatenate(self.stats)], [np.concatenate(self.pairs)]
            stats, pairs = self.stats[0], self.pairs[0]
            pair_end = np.cumsum(stats[:, 3])
            first = np.searchsorted(starts, np.cumsum([0, *map(len, raws)]))  # each text's first unit
            place = np.repeat(np.arange(len(plain)), np.diff(first))
            odd = np.bincount(place, number[at] < 0, len(plain)) > 0  # texts with a word that no cut follows
            whole += [plain[k] for k in np.flatnonzero(odd)]
            sums = np.add.reduceat(stats[number[at]], first[:-1])
            strings = pa.array([self.strings[k] if k >= 0 else "" for k in number.tolist()], pa.large_string())
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), strings.take(pa.array(at))), pa.scalar(";", pa.large_string()))
            for k, (doc, total, text) in enumerate(zip(plain, sums.tolist(), joined.cast(pa.large_binary()))):
                if not odd[k]:
                    rows[doc] = (*total, hashlib.sha256(text.as_buffer()).hexdigest())
            sound = ~odd[place]
            both, many = np.unique(np.array(plain)[place[sound]] * (1 << 32) + number[at[sound]], return_counts=True)
            doc, unit = both >> 32, both & 0xFFFFFFFF
            at, of = _ragged((pair_end - stats[:, 3])[unit], stats[unit, 3])
            keys.append(pairs[at]), owner.append(doc[of]), weight.append(many[of])
        for k in whole:
            found = self.align(texts[k])
            if found is None:
                continue
            rows[k] = (len(found.a), len(found.b), len(found.cuts), len(found.links),
                       hashlib.sha256(";".join(found.group_strings()).encode()).hexdigest())
            pair, many = np.unique(found.links, return_counts=True)
            keys.append(pair), owner.append(np.full(len(pair), k)), weight.append(many)
        if not keys:
            nothing = np.zeros(0, np.int64)
            return rows, nothing, nothing, nothing, nothing
        distinct, pair = np.unique(np.concatenate(keys), return_inverse=True)
        both, place = np.unique(np.concatenate(owner) * len(distinct) + pair, return_inverse=True)
        total = np.bincount(place, np.concatenate(weight), len(both)).astype(np.int64)
        return rows, both // len(distinct), both % len(distinct), total, distinct


def _aligner(a_path, b_path) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


_STATS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned_chunks(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk of documents: their figures, their distinct pairs with the
    number of the chunk's documents that hold each, and which document holds which
    pair how often (``ends``, ``pair_at``, ``times``: little-endian 32-bit integers)."""
    doc = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in _STATS],
                        T.StructField("groups_sha256", T.StringType())])
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("docs", T.ArrayType(doc)),
                           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("held", T.ArrayType(T.LongType())),
                           *[T.StructField(c, T.BinaryType()) for c in ("ends", "pair_at", "times")]])
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(schema)
    doc_type = out.field("docs").type.value_type

    def run(batches):
        aligner, chunk = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32

        def close(ids, texts):
            rows, owner, pair, times, distinct = aligner.documents(texts)
            columns = [pa.array(ids, doc_type.field(0).type),
                       *[pa.array([r[k] for r in rows], doc_type.field(k + 1).type) for k in range(5)]]
            docs = pa.StructArray.from_arrays(columns, fields=[doc_type.field(k) for k in range(6)])
            whole = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t) if t else x)
            ends = np.searchsorted(owner, np.arange(len(ids)), "right")
            held = np.bincount(pair, minlength=len(distinct))
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), whole(docs, None), whole(distinct, pa.int64()), whole(held, pa.int64()),
                 *[pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (ends, pair, times)]], schema=out)

        ids, texts, chars = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i), texts.append(text)
                chars += len(text or "") + 50
                if chars >= CHUNK_CHARS:
                    yield close(ids, texts)
                    ids, texts, chars, chunk = [], [], 0, chunk + 1
        if ids:
            yield close(ids, texts)

    return arrow(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), run, schema)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked; whether that is the
    highest count of its A id (whose pairs, one window, are at most B's vocabulary)."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    counted = each.groupBy("pair").agg(F.sum("held").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align_documents(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its tokens, groups and links, and how its links stand in the corpus."""
    chunks = stash(aligned_chunks(df, a_path, b_path, id_col, text_col), "alignment")
    counts = stash(pair_counts(chunks), "pair-counts")
    # a chunk's distinct pairs only: at most one row per chunk and pair
    wanted = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair").select(F.col("chunk").alias("of_chunk"), "at", "n", "best")
    doc_type = chunks.schema["docs"].dataType.elementType
    schema = T.StructType([doc_type["doc_id"], *[T.StructField(c, T.LongType()) for c in (*_STATS, "n_best", "count_sum")], doc_type["groups_sha256"]])
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(schema)

    def figures(mine, fetched):
        docs = mine.column("docs").combine_chunks().flatten()
        ends, pair, times = (np.frombuffer(mine.column(c)[0].as_py(), "<u4").astype(np.int64) for c in ("ends", "pair_at", "times"))
        n, best = np.zeros(len(fetched), np.int64), np.zeros(len(fetched), np.int64)
        at = fetched.column("at").to_numpy()
        n[at], best[at] = fetched.column("n").to_numpy(), fetched.column("best").to_numpy()
        sums = []
        for value in (best, n):
            total = np.concatenate([[0], np.cumsum(times * value[pair])])
            sums.append(pa.array(np.diff(total[np.concatenate([[0], ends])]), pa.int64()))
        got = dict(zip([f.name for f in docs.type], docs.flatten())) | dict(zip(("n_best", "count_sum"), sums))
        return pa.Table.from_arrays([got[f.name] for f in out], schema=out)

    ship(df.sparkSession)
    slim = chunks.select("chunk", "docs", "ends", "pair_at", "times")
    return slim.groupBy("chunk").cogroup(wanted.groupBy("of_chunk")).applyInArrow(figures, schema)
