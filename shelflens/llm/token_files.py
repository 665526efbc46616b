"""Token-ID files (operator 4): canonical length-limited Huffman coding.

A token file is a folder of three Parquet tables (Parquet is the container,
so any store that Spark reads and writes will do):

* ``codebook``: one row per used id: ``id, uses, bits``.  Code lengths come
  from the ids' global counts by package-merge under a length limit; canonical
  codes follow from the lengths alone (shorter first, then by id).
* ``blocks``: one row per independent block of whole documents: their ids and
  token counts, the bit string, and the bit length of every ``CHECKPOINT``
  tokens, i.e. bit-offset checkpoints from which decoding can start anywhere.
* ``parts``: token and document offsets of each sorted partition.

Decoding looks up ``limit`` bits at a time in a table of 2**limit entries and
advances all checkpoints of a block side by side.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm.common import arrow, scratch_dir, stash

CHECKPOINT = 64  # tokens between bit-offset checkpoints
BLOCK_TOKENS = 1 << 16  # a block is closed once it holds as many
LIMIT = 16  # bits of the longest code, more only if the vocabulary needs it
CACHE = 1_000_000  # units whose ids a Python worker keeps
LEARN = 500  # new units tokenized in one text
CHUNK_CHARS = 4 << 20  # of texts whose units are looked up together

# White space of the byte-level pre-tokenizer.  A token holds white space only
# at its beginning, so a text may be cut before any run of white space.
_WS = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_RARE = [c for c in _WS if c not in " \n"]
_RARE_ASCII = [c for c in _RARE if c.isascii()]
_RUNS = ["  ", "\n\n", " \n", "\n "]
_MARKS = ".,;:!?)"  # units of their own where they end a word of letters
_encoders: dict = {}


def pieces(array) -> list[bytes]:
    """The values of a large binary array (without nulls)."""
    cuts = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1].tolist()
    raw = array.buffers()[2].to_pybytes() if cuts[-1:] != [0] else b""
    return [raw[i:j] for i, j in zip(cuts, cuts[1:])]


class _Encoder:
    """ids of texts by way of their units, words with the white space before them:
    each distinct unit goes through the tokenizer once per Python worker, thousands
    of new ones in one text.  A text that holds an added token (such as the end of
    text) goes through the tokenizer as a whole, which finds it as the library does."""

    def __init__(self, path: str, dtype: str, end_id: int | None = None):
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype, self.end_id = Tokenizer.from_file(path), dtype, end_id
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.together = LEARN if not any(c in t for t in self.added for c in _WS) else 1
        self.opens = np.zeros(vocabulary_size(path), bool)  # tokens whose first byte is a space or a line feed
        for piece, k in self.tokenizer.get_vocab().items():
            self.opens[k] = piece[0] in "\u0120\u010a"
        self.feed = len(self._ids("\n"))
        self.marks = {m.encode(): self._ids(m) for m in _MARKS
                      if all(np.array_equal(self._ids(w + m + " b"), np.concatenate([self._ids(w), self._ids(m), self._ids(" b")])) for w in ("a", " Ab", "\nX"))}
        self.is_mark, self.is_letter = np.zeros(256, bool), np.zeros(256, bool)
        self.is_mark[[m[0] for m in self.marks]] = True
        self.is_letter[[*range(65, 91), *range(97, 123)]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        # ids of all units one after another, and where each one's end; unit 0 closes a document
        self.flat = np.array([] if self.end_id is None else [self.end_id], self.dtype)
        self.ends = np.array([len(self.flat)], np.int64)
        self._new: list = []
        for mark, ids in self.marks.items():
            self.known[mark] = self._add(ids, np.array([len(ids)]))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)  # no offsets

    def _add(self, ids: np.ndarray, sizes) -> int:
        """Append units with the given numbers of ids; the first one's number."""
        first = len(self.ends) + sum(len(s) for _, s in self._new)
        self._new.append((ids, sizes))
        return first

    def _settle(self) -> None:
        if self._new:
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in self._new)])
            sizes = np.concatenate([s for _, s in self._new])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self._new = []

    def _learn(self, units: list[bytes]) -> None:
        """Units with one space or line feed before them: the tokens that open with it cut their ids."""
        for k in range(0, len(units), self.together):
            some = units[k:k + self.together]
            ids = self._ids(b"".join(some).decode())
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(some) and at[0] == 0:
                first = self._add(ids, np.diff(np.append(at, len(ids))))
                self.known.update(zip(some, range(first, first + len(some))))
            else:  # another pre-tokenizer: one by one
                for unit in some:
                    ids = self._ids(unit.decode())
                    self.known[unit] = self._add(ids, np.array([len(ids)]))

    def _numbers(self, units: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, units))
        new = [k for k, number in enumerate(found) if number is None]
        self._learn([units[k] for k in new])
        for k in new:
            found[k] = self.known[units[k]]
        return np.array(found, np.int64)

    def _plain(self, texts) -> list[np.ndarray]:
        """Unit numbers of texts with one space or line feed between any two words, each
        with a line feed put before it: every unit starts at one of these bytes, or is a
        mark between a letter and one of them."""
        rows = [b"\n" + t.encode() for t in texts]
        raw = b"".join(rows)
        data = np.frombuffer(raw, np.uint8)
        opens = (data == 32) | (data == 10)
        ends = np.append(opens[1:], True)  # the next byte opens a unit
        ends[0] = False
        ends[1:] &= self.is_mark[data[1:]] & self.is_letter[data[:-1]]
        starts = np.flatnonzero(opens | ends)
        cuts = np.append(starts, len(data)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
        numbers = self._numbers(pieces(coded.dictionary))[coded.indices.to_numpy()]
        return np.split(numbers, np.searchsorted(starts, np.cumsum([len(r) for r in rows])[:-1]))

    def _odd(self, text: str) -> np.ndarray:
        """Unit numbers of a text with other white space or with an added token in it."""
        if any(t in text for t in self.added):
            ids = self._ids(text)
            return np.array([self._add(ids, np.array([len(ids)]))])
        out = []
        for unit in _UNIT.findall(text):
            key = b"\0" + unit.encode()  # apart from the plain texts' units
            if key not in self.known:
                ids = self._ids(unit)
                self.known[key] = self._add(ids, np.array([len(ids)]))
            out.append(self.known[key])
        return np.array(out, np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, each text's closed by ``end_id``, and the
        place where each one's start (and the last one's end)."""
        if len(self.known) > CACHE:
            self._clear()
        plain, numbers = [], [np.zeros(0, np.int64)] * len(texts)
        for k, text in enumerate(texts):
            if not text:
                continue
            if (text[0] in _WS or text[-1] in _WS or any(r in text for r in _RUNS)
                    or any(c in text for c in (_RARE_ASCII if text.isascii() else _RARE)) or any(t in text for t in self.added)):
                numbers[k] = self._odd(text)
            else:
                plain.append(k)
        if plain:
            for k, units in zip(plain, self._plain([texts[k] for k in plain])):
                numbers[k] = units
        self._settle()
        count = np.array([len(x) for x in numbers], np.int64)
        last = np.cumsum(count + 1)  # each text's units and the unit that closes it
        unit = np.zeros(int(last[-1]) if len(last) else 0, np.int64)
        body = np.ones(len(unit), bool)
        body[last - 1] = False
        unit[body] = np.concatenate(numbers) if numbers else 0
        start = np.concatenate([[0], self.ends])[unit]
        size = self.ends[unit] - start
        lead = (last - count - 1)[plain]  # the line feed before a plain text is not its own
        start[lead] += self.feed
        size[lead] -= self.feed
        total = np.cumsum(size)
        at = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - total + size, size)
        return self.flat[at], np.concatenate([[0], total[last - 1]]) if len(last) else np.zeros(1, np.int64)


def _encoder(path, dtype, end_id):
    if (path, dtype, end_id) not in _encoders:
        _encoders[path, dtype, end_id] = _Encoder(path, dtype, end_id)
    return _encoders[path, dtype, end_id]


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path).get_vocab_size()


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def tokenize(df: DataFrame, tokenizer_path: str, end_id: int | None = 0,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)``: ids as little-endian integers of ``id_type``
    width, exactly the library's (its defaults, no special tokens added).

    A null or empty text has no ids of its own; ``end_id`` closes each document;
    repeated rows and null ids stay rows of their own; other columns are ignored
    whatever their names; an empty table gives an empty table."""
    dtype = id_type(vocabulary_size(tokenizer_path))
    width = np.dtype(dtype).itemsize

    def run(batches):
        encoder = _encoder(tokenizer_path, dtype, end_id)
        for batch in batches:
            texts, a, chars = batch.column(1).to_pylist(), 0, 0
            for b, text in enumerate(texts, 1):
                chars += len(text or "")
                if chars < CHUNK_CHARS and b < len(texts):
                    continue
                stream, at = encoder.encode(texts[a:b])
                ids = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(at * width), pa.py_buffer(stream)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(at), pa.int64()), ids.cast(pa.binary())],
                                                 names=["doc_id", "n_tokens", "ids"])
                a, chars = b, 0

    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return arrow(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), run, schema)


def id_counts(tokens: DataFrame, vocabulary: int, slices: int = 64) -> DataFrame:
    """``(id, uses)`` over all documents.  Each task counts its rows into one
    vector and ships it in slices; a slice's vectors are added as they stream."""
    dtype, step = id_type(vocabulary), -(-vocabulary // slices)

    def count(batches):
        total = np.zeros(step * slices, np.int64)
        for batch in batches:
            ids = batch.column(0)
            if len(ids) and ids.buffers()[2] is not None:  # all rows' ids lie one after another
                ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
                raw = np.frombuffer(ids.buffers()[2], np.uint8)[ends[0]:ends[-1]]
                total += np.bincount(np.frombuffer(raw.tobytes(), dtype), minlength=len(total))
        cut = total.reshape(slices, step)
        used = np.flatnonzero(cut.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([cut[k].tobytes() for k in used], pa.binary())],
                                         names=["slice", "uses"])

    def add(batches):
        total: dict = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(x, np.int64)
        for k, x in total.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(at + k * step, pa.int64()), pa.array(x[at], pa.int64())], names=["id", "uses"])

    counted = arrow(tokens.select("ids"), count, "slice int, uses binary")
    return arrow(counted.repartition(slices, "slice"), add, "id long, uses long")


def code_lengths(uses, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge)."""
    uses = np.asarray(uses, np.int64)
    n = len(uses)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.ones(1, np.int64)
    limit = max(limit, (n - 1).bit_length())
    order = np.argsort(uses, kind="stable")
    leaves = uses[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)  # which of the level's items are leaves
        both = both[rank]
        pairs = len(both) // 2 * 2
        packages = both[0:pairs:2] + both[1:pairs:2]
    depth, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        leaf = int(is_leaf[:take].sum())
        depth[:leaf] += 1
        take = 2 * (take - leaf)
    out = np.empty(n, np.int64)
    out[order] = depth
    return out


def canonical_codes(bits) -> np.ndarray:
    """Codes of the given lengths: shorter first, then in the given order."""
    bits = np.asarray(bits, np.int64)
    order = np.lexsort((np.arange(len(bits)), bits))
    codes, code, last = np.zeros(len(bits), np.uint64), 0, 0
    for k in order:
        code <<= int(bits[k]) - last
        last = int(bits[k])
        codes[k] = code
        code += 1
    return codes


def encode_block(ids: np.ndarray, code_of: np.ndarray, bits_of: np.ndarray) -> tuple[bytes, bytes]:
    """Bit string, and bit lengths of every CHECKPOINT tokens (uint16)."""
    bits = bits_of[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 2, np.uint64)
    at, room = starts >> 5, 64 - (starts & 31) - bits
    value = code_of[ids] << room.astype(np.uint64)  # codes have at most 32 bits
    for k, half in ((0, value >> np.uint64(32)), (1, value & np.uint64(0xFFFFFFFF))):
        words += np.bincount(at + k, half.astype(np.float64), len(words)).astype(np.uint64)  # no bits overlap: exact sums
    payload = words.astype(">u4").tobytes()[:-(-total // 8)]
    marks = np.concatenate([starts[::CHECKPOINT], [total]])
    return payload, np.diff(marks).astype("<u2").tobytes()


def decode_block(payload: bytes, marks: bytes, n: int, limit: int, id_of, bits_of) -> np.ndarray:
    """The n ids of a block; ``id_of``/``bits_of`` have 2**limit entries."""
    lengths = np.frombuffer(marks, "<u2").astype(np.int64)
    at = np.cumsum(lengths) - lengths
    data = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    ahead = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]  # 32 bits from each byte on
    out = np.zeros((CHECKPOINT, len(at)), np.uint32)
    shift, mask, last = 32 - limit, (1 << limit) - 1, n - (len(at) - 1) * CHECKPOINT
    for k in range(CHECKPOINT):
        live = len(at) if k < last else len(at) - 1  # the last stretch may be short
        if not live:
            break
        p = at[:live]
        window = (ahead[p >> 3] >> (shift - (p & 7)).astype(np.uint32)) & np.uint32(mask)
        out[k, :live] = id_of[window]
        p += bits_of[window]
    return out.T.reshape(-1)[:n]


def _decode_table(ids, bits):
    limit = max(1, int(bits.max())) if len(bits) else 1
    if limit > 24:
        raise ValueError("codes over 24 bits")
    codes = canonical_codes(bits).astype(np.int64)
    id_of, bits_of = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
    for i, b, c in zip(ids, bits, codes):
        lo, hi = c << (limit - b), (c + 1) << (limit - b)
        id_of[lo:hi], bits_of[lo:hi] = i, b
    return limit, id_of, bits_of


def write_token_file(tokens: DataFrame, path: str, vocabulary: int) -> str:
    """Write ``tokens(doc_id, n_tokens, ids)`` in ascending doc_id order (nulls
    first, ties by content).  ``tokens`` is read twice: pass a written table."""
    spark, dtype = tokens.sparkSession, id_type(vocabulary)
    # bounded by the vocabulary, not by the corpus
    counted = id_counts(tokens, vocabulary).orderBy("id").toArrow()
    ids, uses = counted.column("id").to_numpy(), counted.column("uses").to_numpy()
    bits = code_lengths(uses, LIMIT)
    spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "uses": pa.array(uses, pa.int64()),
                                    "bits": pa.array(bits, pa.int32())})).coalesce(1).write.parquet(f"{path}/codebook")
    code_of, bits_of = np.zeros(vocabulary, np.uint64), np.zeros(vocabulary, np.int64)
    code_of[ids], bits_of[ids] = canonical_codes(bits), bits
    id_arrow = tokens.schema["doc_id"].dataType

    def run(batches):
        part, block, start, docs, counts, pending, held = TaskContext.get().partitionId(), 0, 0, [], [], [], 0

        def close():
            stream = np.frombuffer(b"".join(pending), dtype)
            payload, marks = encode_block(stream, code_of, bits_of)
            return {"part": part, "block": block, "start": start, "doc_ids": list(docs), "n_tokens": list(counts),
                    "payload": payload, "marks": marks}

        for batch in batches:
            rows = []
            for d, n, x in zip(*(c.to_pylist() for c in batch.columns)):
                docs.append(d), counts.append(n), pending.append(x)
                held += n
                if held >= BLOCK_TOKENS:
                    rows.append(close())
                    block, start, docs, counts, pending, held = block + 1, start + held, [], [], [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow_schema)
        if docs:
            yield pa.RecordBatch.from_pylist([close()], arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
                           T.StructField("start", T.LongType()),  # in its part
                           T.StructField("doc_ids", T.ArrayType(id_arrow)), T.StructField("n_tokens", T.ArrayType(T.LongType())),
                           T.StructField("payload", T.BinaryType()), T.StructField("marks", T.BinaryType())])
    arrow_schema = to_arrow_schema(schema)
    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids")
    arrow(ordered, run, schema).write.parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (spark.read.parquet(f"{path}/blocks").select("part", F.explode("n_tokens").alias("n"))
            .groupBy("part").agg(F.sum("n").alias("tokens"), F.count("n").alias("documents")))
    # one row per sorted partition
    (sums.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first_token"),
                 F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("first_document"))
     .coalesce(1).write.parquet(f"{path}/parts"))
    return path


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` decoded from the files; ``ids`` are
    little-endian unsigned 32-bit, ``start`` counts the ids of all documents before.
    Whatever was written comes back: null ids, documents without ids (an empty
    binary), repeated rows; files without documents give no rows."""
    book = spark.read.parquet(f"{path}/codebook").toArrow()  # bounded by the vocabulary
    limit, id_of, bits_of = _decode_table(book.column("id").to_numpy(), book.column("bits").to_numpy())
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row per sorted partition: a proven bound for the broadcast
    placed = (blocks.join(F.broadcast(spark.read.parquet(f"{path}/parts")), "part")
              .withColumn("start", F.col("first_token") + F.col("start")))
    schema = T.StructType([T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType),
                           T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                start, docs, counts, payload, marks = (c[k].as_py() for c in batch.columns)
                total = sum(counts)
                stream = decode_block(payload, marks, total, limit, id_of, bits_of).astype("<u4") if total else np.zeros(0, "<u4")
                ends = np.cumsum(counts)
                ids = [stream[e - n:e].tobytes() for n, e in zip(counts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, arrow_schema.field(0).type), pa.array(start + ends - np.array(counts), pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], schema=arrow_schema)

    return arrow(placed.select("start", "doc_ids", "n_tokens", "payload", "marks"), run, schema)


def token_digest(df: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Tokenize, write, read back; per document its place and checksum.

    Order: doc_id, nulls first; rows of one id by length and content, so that equal
    rows are interchangeable.  Null, empty and repeated rows and clashing columns as
    in ``tokenize``; an empty table gives an empty file and no rows."""
    vocabulary = vocabulary_size(tokenizer_path)
    tokens = stash(tokenize(df, tokenizer_path, end_id), "tokens")
    path = write_token_file(tokens, scratch_dir(df.sparkSession, "token-file"), vocabulary)
    return (read_token_file(df.sparkSession, path)
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))


def crc32_of(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
