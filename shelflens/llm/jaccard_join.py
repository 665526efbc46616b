"""N-gram Jaccard join (operator 10): prefix-tree join of shingle sets.

Two documents link when ``100 * |A & B| >= 75 * |A | B|`` for their sets of
distinct 5-word shingles.  The join returns classes (documents with equal
sets), one row per document with its component, and never a pair list of a
whole group.  Steps, all distributed:

1. A set key per document; equal sets are one node from here on.
2. Document frequencies of shingles, by hash range: a set can have a partner
   only if at least 75 % of its shingles occur in another set.  The others are
   done.  Shingles travel as sorted, delta-coded hash blocks.
3. On the remaining sets the frequencies again give each its prefix in the
   global order (rarest first): linked sets share a shingle of both prefixes.
   Sets that share one are joined to candidate clusters.
4. Each cluster's sets meet in one task, or, beyond a bounded size, in one
   task per pair of blocks.  There the sets go into a trie in global order; a
   depth-first walk carries the overlaps with all sets still in reach, shared
   by everything below a node, and drops those that the remaining lengths
   rule out.  Sets already connected in the task are not compared again, so a
   task returns a forest, at most one edge per set.
5. Components of the edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens.llm import words as W
from shelflens.llm.common import arrow, components, ship, stash

SHINGLE = 5
NUM, DEN = 75, 100  # the least Jaccard similarity
LEVELS = 40  # frequency classes: floor(log2(df))
BUCKET_SHINGLES = 1_000_000  # of a hash range, about
SLICE_SHINGLES = 3_000_000  # of the sets that a task packs together
FREQUENCY_BITS = 40
FILTER_BITS = 1 << 26  # of the filter that spares most texts a second shuffle: 8 MiB whatever the input
BLOCK_SHINGLES = 4_000_000  # of a cluster's block that meets another in one task, about


def least_overlap(n):
    """Fewest shingles that a set of n must share with any partner."""
    return -(-n * NUM // DEN)


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


# -- 1 -------------------------------------------------------------------------
def set_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, n_shingles, merged, node)``: node is the set's key, null for an empty
    set; ``merged`` of its shingles have the upper FREQUENCY_BITS bits of another one."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("merged", T.LongType()), T.StructField("node", T.LongType())])
    cut = np.uint64(64 - FREQUENCY_BITS)

    def run(batches):
        for batch in batches:
            n, merged, key = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for row, to, hashes, first in W.word_hashes(batch.column(1)):
                for k in range(to - row):
                    s = W.shingle_set(hashes[first[k]:first[k + 1]], SHINGLE)
                    if len(s):
                        short = s >> cut
                        n[row + k], merged[row + k], key[row + k] = len(s), int((short[1:] == short[:-1]).sum()), set_key(s)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(merged), pa.array(key, pa.int64())], names=schema.names)

    return arrow(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), run, schema)


def _text_sets(batches):
    """(node, set) of each text of an Arrow column."""
    for batch in batches:
        for row, to, hashes, first in W.word_hashes(batch.column(0)):
            for k in range(to - row):
                s = W.shingle_set(hashes[first[k]:first[k + 1]], SHINGLE)
                if len(s):
                    yield set_key(s), s


def _kept_sets(batches):
    for batch in batches:
        for node, s in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield node, np.frombuffer(s.as_buffer(), np.uint64)


# -- 2, 3: blocks of shingles by hash range ------------------------------------
def _pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as deltas of 1 to 8 bytes: widths, then bytes by width."""
    delta = np.diff(values, prepend=np.uint64(0))
    width = np.maximum(1, (64 - _leading(delta) + 7) // 8).astype(np.uint8)
    raw = delta.astype("<u8").view(np.uint8).reshape(-1, 8)
    return width.tobytes() + b"".join(np.ascontiguousarray(raw[width == w, :w]).tobytes() for w in range(1, 9))


def _leading(x: np.ndarray) -> np.ndarray:
    zeros, left = np.full(len(x), 64, np.int64), x.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = left >> np.uint64(step) > 0
        zeros[big] -= step
        left = np.where(big, left >> np.uint64(step), left)
    return zeros - (left > 0)


def _unpack(data: bytes, n: int) -> np.ndarray:
    width = np.frombuffer(data, np.uint8, n)
    out, at = np.zeros((n, 8), np.uint8), n
    for w in range(1, 9):
        mine = width == w
        size = int(mine.sum()) * w
        out[mine, :w] = np.frombuffer(data, np.uint8, size, at).reshape(-1, w)
        at += size
    return np.cumsum(out.view("<u8").reshape(-1).astype(np.uint64), dtype=np.uint64)


_BLOCK = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("n", T.IntegerType()),
                       T.StructField("shingles", T.BinaryType()), T.StructField("owners", T.BinaryType()),
                       T.StructField("nodes", T.BinaryType()), T.StructField("levels", T.BinaryType())])


def shingle_blocks(sets_of, ranges: int):
    """mapInArrow function: per slice of sets and hash range one row with the
    sorted shingles, their owners (numbers in the slice) and the owners' nodes.
    Only the upper FREQUENCY_BITS bits of the hashes travel.  Shingles of two sets
    that fall together look shared, which keeps a set in the running that would else
    be out; shingles of one set that fall together are counted once, and ``merged``
    makes up for them wherever a number of shingles is compared.  A task sends a
    set's copies once."""
    step = (1 << FREQUENCY_BITS) // ranges + 1
    cut = np.uint64(64 - FREQUENCY_BITS)

    def rows(held):
        nodes = np.array([h[0] for h in held], np.int64)
        levels = np.array([h[2] for h in held], np.uint8)
        shingles = np.concatenate([h[1] for h in held]) >> cut
        owners = np.repeat(np.arange(len(held), dtype=np.uint16), [len(h[1]) for h in held])
        order = np.argsort(shingles, kind="stable")
        shingles, owners = shingles[order], owners[order]
        cuts = np.searchsorted(shingles, [np.uint64(k * step) for k in range(ranges)]).tolist() + [len(shingles)]
        for k in range(ranges):
            a, b = cuts[k], cuts[k + 1]
            if b > a:
                used, mine = np.unique(owners[a:b], return_inverse=True)
                yield {"range": k, "n": b - a, "shingles": _pack(shingles[a:b]), "owners": mine.astype("<u2").tobytes(),
                       "nodes": nodes[used].tobytes(), "levels": levels[used].tobytes()}

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow_schema, held, size, sent = to_arrow_schema(_BLOCK), [], 0, set()
        for item in sets_of(batches):
            node, s = item[0], item[1]
            if node in sent:
                continue
            sent.add(node)
            held.append((node, s, item[2] if len(item) > 2 else 0))
            size += len(s)
            if size >= SLICE_SHINGLES or len(held) >= 60_000:
                for r in rows(held):  # one range at a time: small batches
                    yield pa.RecordBatch.from_pylist([r], arrow_schema)
                held, size = [], 0
        if held:
            for r in rows(held):
                yield pa.RecordBatch.from_pylist([r], arrow_schema)

    return run


def _ranges(batches):
    """(shingles, nodes, level limits, starts of equal shingles) per hash range;
    each (shingle, node) once, sorted by shingle.  Ranges come one after another;
    copies that other tasks sent are dropped while a range is being gathered."""
    held, now, size, kept = [], None, 0, 0

    def distinct():
        shingles = np.concatenate([h[0] for h in held])
        nodes = np.concatenate([h[1] for h in held])
        limits = np.concatenate([h[2] for h in held])
        order = np.lexsort((nodes, shingles))
        shingles, nodes, limits = shingles[order], nodes[order], limits[order]
        new = np.ones(len(shingles), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (nodes[1:] != nodes[:-1])  # copies of a set count once
        return shingles[new], nodes[new], limits[new]

    def joined():
        shingles, nodes, limits = distinct()
        return shingles, nodes, limits, np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1]))

    for batch in batches:
        for r in zip(*(batch.column(k) for k in range(6))):
            part, n = r[0].as_py(), r[1].as_py()
            if now is not None and part != now:
                yield joined()
                held, size, kept = [], 0, 0
            now = part
            owners = np.frombuffer(r[3].as_buffer(), "<u2")
            held.append((_unpack(r[2].as_buffer(), n), np.frombuffer(r[4].as_buffer(), np.int64)[owners],
                         np.frombuffer(r[5].as_buffer(), np.uint8)[owners]))
            size += n
            if size > 2 * max(kept, BUCKET_SHINGLES):
                held = [distinct()]
                size = kept = len(held[0][0])
    if held:
        yield joined()


def _levels(starts, total):
    df = np.diff(np.append(starts, total))
    return df, np.minimum(np.floor(np.log2(df)).astype(np.int64), LEVELS - 1)


def _histograms(batches):
    """Per range and node: how many of its shingles lie in each frequency class
    from the second on (a class per column would be mostly zeros: (node, level, n) rows)."""
    for shingles, nodes, _, starts in _ranges(batches):
        df, level = _levels(starts, len(shingles))
        each = np.repeat(level, df)
        many = np.repeat(df, df) > 1
        if not many.any():
            continue
        nodes, each = nodes[many], each[many]
        order = np.lexsort((each, nodes))
        nodes, each = nodes[order], each[order]
        first = np.flatnonzero(np.append(True, (nodes[1:] != nodes[:-1]) | (each[1:] != each[:-1])))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[first]), pa.array(each[first] + (each[first] == 0), pa.int64()),
                                          pa.array(np.diff(np.append(first, len(nodes))), pa.int64())], names=["node", "level", "n"])


def _stars(batches):
    """Edges from the smallest node to every other node with the same prefix shingle."""
    for shingles, nodes, limits, starts in _ranges(batches):
        df, level = _levels(starts, len(shingles))
        keep = (np.repeat(df, df) > 1) & (np.repeat(level, df) <= limits)
        shingles, nodes = shingles[keep], nodes[keep]
        if not len(nodes):
            continue
        first = np.append(True, shingles[1:] != shingles[:-1])
        centre = nodes[first][np.cumsum(first) - 1]  # nodes are sorted within a shingle
        pairs = np.unique(np.stack([centre, nodes], 1)[centre != nodes], axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _by_range(source: DataFrame, sets_of, total: int, then, schema: str) -> DataFrame:
    """Send the shingles of ``source``'s sets to their hash ranges and apply ``then``."""
    ranges = max(1, -(-total // BUCKET_SHINGLES))
    blocks = arrow(source, shingle_blocks(sets_of, ranges), _BLOCK)
    return arrow(blocks.repartition(ranges, "range").sortWithinPartitions("range"), then, schema)


def frequency_classes(source: DataFrame, sets_of, total: int) -> DataFrame:
    """``(node, seen, classes)``: its shingles that occur in other sets, and
    their number per frequency class (map level -> n)."""
    rows = _by_range(source, sets_of, total, _histograms, "node long, level long, n long")
    return (rows.groupBy("node", "level").agg(F.sum("n").alias("n")).groupBy("node")
            .agg(F.sum("n").alias("seen"), F.sort_array(F.collect_list(F.struct("level", "n"))).alias("classes")))


# -- 4: trie join in a task ----------------------------------------------------
def trie_join(sets: list[np.ndarray], other: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Edges of a forest that connects every two linked sets of ``sets`` (with
    ``other``: every linked set and other set, numbered after ``sets``)."""
    queries = sets if other is None else other
    base = 0 if other is None else len(sets)
    everything = sets if other is None else [*sets, *other]
    size = np.array([len(s) for s in everything], np.int64)
    flat = np.concatenate(everything)
    _, inverse, uses = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(everything)), size)
    shared = uses[inverse] > 1  # the others cannot overlap; sizes keep counting them
    rank = np.empty(len(uses), np.int64)
    rank[np.lexsort((np.arange(len(uses)), uses))] = np.arange(len(uses))  # the global order: rarest first
    token, owner = rank[inverse[shared]], owner[shared]
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(everything) + 1))
    lists = [token[first[k]:first[k + 1]] for k in range(len(everything))]
    # postings of the queries
    q_from, q_to = first[base], first[base + len(queries)]
    by_token = np.argsort(token[q_from:q_to], kind="stable")
    posting_token, posting = token[q_from:q_to][by_token], (owner[q_from:q_to] - base)[by_token]
    q_size = size[base:base + len(queries)]
    q_shared = np.array([len(x) for x in lists[base:base + len(queries)]], np.int64)

    ranked = sorted((k for k in range(len(sets)) if len(lists[k])), key=lambda k: lists[k].astype(">u4").tobytes())
    if not ranked or not len(posting):
        return []
    common = np.zeros(len(ranked), np.int64)  # with the one before
    for k in range(1, len(ranked)):
        a, b = lists[ranked[k - 1]], lists[ranked[k]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        common[k] = differ[0] if len(differ) else m
    leaf = np.array(ranked)
    leaf_size, leaf_len = size[leaf], np.array([len(lists[k]) for k in ranked])
    label = np.arange(len(everything))
    members = {k: [k] for k in range(len(everything))}
    edges = []

    def link(a, b):
        a, b = label[a], label[b]
        if len(members[a]) < len(members[b]):
            a, b = b, a
        label[members[b]] = a
        members[a] += members.pop(b)

    def need(q, least):  # fewest shared shingles with a set of at least this size
        return -(-NUM * (q + least) // (NUM + DEN))

    stack = [(0, len(ranked), 0, np.arange(len(queries)), np.zeros(len(queries), np.int64))]
    while stack:
        lo, hi, depth, alive, overlap = stack.pop()
        least, most = leaf_size[lo:hi].min(), leaf_size[lo:hi].max()
        inside = label[leaf[lo]]
        if hi - lo == 1 or (label[leaf[lo:hi]] == inside).all():  # one component below: its members have nothing to find here
            free = label[alive + base] != inside
            alive, overlap = alive[free], overlap[free]
        if not len(alive):
            continue
        end = int(leaf_len[lo]) if hi - lo == 1 else int(common[lo + 1:hi].min())
        edge, deepest = lists[leaf[lo]][depth:end], int(leaf_len[lo:hi].max())
        where = np.full(len(queries), -1, np.int64)
        # along the edge in two steps: after the first, sets without any overlap are out of reach
        cut = max(0, min(len(edge), deepest - int(need(int(least * NUM // DEN), int(least))) + 1 - depth)) if depth == 0 else len(edge)
        at = depth
        for piece in (edge[:cut], edge[cut:]):
            if not len(alive):
                break
            if len(piece):
                a, b = np.searchsorted(posting_token, piece), np.searchsorted(posting_token, piece, "right")
                n = b - a
                if n.sum():
                    got = posting[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                    where[alive] = np.arange(len(alive))
                    got = where[got]
                    overlap = overlap + np.bincount(got[got >= 0], minlength=len(alive))
                    where[alive] = -1
                at += len(piece)
            q = q_size[alive]
            reach = overlap + np.minimum(deepest - at, q_shared[alive] - overlap)
            ok = (reach >= need(q, least)) & (DEN * q >= NUM * least) & (NUM * q <= DEN * most)
            alive, overlap = alive[ok], overlap[ok]
        if not len(alive):
            continue
        if hi - lo == 1:
            k = int(leaf[lo])
            q = q_size[alive]
            linked = DEN * overlap >= NUM * (q + size[k] - overlap)
            for x in alive[linked] + base:
                if x != k and label[x] != label[k]:
                    edges.append((k, int(x)))
                    link(k, x)
            continue
        splits = np.append(np.flatnonzero(common[lo + 1:hi] == end) + lo + 1, hi)
        start = lo
        for stop in splits:
            stack.append((start, int(stop), end, alive, overlap))
            start = int(stop)
    return edges


def _join_clusters(batches):
    """Trie joins of consecutive rows with one key (cluster, i, j)."""
    held, now = [], None

    def edges():
        # block of each set: 0 for block i of the task, 1 for block j
        left = [(n, s) for b, n, s in held if b == 0]
        right = [(n, s) for b, n, s in held if b == 1]
        if right:
            nodes = [n for n, _ in left + right]
            found = trie_join([s for _, s in left], [s for _, s in right]) if left else []
        else:
            nodes = [n for n, _ in left]
            found = trie_join([s for _, s in left]) if len(left) > 1 else []
        return [(nodes[a], nodes[b]) for a, b in found]

    def batch_of(pairs):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    for batch in batches:
        cluster, i, j, side, node = (batch.column(k).to_pylist() for k in range(5))
        for k in range(batch.num_rows):
            key = (cluster[k], i[k], j[k])
            if now is not None and key != now:
                if pairs := edges():
                    yield batch_of(pairs)
                held = []
            now = key
            held.append((side[k], node[k], np.frombuffer(batch.column(5)[k].as_py(), np.uint64)))
    if held and (pairs := edges()):
        yield batch_of(pairs)


def node_filter(nodes: DataFrame):
    """A test that is true for every node of the table and false for most others
    (as long as there are fewer than about FILTER_BITS nodes; beyond that it lets
    all through, and only the shuffle it saves is lost).  The driver and the
    workers hold FILTER_BITS bits, a fixed size."""
    # nodes are hashes already: two separate stretches of their bits
    place = [F.pmod(F.shiftright("node", k), F.lit(FILTER_BITS)) for k in (0, 32)]
    bits = nodes.select(F.explode(F.array(*place)).alias("p")).select((F.col("p") / 32768).cast("int").alias("page"), (F.col("p") % 32768).alias("bit"))
    pages = bits.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # at most FILTER_BITS / 32768 rows
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in pages:
        table[r["page"] * 4096:r["page"] * 4096 + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), np.uint8)
    raw = table.tobytes()

    def maybe(node: int) -> bool:
        for k in (0, 32):
            p = (node >> k) % FILTER_BITS
            if not raw[p >> 3] >> (p & 7) & 1:
                return False
        return True

    return maybe


def linked_sets(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect all linked sets.  ``texts(doc_id, text)``;
    ``nodes(node, doc_id, n_shingles, merged)``: one document of each distinct set."""
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    seen = frequency_classes(texts.select("text"), _text_sets, total)
    n = F.col("n_shingles")
    fewest = F.ceil(n * F.lit(NUM) / F.lit(DEN))
    enough = F.col("seen") + F.col("merged") >= fewest
    some = stash(nodes.join(seen.select("node", "seen"), "node").where(enough).select("node", "doc_id", "n_shingles", "merged"), "may-link")
    maybe = node_filter(some)

    def to_sets(batches):
        sent = set()  # copies of a set are sent once a task
        for node, s in _text_sets(batches):
            if node in sent or not maybe(node):
                continue
            sent.add(node)
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([s.tobytes()], pa.binary())], names=["node", "shingles"])

    def gathered(batches):  # fewer, larger batches
        held, size = [], 0
        for b in to_sets(batches):
            held.append(b)
            size += b.nbytes
            if size > 4 << 20:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    # the join drops what the filter let through in error
    found = arrow(texts.select("text"), gathered, "node long, shingles binary")
    sets = stash(found.join(some.select("node", "n_shingles", "merged"), "node").groupBy("node")
                 .agg(F.min("shingles").alias("shingles"), F.min("n_shingles").alias("n_shingles"), F.min("merged").alias("merged")), "sets")

    # rarest-first prefix of each remaining set: frequency classes up to a limit
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    again = frequency_classes(sets.select("node", "shingles"), _kept_sets, total)
    prefix = n - fewest + 1  # a linked set shares one of these
    alone = n - F.col("merged") - F.col("seen")  # and maybe some of the merged ones
    steps = F.aggregate("classes", F.struct(alone.alias("had"), F.lit(-1).cast("long").alias("upto")), lambda acc, c: F.struct(
        (acc["had"] + c["n"]).alias("had"), F.when(acc["had"] >= prefix, acc["upto"]).otherwise(c["level"]).alias("upto")))
    limited = stash(sets.join(again, "node").where(enough)
                    .select("node", "shingles", "n_shingles", steps["upto"].cast("int").alias("upto")), "prefixes")

    def with_limits(batches):
        for batch in batches:
            for node, s, upto in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                yield node, np.frombuffer(s.as_buffer(), np.uint64), max(upto, 0)

    stars = _by_range(limited.select("node", "shingles", "upto"), with_limits, total, _stars, "a long, b long")
    clusters = components(stars)

    # clusters in blocks of bounded size; every pair of blocks is a task's work
    in_cluster = stash(limited.join(clusters, "node").select("node", "shingles", "n_shingles", "component"), "clustered")
    blocks = in_cluster.groupBy("component").agg(F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = (in_cluster.join(stash(blocks, "blocks"), "component")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    tasks = placed.select("component", "block", "node", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    tasks = tasks.select("component", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"),
                         (F.col("block") > F.col("o")).cast("int").alias("side"), "node", "shingles")
    tasks = tasks.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    return arrow(tasks, _join_clusters, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest
    id reachable by links).  Null and word-less texts have an empty set and are
    linked with nothing; repeated rows are members of one class; null ids are
    kept and never name a component that has another id.  An empty table gives
    an empty result."""
    ship(df.sparkSession)
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    keyed = stash(set_keys(texts, "doc_id", "text"), "set-keys")
    nodes = stash(keyed.where("node is not null").groupBy("node")
                  .agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"), F.min("merged").alias("merged")), "nodes")
    joined = components(linked_sets(texts, nodes))
    linked = stash(nodes.join(joined, "node").select("node", "doc_id", "component"), "linked")
    smallest = stash(linked.groupBy("component").agg(F.min("doc_id").alias("smallest")), "smallest")
    # sets without a link stay out of the join by component
    named = stash(linked.join(smallest, "component").select("node", F.coalesce("smallest", "doc_id").alias("component_id"))
                  .unionAll(nodes.join(joined, "node", "left_anti").select("node", F.col("doc_id").alias("component_id"))), "named")
    # a group of copies may hold a third of the rows: both sides are plain tables, so AQE can split its node
    return (keyed.join(named, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
