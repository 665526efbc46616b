"""t-SNE as Spark jobs: a neighbour graph, and iterations of joins and aggregates.

* Graph: ``3 * perplexity`` neighbours of each row (``neighbours.py``), their
  probabilities by bisection of the bandwidth, symmetrised by one aggregate.
* Attraction: the edges joined with the positions of both ends, summed per row.
* Repulsion: every row's charge is spread over the four nodes of its cell on a
  regular grid, one aggregate; the grid has at most ``GRID`` nodes a side whatever the
  number of rows (a proven bound for what the driver holds and broadcasts), its fields
  are convolutions, and every row reads its forces off the nodes of its cell.
* Step: momentum and gains as usual, positions written each iteration.

The start is the first two principal components, so no draw decides the picture.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.operators.neighbours import nearest_neighbours
from shelflens.operators.pca import pca
from shelflens.session import written

PERPLEXITY = 30.0
ITERATIONS, EXAGGERATION, EXAGGERATED = 60, 12.0, 0.25  # share of the iterations that exaggerate
GRID = 256  # nodes a side
FINEST = 0.25  # cell side, doubled while the picture does not fit on the grid
_STATE = "id long, y1 double, y2 double, u1 double, u2 double, g1 double, g2 double"


def probabilities(d2: np.ndarray, perplexity: float) -> np.ndarray:
    """Rows of neighbour probabilities of the given perplexity (``d2``: inf for none)."""
    low, high = np.zeros(len(d2)), np.full(len(d2), np.inf)
    beta = np.ones(len(d2))
    near = np.where(np.isfinite(d2), d2 - d2.min(axis=1, keepdims=True), np.inf)
    finite = np.where(np.isfinite(near), near, 0.0)
    target = np.log(np.minimum(perplexity, np.isfinite(d2).sum(1)))
    for _ in range(64):
        w = np.exp(-near * beta[:, None])
        total = w.sum(1)
        over = np.log(total) + beta * (w * finite).sum(1) / total > target
        low, high = np.where(over, beta, low), np.where(over, high, beta)
        beta = np.where(np.isfinite(high), (low + high) / 2, beta * 2)
    w = np.exp(-near * beta[:, None])
    return w / w.sum(1, keepdims=True)


def affinities(neighbours: DataFrame, perplexity: float) -> DataFrame:
    """``(a, b, p)``: symmetric probabilities summing to the number of rows."""
    def run(batches):
        for batch in batches:
            ids, near = batch.column(0), batch.column(1)
            if not len(ids):
                continue
            ends = near.offsets.to_numpy()
            flat = near.flatten()
            size = np.diff(ends)
            d2 = np.full((len(ids), int(size.max())), np.inf)
            mask = np.arange(d2.shape[1]) < size[:, None]
            d2[mask] = flat.field("d2").to_numpy()
            p = probabilities(d2, perplexity)[mask]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids.to_numpy(), size)), flat.field("other"), pa.array(p)], names=["a", "b", "p"])

    lists = neighbours.groupBy("id").agg(F.collect_list(F.struct("other", "d2")).alias("near"))  # k of a row
    one_way = written(lists.mapInArrow(run, "a long, b long, p double"), "affinities")
    both = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"), "p"))
    return both.groupBy("a", "b").agg((F.sum("p") / 2).alias("p"))


def _cell(y, side):
    return np.floor(y / side).astype(np.int64)


def charges(state: DataFrame, side: float) -> DataFrame:
    """``(cx, cy, n, s1, s2)``: rows and sums of positions on the grid's nodes, each row
    shared out bilinearly over the four nodes of its cell."""
    def run(batches):
        for batch in batches:
            y = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
            cell = _cell(y, side)
            part = y / side - cell
            out = []
            for dx in (0, 1):
                for dy in (0, 1):
                    w = np.abs(1 - dx - part[:, 0]) * np.abs(1 - dy - part[:, 1])
                    out.append((cell[:, 0] + dx, cell[:, 1] + dy, w, w * y[:, 0], w * y[:, 1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["cx", "cy", "n", "s1", "s2"])

    spread = state.select("y1", "y2").mapInArrow(run, "cx long, cy long, n double, s1 double, s2 double")
    return spread.groupBy("cx", "cy").agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))


def fields(grid: np.ndarray, side: float):
    """The kernels' sums at every node, ``(4, w, h)``, and the normaliser: sums of
    1/(1+d2) and 1/(1+d2)^2 over all rows, and of the latter times their positions."""
    w, h = grid.shape[1:]
    dx = np.minimum(np.arange(2 * w), 2 * w - np.arange(2 * w)) * side
    dy = np.minimum(np.arange(2 * h), 2 * h - np.arange(2 * h)) * side
    near = 1.0 / (1.0 + dx[:, None] ** 2 + dy[None, :] ** 2)
    spectrum = np.fft.rfft2(grid, (2 * w, 2 * h))
    kernels = [np.fft.rfft2(near), np.fft.rfft2(near**2)]
    back = lambda s: np.fft.irfft2(s, (2 * w, 2 * h))[:w, :h]
    out = np.stack([back(spectrum[0] * kernels[0]), *(back(spectrum[k] * kernels[1]) for k in range(3))])
    total = float((grid[0] * out[0]).sum())
    return out, max(total - float(grid[0].sum()), 1e-12)


def _picture(state: DataFrame, side: float):
    """The charged grid, its corner and its cell side (doubled until it fits)."""
    while True:
        rows = charges(state, side).limit(GRID * GRID + 1).toArrow()  # more would not fit on the grid
        node = np.stack([rows.column(c).to_numpy() for c in ("cx", "cy")])
        lo, size = node.min(1), np.ptp(node, 1) + 1
        if len(rows) <= GRID * GRID and size.max() <= GRID:
            break
        side *= 2
    grid = np.zeros((3, *size))
    for k, c in enumerate(("n", "s1", "s2")):
        grid[k][tuple(node - lo[:, None])] = rows.column(c).to_numpy()
    return grid, lo, side


def _step(state: DataFrame, edges: DataFrame, field, lo, side, total, scale, momentum, rate) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast((field, lo))
    ends = [state.select(F.col("id").alias(c), F.col("y1").alias(f"{c}1"), F.col("y2").alias(f"{c}2")) for c in "ab"]
    near = 1 / (1 + (F.col("a1") - F.col("b1")) ** 2 + (F.col("a2") - F.col("b2")) ** 2)
    pull = (edges.join(ends[0], "a").join(ends[1], "b").withColumn("w", F.col("p") * near).groupBy(F.col("a").alias("id"))
            .agg(F.sum(F.col("w") * (F.col("a1") - F.col("b1"))).alias("f1"), F.sum(F.col("w") * (F.col("a2") - F.col("b2"))).alias("f2")))

    def run(batches):
        field, lo = shared.value
        for batch in batches:
            ids, y1, y2, u1, u2, g1, g2, f1, f2 = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            y, u, g, f = (np.stack(p, 1) for p in ((y1, y2), (u1, u2), (g1, g2), (f1, f2)))
            cell = _cell(y, side)
            part, cell = y / side - cell, cell - lo
            read = np.zeros((4, len(ids)))
            for dx in (0, 1):
                for dy in (0, 1):
                    read += np.abs(1 - dx - part[:, 0]) * np.abs(1 - dy - part[:, 1]) * field[:, cell[:, 0] + dx, cell[:, 1] + dy]
            push = (y * read[1][:, None] - read[2:].T) / total
            slope = 4 * (scale * f - push)
            g = np.maximum(np.where(np.sign(slope) != np.sign(u), g + 0.2, g * 0.8), 0.01)
            u = momentum * u - rate * g * slope
            y = y + u
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(np.ascontiguousarray(z[:, k])) for z in (y, u, g) for k in (0, 1))],
                                             names=[c.split()[0] for c in _STATE.split(", ")])

    zero = F.lit(0.0)
    joined = state.join(pull, "id", "left").select("id", "y1", "y2", "u1", "u2", "g1", "g2", F.coalesce("f1", zero).alias("f1"), F.coalesce("f2", zero).alias("f2"))
    return joined.mapInArrow(run, _STATE)


def tsne(df: DataFrame, id_col: str, vector_col: str, perplexity: float = PERPLEXITY, learning_rate: float | None = None,
         iterations: int = ITERATIONS) -> DataFrame:
    """``(id, tsne1, tsne2)`` of every row; ids must be unique longs, vectors of one length.

    ``learning_rate``: None for the number of rows over the exaggeration (10 at
    least), which settles in few iterations; a fixed 200 takes several hundred.

    A row without a vector has no place (NULLs); one or two rows lie at the origin;
    equal vectors lie close; an empty table gives an empty table."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double")).alias("v"))
    rows = written(rows, "vectors")
    points = rows.where("v is not null")
    n = points.count()
    name = lambda d: d.select(F.col("id").alias(id_col), F.col("y1").alias("tsne1"), F.col("y2").alias("tsne2"))
    lost = rows.where("v is null").select("id", F.lit(None).cast("double").alias("y1"), F.lit(None).cast("double").alias("y2"))
    if n < 3:
        return name(points.select("id", F.lit(0.0).alias("y1"), F.lit(0.0).alias("y2")).unionByName(lost))
    k = min(n - 1, int(3 * perplexity))
    edges = written(affinities(nearest_neighbours(points, k, n), min(perplexity, k / 3)).withColumn("p", F.col("p") / n), "edges")
    start = pca(points, "v", 2, keep=("id",))
    spread = start.agg(F.stddev_pop("pc1")).first()[0] or 1.0
    zero, one = F.lit(0.0), F.lit(1.0)
    state = written(start.select("id", (F.col("pc1") * 1e-4 / spread).alias("y1"), (F.col("pc2") * 1e-4 / spread).alias("y2"),
                                 zero.alias("u1"), zero.alias("u2"), one.alias("g1"), one.alias("g2")), "positions")
    rate = learning_rate or max(n / EXAGGERATION, 10.0)
    side, early = FINEST / 64, math.ceil(iterations * EXAGGERATED)
    for t in range(iterations):
        grid, lo, side = _picture(state, side)
        field, total = fields(grid, side)
        state = written(_step(state, edges, field, lo, side, total, EXAGGERATION if t < early else 1.0, 0.5 if t < early else 0.8, rate), "positions")
    return name(state.select("id", "y1", "y2").unionByName(lost))
