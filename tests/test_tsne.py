"""t-SNE against the exact gradient: neighbours kept, forces, probabilities."""
import numpy as np
import pytest

from shelflens.operators import tsne as S
from shelflens.operators.neighbours import nearest_neighbours


def blobs(n=150, d=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d)) * 4
    return np.vstack([centres[i % 5] + rng.normal(size=d) for i in range(n)])


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")


def squares(x):
    return ((x[:, None] - x[None]) ** 2).sum(-1)


def kept(x, y, k=10):
    """Share of the k nearest rows in space that are among the k nearest in the picture."""
    a, b = squares(x), squares(y)
    np.fill_diagonal(a, np.inf), np.fill_diagonal(b, np.inf)
    a, b = np.argsort(a, 1)[:, :k], np.argsort(b, 1)[:, :k]
    return np.mean([len(set(p) & set(q)) / k for p, q in zip(a, b)])


def exact(x, perplexity, iterations):
    n, d2 = len(x), squares(x)
    rate = max(n / S.EXAGGERATION, 10.0)
    np.fill_diagonal(d2, np.inf)
    p = S.probabilities(d2, perplexity)
    p = (p + p.T) / (2 * n)
    c = x - x.mean(0)
    y = c @ np.linalg.svd(c, full_matrices=False)[2][:2].T
    y = y * 1e-4 / y[:, 0].std()
    u, g, early = np.zeros_like(y), np.ones_like(y), int(np.ceil(iterations * S.EXAGGERATED))
    for t in range(iterations):
        w = 1 / (1 + squares(y))
        np.fill_diagonal(w, 0)
        f = (12.0 if t < early else 1.0) * p - w / w.sum()
        slope = 4 * ((f * w)[:, :, None] * (y[:, None] - y[None])).sum(1)
        g = np.maximum(np.where(np.sign(slope) != np.sign(u), g + 0.2, g * 0.8), 0.01)
        u = (0.5 if t < early else 0.8) * u - rate * g * slope
        y = y + u
    return y


def test_neighbours_in_trees(spark):
    x = blobs(900, 16)
    x[:300] = x[0]  # a third of all rows are equal
    got = {}
    for r in nearest_neighbours(frame(spark, x), 10, leaf=120).collect():
        got.setdefault(r.id, []).append((r.d2, r.other))
    d2 = squares(x)
    np.fill_diagonal(d2, np.inf)
    assert all(len(got[i]) == 10 for i in range(900))
    far = np.sort(d2, 1)[:, 9]
    recall = np.mean([[d <= far[i] + 1e-9 for d, _ in got[i]] for i in range(300, 900)])
    assert recall > 0.85 and all(d <= 1e-9 for i in range(300) for d, _ in got[i])


def test_one_leaf_is_exact(spark):
    x = blobs(80)
    d2 = squares(x)
    np.fill_diagonal(d2, np.inf)
    got = {(r.id, r.other) for r in nearest_neighbours(frame(spark, x), 7).collect()}
    assert got == {(i, int(j)) for i in range(80) for j in np.argsort(d2[i])[:7]}


def test_probabilities_have_the_perplexity():
    d2 = np.sort(np.random.default_rng(0).exponential(size=(20, 50)) * 9, 1)
    p = S.probabilities(d2, 12.0)
    assert np.allclose(p.sum(1), 1) and np.allclose(np.exp(-(p * np.log(p)).sum(1)), 12.0, rtol=1e-6)


def test_grid_forces_are_close_to_exact_ones(spark):
    y = np.random.default_rng(3).normal(size=(200, 2)) * [12, 5]
    state = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(y)], "id long, y1 double, y2 double")
    grid, lo, side = S._picture(state, S.FINEST)
    field, total = S.fields(grid, side)
    w = 1 / (1 + squares(y))
    np.fill_diagonal(w, 0)
    assert abs(total / w.sum() - 1) < 0.05 and abs(grid[0].sum() - 200) < 1e-9
    cell = S._cell(y, side)
    part, cell = y / side - cell, cell - lo
    read = sum(np.abs(1 - dx - part[:, 0]) * np.abs(1 - dy - part[:, 1]) * field[:, cell[:, 0] + dx, cell[:, 1] + dy] for dx in (0, 1) for dy in (0, 1))
    push, want = y * read[1][:, None] - read[2:].T, ((w**2)[:, :, None] * (y[:, None] - y[None])).sum(1)
    assert np.abs(push - want).max() < 0.06 * np.abs(want).max()


def test_picture_keeps_neighbours_like_the_exact_one(spark):
    x = blobs(150)
    rows = S.tsne(frame(spark, x), "id", "v", perplexity=12, iterations=40).collect()
    y = np.array([[r.tsne1, r.tsne2] for r in sorted(rows, key=lambda r: r.id)])
    ours, theirs, chance = kept(x, y), kept(x, exact(x, 12, 40)), kept(x, np.random.default_rng(0).normal(size=(150, 2)))
    assert ours > 0.9 * theirs and ours > 3 * chance, (ours, theirs, chance)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(1, None), (2, [1.0, 2.0]), (3, [2.0, 1.0])]])
def test_few_rows(spark, rows):
    got = S.tsne(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v").collect()
    assert {r.id for r in got} == {r[0] for r in rows}
    assert all((r.tsne1 is None) == (dict(rows)[r.id] is None) for r in got)


def test_equal_and_missing_vectors(spark):
    rows = [(i, [1.0, 2.0, float(i > 8)]) for i in range(12)] + [(99, None)]
    got = {r.id: r.tsne1 for r in S.tsne(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", iterations=3).collect()}
    assert len(got) == 13 and got.pop(99) is None and all(np.isfinite(v) for v in got.values())
