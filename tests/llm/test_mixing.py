import math
import re
from collections import Counter

import pytest

from shelflens.llm import mixing as M
from shelflens.llm.queries import op7_mixing
from tests_llm import SF, frame

WORD = re.compile("[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        share = {s: (total - sum(out.values())) * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return out | share
        out |= {s: float(most * sizes[s]) for s in over}
        free -= over
    return out


def check(rows, sizes):
    want = targets(sizes)
    for s, size in sizes.items():
        mine = [r for r in rows if r["source"] == s]
        taken, largest = sum(r["taken"] for r in mine), max(r["size"] for r in mine)
        assert all(abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == size for r in mine)
        assert abs(taken - want[s]) <= max(0.02 * want[s], largest / 2 + 1)
        assert all(r["taken"] <= 3 * r["size"] for r in mine)


def test_query(spark):
    docs = frame(SF, "documents")
    size = docs.text.map(lambda t: len(WORD.findall(t)))
    got = op7_mixing(spark, SF).toPandas().merge(docs[["doc_id", "source"]], on="doc_id")
    assert (got.sort_values("doc_id")["size"].values == size[docs.doc_id.argsort()].values).all()
    check(got.to_dict("records"), size.groupby(docs.source).sum().to_dict())
    again = op7_mixing(spark, SF).toPandas()
    assert sorted(map(tuple, got[["doc_id", "taken"]].values)) == sorted(map(tuple, again[["doc_id", "taken"]].values))


@pytest.mark.parametrize("seed", [0, 1])
def test_targets_with_caps(spark, seed):
    import random
    rng = random.Random(seed)
    rows = [(k, " ".join(["w"] * rng.choice([1, 5, 60, 400])), s) for k, s in enumerate(rng.choices(["a", "b", "c", "d", None], [1, 40, 10, 3, 20], k=600))]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + t.count("w")
    out = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    source = {k: s for k, _, s in rows}
    check([r.asDict() | {"source": source[r.doc_id]} for r in out], sizes)
    assert any(abs(t - 3 * sizes[s]) < 1e-9 for s, t in targets(sizes).items())


def cells_of(spark, sources):
    rows = [(name, k, n, n * mean) for name, classes in sources.items() for k, (n, mean) in enumerate(classes)]
    return spark.createDataFrame(rows, "__source string, __class long, n long, words long")


SOURCES = {"a": [(10, 1)], "b": [(1000, 1), (30, 50), (2, 20_000)], "c": [(7, 1)], "d": [(4, 0)], "e": [(5, 1)],
           "f": [(5, 0), (40, 3), (40, 900)], None: [(900, 2), (1, 90_000)]}
TARGETS = {"a": 30.0, "b": 30_000.0, "c": 7.0, "d": 0.0, "e": 0.0, "f": 108_000.0, None: 275_000.0}


def test_newton_meets_the_constraints(spark):
    cells = cells_of(spark, SOURCES)
    mass = {s: sum(n * m for n, m in c) for s, c in SOURCES.items()}
    targets = spark.createDataFrame([(s, mass[s], t) for s, t in TARGETS.items()], "source string, mass long, target double")
    tilted = M.tilt(cells, targets)
    got = {r.source: r for r in M.reached(cells, tilted, 3.0).collect()}
    assert len(got) == len(SOURCES)
    for s, t in TARGETS.items():  # the gradient of the dual
        assert abs(got[s].got - t) <= M.TOLERANCE * max(t, 1e-9), s
    for s, r in got.items():  # Newton's root is the one that plain bisection finds
        if 0 < TARGETS[s] < 3 * mass[s]:
            low, high = -50.0, 50.0
            for _ in range(200):
                mid = (low + high) / 2
                take = sum(n * m * min(3.0, math.exp(min(mid * m, 700))) for n, m in SOURCES[s])
                low, high = (mid, high) if take < TARGETS[s] else (low, mid)
            assert abs(r.lam - mid) <= 1e-4 * abs(mid) + 1e-12, s


def test_rates_are_tilted_by_size(spark):
    """Among all rates up to three that give the same tokens, the tilted ones have the
    least entropy distance to one: moving tokens between classes only raises it."""
    sizes = [(k, size, "x" if k // 6 % 3 else "y") for k, size in enumerate([1, 2, 5, 20, 60, 300] * 40)]
    docs = spark.createDataFrame([(k, " ".join(["w"] * n), s) for k, n, s in sizes], "doc_id long, text string, source string")
    rate = {(r.size, s): r.rate for r, s in ((r, sizes[r.doc_id][2]) for r in M.mix(docs, weights=(1, 1)).collect())}
    entropy = lambda r: r * math.log(r) - r + 1
    for source in "xy":
        own = {n: r for (n, s), r in rate.items() if s == source}
        assert len(set(own.values())) > 1 and all(0 < r <= 3 for r in own.values())
        count = Counter(n for _, n, s in sizes if s == source)
        best = sum(count[n] * entropy(r) for n, r in own.items())
        for a in own:
            for b in own:
                for moved in (1e-3, 1e-2):  # tokens from class a to class b
                    other = own | {a: own[a] - moved / (count[a] * a), b: own[b] + moved / (count[b] * b)}
                    if a != b and 0 < other[a] and other[b] <= 3:
                        assert sum(count[n] * entropy(r) for n, r in other.items()) >= best - 1e-6


def test_edges(spark, edge, none, edge_rows):
    rows = M.mix(edge).collect()
    assert len(rows) == len(edge_rows)
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert sorted(map(str, M.mix(edge.coalesce(1)).collect())) == sorted(map(str, rows))
    assert M.mix(none).count() == 0
    empty = M.mix(edge.where("doc_id in (0, 1)")).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0), (0.0, 0)]
