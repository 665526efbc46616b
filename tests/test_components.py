"""Components against union-find; rounds follow the logarithm of the size."""
import random

import pytest

from shelflens.operators.components import connected_components
from shelflens.operators.dbscan import dbscan


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def check(spark, edges, most):
    rounds = []
    got = connected_components(spark.createDataFrame(edges, "u long, v long"), rounds).collect()
    assert {r.node: r.component for r in got} == union_find(edges) and len(got) == len({r.node for r in got})
    assert len(rounds) <= most


def test_a_path_of_10000_cells(spark):
    n = 10_000
    check(spark, [(k, k + 1) for k in range(n - 1)], 14)


def test_stars_cycles_and_repeats(spark):
    star = [(0, k) for k in range(1, 3000)]
    cycle = [(5000 + k, 5000 + (k + 1) % 300) for k in range(300)]
    rng = random.Random(3)
    loose = [(rng.randint(9000, 9400), rng.randint(9000, 9400)) for _ in range(260)]
    check(spark, star + star[:50] + [(v, u) for u, v in cycle] + cycle + loose + [(7, 7), (77777, 77777)], 10)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(2, 1)], [(-5, 3), (3, -5)]])
def test_small(spark, edges):
    check(spark, edges, 1)


def test_a_long_chain_of_points_is_one_cluster(spark):
    n = 3000  # a snake whose diameter is its length
    rows = [(k, float(k % 50 if (k // 50) % 2 == 0 else 49 - k % 50), float(3 * (k // 50))) for k in range(n)]
    rows += [(n + 3 * k + j, 49.0 if k % 2 == 0 else 0.0, 3.0 * k + 1 + j) for k in range(59) for j in range(2)]
    got = dbscan(spark.createDataFrame(rows, "id long, x double, y double"), "id", ["x", "y"], 1.0, 2).collect()
    assert {r.cluster for r in got} == {0} and len(got) == len(rows)
