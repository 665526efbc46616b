import random

import numpy as np
import pytest

from conftest import sentence
from shelflens.llm import jaccard_join as J
from shelflens.llm.common import components
from shelflens.llm.queries import op10_jaccard_join
from tests_llm import SF, frame


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """component and set size of each (id, text) row."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return sorted(((i, len(sets[k]), ids.get(find(k), i) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else "e" + w for w in text.split())


def corpus(seed, n=120):
    rng, rows = random.Random(seed), []
    passage = sentence(rng, 60)  # shared by many, not near copies for that
    hub = sentence(rng, 80)
    for k in range(n):
        kind = rng.random()
        if kind < 0.3:
            text = edited(rng, hub, rng.choice([0.0, 0.01, 0.03, 0.06]))
        elif kind < 0.5 and rows:
            text = edited(rng, rng.choice(rows)[1], rng.choice([0.0, 0.02, 0.05]))
        elif kind < 0.75:
            text = sentence(rng, rng.randint(5, 60)) + " " + passage
        else:
            text = sentence(rng, rng.randint(1, 80))
        rows.append((k * 7 % 1000, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("bits", [6, 8, 12])
def test_merged_frequency_hashes_lose_no_link(spark, monkeypatch, bits):
    rng = random.Random(bits)
    rows = corpus(bits, 60)
    for k in range(25):  # pairs exactly at the limit: 75 shingles of 100, the one within the other
        words = [f"w{k}x{j}" for j in range(104)]
        rows += [(2000 + 2 * k, " ".join(words)), (2001 + 2 * k, " ".join(words[:79]))]
    rng.shuffle(rows)
    monkeypatch.setattr(J, "FREQUENCY_BITS", bits)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_copies_from_many_tasks_in_small_ranges(spark, monkeypatch):
    rows = corpus(9, 60)
    rows += [(3000 + k, rows[k % 3][1]) for k in range(90)]
    monkeypatch.setattr(J, "BUCKET_SHINGLES", 300)
    monkeypatch.setattr(J, "SLICE_SHINGLES", 200)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_clusters_in_blocks(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 700)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_query(spark):
    docs = frame(SF, "documents")
    assert sorted((tuple(r) for r in op10_jaccard_join(spark, SF).collect()), key=str) == brute(list(zip(docs.doc_id.tolist(), docs.text)))


def test_trie_join_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sets = []
        for _ in range(int(rng.integers(2, 40))):
            if sets and rng.random() < 0.6:
                s = set(sets[rng.integers(len(sets))].tolist())
                s = {x for x in s if rng.random() > 0.08} | set(rng.integers(0, 60, rng.integers(0, 3)).tolist())
            else:
                s = set(rng.integers(0, 60, rng.integers(1, 30)).tolist())
            if s:
                sets.append(np.array(sorted(s), np.uint64))
        cut = int(rng.integers(0, len(sets)))

        def joined(pairs):
            label = list(range(len(sets)))
            for a, b in pairs:
                x, y = label[a], label[b]
                label = [x if v == y else v for v in label]
            return [label.index(v) for v in label]

        links = [(a, b) for a in range(len(sets)) for b in range(a)
                 if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
        assert joined(J.trie_join(sets)) == joined(links)
        if 0 < cut:
            across = J.trie_join(sets[:cut], sets[cut:])
            inside = J.trie_join(sets[:cut]), [(a + cut, b + cut) for a, b in J.trie_join(sets[cut:])] if cut < len(sets) else []
            assert joined([*across, *inside[0], *inside[1]]) == joined(links)


def test_packing():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        x = np.sort(rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1))
        assert (J._unpack(J._pack(x), n) == x).all()
    x = np.array([0, 0, 5, 2**64 - 1], np.uint64)
    assert (J._unpack(J._pack(x), 4) == x).all()


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001 + k) for k in range(50)]
    label = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = label[a], label[b]
        label = {k: x if v == y else v for k, v in label.items()}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got.keys() == linked
    assert len({(got[k], label[k]) for k in got}) == len(set(got.values())) == len({label[k] for k in got})
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_edges(edge, none, edge_rows):
    got = sorted((tuple(r) for r in J.near_duplicates(edge).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in edge_rows])
    assert J.near_duplicates(none).count() == 0
