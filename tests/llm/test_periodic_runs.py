import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelflens.llm import periodic_runs as P
from shelflens.llm.queries import op12_periodic_runs
from tests_llm import SF, frame


def brute(words):
    """All runs by definition: each period, each maximal stretch, smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def edited(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = edited(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs, drop = brute(words), set()
    for s, l, q in runs:
        drop.update(range(s + q, s + l))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def same(got, rows):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r)[:8] for r in got), key=key) == sorted(rows, key=key)


def test_runs_against_brute_force():
    rng = random.Random(3)
    docs = [[], [1], [1] * 5, [1] * 6, [1] * 300, [1, 2] * 4, [1, 2] * 40 + [1], ([1, 1, 2] * 7 + [3]) * 6]
    for _ in range(400):
        n, k = rng.randint(0, 70), rng.randint(1, 4)
        words = [rng.randint(1, k) for _ in range(n)]
        if rng.random() < 0.5 and n:
            p, at = rng.randint(1, 7), rng.randint(0, n)
            words[at:at] = (words[:p] * rng.randint(3, 12))
        docs.append(words)
    first = np.cumsum([0, *map(len, docs)])
    ids = np.array([w for d in docs for w in d], np.int64)
    start, end, period = P.runs(ids, first)
    doc = np.searchsorted(first, start, "right") - 1
    for k, words in enumerate(docs):
        got = [(int(s - first[k]), int(e - s), int(q)) for s, e, q in zip(start[doc == k], end[doc == k], period[doc == k])]
        assert got == brute(words), words


def test_small_steps_of_membership_tests(monkeypatch):
    monkeypatch.setattr(P, "TESTS", 7)
    test_runs_against_brute_force()


def test_query_against_brute_force(spark):
    docs = frame(SF, "documents")
    short = docs[docs.text.fillna("").str.len() < 6000]
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    same([got[i] for i in short.doc_id], [expected(int(i), t) for i, t in zip(short.doc_id, short.text)])
    assert any(r.n_runs for r in got.values())


def test_long_text_is_whole(spark):
    rng = random.Random(1)
    words = [f"w{rng.randint(0, 9**6)}" for _ in range(30_000)]
    text = " ".join([*words, *("again and again".split() * 4000), *words[:100]])
    r = P.find_runs(spark.createDataFrame([(7, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(30_000, 12_000, 3)] and r.n_words == 42_100
    assert r.collapsed == " ".join([*words, "again", "and", "again", *words[:100]])


def test_edges(spark, edge, none, edge_rows):
    short = [r for r in edge_rows if len(r[1] or "") < 20_000]
    got = P.run_digest(P.find_runs(edge.where("length(text) < 20000 or text is null"), extend=P.periodic_extension)).collect()
    same(got, [expected(r[0], r[1]) for r in short])
    assert P.run_digest(P.find_runs(edge)).count() == len(edge_rows)
    assert P.run_digest(P.find_runs(none)).count() == 0


@pytest.mark.parametrize("text", ["a a a a a a", "a  a\ta\na a\x0ba", "x " * 5, "漢 字 " * 4, "  " * 6])
def test_separators(spark, text):
    got = P.run_digest(P.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert got[0].n_runs == len(brute(words))
