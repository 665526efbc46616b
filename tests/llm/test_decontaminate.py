import random

import numpy as np
import pytest

from conftest import sentence
from shelflens.llm import decontaminate as D
from shelflens.llm.queries import op2_decontaminate
from tests_llm import SF, frame


def brute_score(item, text):
    """Smith-Waterman by the textbook."""
    a, b = D.make_block([0], [item]).words[0], D.make_block([0], [text]).words[0]
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH), h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return h.max() / (D.MATCH * len(a))


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    items = [sentence(rng, rng.randint(18, 45), "abcdefghijklmnop") for _ in range(12)]
    docs = []
    for k in range(60):
        body = sentence(rng, 120, "abcdefghijklmnop").split()
        if k % 3 == 0:
            words = items[k % 12].split()
            if k % 2:  # edited: a word in eight replaced, one left out, one put in
                words = [w if rng.random() > 0.12 else "edited" for w in words]
                del words[len(words) // 2]
                words.insert(4, "inserted")
            at = rng.randint(0, len(body))
            body[at:at] = words
        docs.append((k, " ".join(body)))
    return items, docs


def test_against_brute_force(spark, planted):
    items, docs = planted
    got = {(r.doc_id, m.item_id): m.score for r in D.scan(spark.createDataFrame(docs, "doc_id long, text string"),
           spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect() for m in r.matches}
    want = {(d, i): s for d, text in docs for i, item in enumerate(items) if (s := brute_score(item, text)) >= D.THRESHOLD}
    assert got.keys() == want.keys() and len(want) >= 20
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert any(s < 1 for s in want.values())


def test_span_holds_the_copy(spark, planted):
    items, _ = planted
    text = "Start here: " + items[0] + " and on"
    r = D.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, items[0])], "item_id long, text string")).first()
    m = r.matches[0]
    assert (m.item_id, m.score, m.first_word, m.last_word) == (7, 1.0, 2, 1 + len(items[0].split()))


def test_query_finds_every_whole_copy_and_leaves_the_rest(spark):
    docs, items = frame(SF, "documents"), frame(SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in op2_decontaminate(spark, SF).collect()}
    assert got == {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, x in zip(items.item_id, items.text) if x in t}


def test_items_in_blocks(spark, planted, monkeypatch):
    items, docs = planted
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    key = lambda df: {(r.doc_id, m.item_id) for r in df.collect() for m in r.matches}
    whole = key(D.scan(d, i))
    monkeypatch.setattr(D, "ITEMS_PER_BLOCK", 5)
    assert key(D.scan(d, i)) == whole


def test_edges(spark, edge, none, edge_rows):
    items = spark.createDataFrame([(1, edge_rows[5][1]), (1, edge_rows[5][1]), (2, None), (3, ""), (4, "one two")], "item_id long, text string")
    rows = D.scan(edge, items).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        assert bool(r.matches) == (r.text is not None and edge_rows[5][1][:40].lower() in " ".join(r.text.lower().split()))
    assert D.scan(none, items).count() == 0
    assert all(r.matches == [] for r in D.scan(edge, items.limit(0)).collect())


def edited(rng, words, how):
    """An edited copy; each kind leaves an alignment score of at least THRESHOLD."""
    new = lambda: "".join(rng.choice("qrstuvwxyz") for _ in range(7))
    if how == "fourth":
        return [new() if k % 4 == 3 else w for k, w in enumerate(words)]
    if how == "third":  # no three words in a row are left
        return [new() if k % 3 == 2 else w for k, w in enumerate(words)]
    if how == "between":  # no two words in a row are left
        return [x for w in words for x in (w, new())][:-1]
    if how == "dropped":
        return [w for k, w in enumerate(words) if k % 4 != 2]
    if how == "half":
        return words[:len(words) // 2 + 1]
    return [new() if rng.random() < float(how) else w for w in words]


@pytest.mark.parametrize("whole", [False, True])
def test_edited_copies_against_brute_force(spark, whole):
    """Items that the corpus holds only as edited copies, or as whole ones too."""
    rng = random.Random(11)
    items = [sentence(rng, n, "abcdefghijklmnop") for n in (3, 4, 5, 7, 12, 20, 30, 40, 55)]
    kinds = ["fourth", "third", "between", "dropped", "half", "0.2", "0.25", "0.3"]
    texts = []
    for item in items:
        for how in kinds:
            body = sentence(rng, 60, "abcdefghijklmnop").split()
            body[30:30] = edited(rng, item.split(), how)
            texts.append(" ".join(body))
    texts += items if whole else []
    want = {(d, i): s for d, text in enumerate(texts) for i, item in enumerate(items) if (s := brute_score(item, text)) >= D.THRESHOLD}
    got = {(r.doc_id, m.item_id): m.score for r in D.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
           spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect() for m in r.matches}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {(k * len(kinds) + j, k) for k in range(5, 9) for j in range(5)} <= want.keys()


def test_few_different_words_against_brute_force(spark, monkeypatch):
    """Words that return often, so that frequent pairs are left out of the seeds."""
    monkeypatch.setattr(D, "ENTRIES", 50)
    rng = random.Random(12)
    some = [f"w{k}" for k in range(25)]
    pick = lambda n: [some[min(rng.randrange(25), rng.randrange(25))] for _ in range(n)]
    items = [pick(rng.randint(3, 30)) for _ in range(25)]
    texts = [" ".join(pick(40) + edited(rng, rng.choice(items), rng.choice(["fourth", "third", "between", "0.3"])) + pick(40)) for _ in range(60)]
    items = [" ".join(i) for i in items]
    want = {(d, i): s for d, text in enumerate(texts) for i, item in enumerate(items) if (s := brute_score(item, text)) >= D.THRESHOLD}
    got = {(r.doc_id, m.item_id): m.score for r in D.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
           spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect() for m in r.matches}
    assert got.keys() == want.keys() and len(want) > 60
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
