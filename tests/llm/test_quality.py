import numpy as np

from shelflens.llm import quality as Q
from shelflens.llm.queries import op9_quality
from tests_llm import SF, frame, held_out


def test_held_out_ranking(spark):
    rows = op9_quality(spark, SF).toPandas()
    assert len(rows) == len(frame(SF, "documents")) and rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.7)).all() and (rows.held_out == rows.doc_id.map(held_out)).all()
    test = rows.merge(frame(SF, "labels"), on="doc_id")
    test = test[test.held_out]
    good, bad = test.score[test.quality == 1], test.score[test.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.8  # 80 labels here; see README for larger tables


def test_features_by_brute_force():
    texts = ["ab cab", "", "x", "a  b\nca ÄÖü"]
    got = {n: [set() for _ in texts] for n in range(len(Q.GRAMS) + 2)}
    for kind, (buckets, start, end) in enumerate(Q._features(texts)):
        for k in range(len(texts)):
            got[kind][k] = buckets[start[k]:end[k]].tolist()
    for k, t in enumerate(texts):
        for kind, n in enumerate(Q.GRAMS):
            grams = [t[i:i + n] for i in range(len(t) - n + 1)]
            assert len(got[kind][k]) == len(grams)
            alone = next(iter([b[s[0]:e[0]].tolist() for j, (b, s, e) in enumerate(Q._features([t])) if j == kind]), []) if len(t) >= n else []
            assert alone == got[kind][k]  # the same in any batch
        assert len(got[len(Q.GRAMS)][k]) == len(t.split())
    words = got[len(Q.GRAMS)]
    assert [len(x) for x in got[len(Q.GRAMS) + 1]] == [0, 0, 0, 0]
    *_, (_, start, end) = Q._features(["a a a b", "b", "b b"])
    assert (end - start).tolist() == [2, 0, 1]
    assert words[0][0] != words[0][1] and len(set(words[3])) == 4


def test_scores_do_not_depend_on_the_batch(monkeypatch):
    texts = ["good text here", None, "", "bad ### *** bad", "long " * 5000] * 3
    model = Q.fit(["good text here", "fine words", "bad ### ***", "### %%% bad"] * 20, [1, 1, 0, 0] * 20)
    whole = Q.score_texts(texts, model)
    monkeypatch.setattr(Q, "_CODES", 10)
    assert np.allclose(whole, Q.score_texts(texts, model)) and np.allclose(whole[:5], whole[5:10])
    assert whole[0] > 0.7 > whole[3] and whole[1] == whole[2]


def test_edges(spark, edge, none, edge_rows):
    labels = spark.createDataFrame([(5, 1), (5, 0), (7, 0), (8, 1), (None, 1), (3, None), (999, 1)], "doc_id long, quality int")
    out = Q.score(edge, Q.train(edge, labels))
    assert out.count() == len(edge_rows) and "a.b" in out.columns
    assert Q.score(none, Q.train(edge, labels.limit(0))).count() == 0
    assert {r.score for r in Q.score(edge, Q.train(none, labels)).collect()} == {0.5}
    assert abs(Q.score_texts(["any"], Q.fit(["a"], [1]))[0] - 0.99) < 1e-9


def test_scores_by_brute_force():
    """One text at a time, one feature at a time, in plain integers."""
    from shelflens.llm import words as W
    model = Q.fit(["good text here", "fine words", "bad ### ***", "### %%% bad"] * 20, [1, 1, 0, 0] * 20)
    share, bias = model
    mask = (1 << 64) - 1
    letter = lambda c: int(W.mix(np.array([(ord(c) + 0x9E3779B97F4A7C15) & mask], np.uint64))[0]) | 1
    mixed = lambda x: int(W.mix(np.array([x & mask], np.uint64))[0]) >> (64 - Q.BUCKET_BITS)
    base = int(W._power(2)[0][1])

    def one(text):
        buckets = []
        for n in Q.GRAMS:
            for i in range(len(text) - n + 1):
                buckets.append(mixed(sum(letter(c) * int(W._GRAM[k]) for k, c in enumerate(text[i:i + n])) + int(W._GRAM[40 + n])))
        words = text.split()
        buckets += [mixed(sum(letter(c) * pow(base, k, 1 << 64) for k, c in enumerate(w)) + 77) for w in words]
        buckets += [Q.REPEATED for a, b in zip(words, words[1:]) if a == b]
        mean = sum(float(share[b]) for b in buckets) / max(len(buckets), 1)
        return 1 / (1 + np.exp(-(mean + bias)))
    texts = ["good text here", "bad bad ###", "", "x", "fine  words\nÄÖü", "*** *** bad good"]
    assert np.allclose(Q.score_texts(texts, model), [one(t) for t in texts], atol=1e-6)


def test_learning_sees_the_end_of_long_texts(spark):
    rows = [(k, "same words " * 4000 + ("fine prose " if k % 2 else "junk spam ") * 4000) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int"))
    low, high = Q.score_texts([rows[0][1], rows[1][1]], model)
    assert low < 0.5 < high
