import re

from shelflens.llm import licenses as L
from shelflens.llm.queries import op8_licenses
from tests_llm import SF, frame

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def base(text):
    w = words(text)
    places = [(i, label) for label, p in L.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(rows, texts):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id]), r
        mine = [x for x in r.labels.split(",") if x]
        assert {x for x in r.base_labels.split(",") if x} <= set(mine) and mine == sorted(set(mine)) and 0 <= r.score <= 1
        assert (r.score == 0) == (not mine)


def test_query(spark):
    docs = frame(SF, "documents")
    rows = op8_licenses(spark, SF).collect()
    assert len(rows) == len(docs)
    check(rows, dict(zip(docs.doc_id, docs.text)))


def test_method_finds_edited_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    edited = mit.replace("free of charge", "entirely free of all charge").replace("software and", "software, and the")
    half = " ".join(mit.split()[:8])
    apart = " filler words here ".join(mit.split()[k] for k in range(20))
    texts = {1: "x y " + mit, 2: "intro " * 50 + edited + " tail", 3: half, 4: apart, 5: "UNDER THE MIT LICENSE, cc BY-nc cc by nc", 6: None, 7: ""}
    rows = L.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)
    got = {r.doc_id: (r.labels, r.score) for r in rows}
    assert got[1] == ("mit", 1.0) and got[2][0] == "mit" and 0.6 <= got[2][1] < 1
    assert [got[k] for k in (3, 4, 6, 7)] == [("", 0.0)] * 4 and got[5][0] == "cc-by-nc,mit"
    span = L.spans(spark.createDataFrame([(1, texts[2])], "key long, text string")).first()
    assert (span.first_word, span.label) == (50, "mit")


def test_edges(edge, none, edge_rows):
    rows = L.scan(edge).collect()
    assert len(rows) == len(edge_rows)
    check([r for r in rows if r.doc_id is not None], {r[0]: r[1] for r in edge_rows})
    assert L.scan(none).count() == 0 and L.scan(edge, templates=[]).count() == len(edge_rows)
