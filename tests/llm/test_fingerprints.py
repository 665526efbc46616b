import hashlib
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from shelflens.llm import fingerprints as P
from shelflens.llm.queries import op3_fingerprints
from tests_llm import SF, frame


def test_edited_texts_and_order(spark):
    docs = frame(SF, "documents").sort_values("doc_id", ascending=False).reset_index(drop=True)
    got = {r.doc_id: r for r in op3_fingerprints(spark, SF).collect()}
    assert len(got) == len(docs)
    texts = docs.text.tolist()
    for k, (i, text) in enumerate(zip(docs.doc_id, texts)):
        n, nxt = len(text), texts[(k + 1) % len(texts)]
        edited = text[:n - n // 2] + nxt[:n // 2]
        assert got[i].n_chars == n and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    near = docs.merge(docs, on="text")
    assert all(got[a].fingerprint == got[b].fingerprint for a, b in zip(near.doc_id_x, near.doc_id_y))
    mean = lambda f: sum(f(r) for r in got.values()) / len(got)
    assert mean(lambda r: r.near_edited) > 0.2 > mean(lambda r: r.near_next)


def test_closed_syncmers_by_brute_force(spark):
    words = [f"w{i * i % 41}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(["zz", "yy", *words[40:200]]))], "doc_id long, text string")
    hashes = {(r.a, r.b): r.h for r in spark.createDataFrame([(a, b) for a, b in {*zip(words, words[1:])}], "a string, b string")
              .selectExpr("a", "b", "xxhash64(xxhash64(a), xxhash64(b)) h").collect()}
    g = [hashes[p] for p in zip(words, words[1:])]
    want = [i for i in range(len(words) - P.K + 1)
            if min(g[i:i + P.INNER]) in (g[i], g[i + P.INNER - 1])]
    rows = P.anchors(df).collect()
    assert sorted(r.position for r in rows if r.doc_id == 1) == want
    # context-free: the shared passage has the same anchors, shifted
    one = {(r.position - 40, r.anchor) for r in rows if r.doc_id == 1 and 40 <= r.position <= 200 - P.K}
    assert one <= {(r.position - 2, r.anchor) for r in rows if r.doc_id == 2}


SCRIPTS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def test_unspaced_characters_are_those_of_the_scripts(spark):
    """Over all code points but the surrogates."""
    points = spark.range(0, 0x110000, 1, 4).where("id not between 55296 and 57343")
    points = points.select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    counts = points.groupBy(F.col("c").rlike(SCRIPTS), F.col("c").rlike(P._UNSPACED)).count().collect()
    got = {(wanted, found): n for wanted, found, n in counts}
    assert set(got) == {(True, True), (False, False)} and got[True, True] > 90_000


def test_spaced_text_is_not_looked_up_in_every_script(spark):
    """The search in a text of spaced scripts takes well under the time of the plain class."""
    pattern = spark._jvm.java.util.regex.Pattern
    text = "some words, größere Wörter, несколько слов " * 20_000

    def seconds(regex):
        matcher, times = pattern.compile(regex).matcher(text), []
        for _ in range(7):
            matcher.reset()
            start = time.perf_counter()
            assert not matcher.find()
            times.append(time.perf_counter() - start)
        return min(times)

    assert seconds(P._UNSPACED) < 0.5 * seconds(SCRIPTS)


def test_unspaced_scripts_are_split_by_character(spark):
    texts = ["漢字 かな", "abc漢字def", "ไทย", "one “two” — три한글", "𠀀b", ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = dict(df.select("k", P.words_of(df.text)).collect())
    assert [got[k] for k in range(len(texts))] == [["漢", "字", "か", "な"], ["abc", "漢", "字", "def"], ["ไ", "ท", "ย"],
                                                   ["one", "“two”", "—", "три한글"], ["𠀀", "b"], []]


def parsed(fingerprint):
    return [tuple(map(int, x.split(","))) for x in re.findall(r"\{([^}]*)\}", fingerprint)]


def test_likeness_is_that_of_the_returned_fingerprints(spark):
    rows = op3_fingerprints(spark, SF).collect()
    of = {r.doc_id: parsed(r.fingerprint) for r in rows}
    order = sorted(of, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    for r in rows:
        assert abs(r.near_edited - brute_matching(of[r.doc_id], parsed(r.edited_fingerprint))) < 1e-12
        assert abs(r.near_next - brute_matching(of[r.doc_id], of[after[r.doc_id]])) < 1e-12
    assert max(map(len, of.values())) > 200  # long texts keep all their anchors


def test_fingerprints_are_read_back(spark, edge):
    df = P.with_anchors(edge.select("text"), edge.text)
    df = df.select("anchors", P.read_fingerprint(P.as_fingerprint(df.anchors)).alias("again"))
    rows = df.collect()
    assert all(r.anchors == r.again for r in rows) and any(r.anchors for r in rows) and any(not r.anchors for r in rows)
    assert df.schema["anchors"].dataType.simpleString() == df.schema["again"].dataType.simpleString()


def test_edges(edge, none, edge_rows):
    rows = P.edited_fingerprints(edge).collect()
    assert len(rows) == len(edge_rows)
    by = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by.setdefault(r.doc_id, []).append(r)
    assert by[0][0].n_chars == 0 and by[0][0].fingerprint == "" and by[3][0].fingerprint != ""
    assert len({r.fingerprint for r in [*by[5], *by[6], *by[9]]}) == 1  # equal words
    assert len(by[5]) == 3 and len({tuple(r) for r in by[5]}) == 1
    assert P.edited_fingerprints(none).count() == 0
    one = P.edited_fingerprints(edge.where("doc_id = 4")).first()
    assert one.near_next == 1.0


def brute_matching(a, b):
    """Likeness of two lists of (position, anchor) by the definition."""
    offsets, places = [], {}
    for p, x in sorted(b):
        places.setdefault(x, []).append(p)
    for p, x in sorted(a):
        if places.get(x):
            offsets.append(places[x].pop(0) - p)
    votes = Counter(offsets)
    matched = sum(n for n in votes.values() if n >= min(P.SUPPORT, len(a), len(b)))
    return matched / (len(a) + len(b) - matched) if a or b else 1.0


def test_matching_by_brute_force(spark):
    rng = random.Random(4)
    some = lambda n: sorted((p, rng.randrange(12)) for p in rng.sample(range(60), n))
    rows = [(some(rng.randint(0, 30)), some(rng.randint(0, 30))) for _ in range(200)] + [([], []), ([(0, 5)], [(7, 5)]), ([(0, 5)], [])]
    for a, _ in rows[:40]:  # shifted copies
        rows.append((a, [(p + (3 if p > 30 else 1), x) for p, x in a]))
    pairs = "array<struct<position:int,anchor:bigint>>"
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(rows)], f"k int, a {pairs}, b {pairs}")
    got = dict(P.with_matching(df, df.a, df.b, "near").select("k", "near").collect())
    assert all(abs(got[k] - brute_matching(a, b)) < 1e-12 for k, (a, b) in enumerate(rows))


def test_long_texts_are_compared_whole(spark):
    """A passage of 60 words shared by two texts of 3,000, and half of an edited text."""
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = text(60)
    one, two = text(3000), text(3000)
    one[500:560], two[2000:2060] = passage, passage
    docs = spark.createDataFrame([(2, " ".join(one)), (1, " ".join(two))], "doc_id long, text string")
    sets = {r.doc_id: [tuple(x) for x in r.anchors] for r in P.with_anchors(docs, docs.text).collect()}
    want = brute_matching(sets[2], sets[1])
    got = {r.doc_id: r for r in P.edited_fingerprints(docs).collect()}
    assert 0.004 < want < 0.02 and abs(got[2].near_next - want) < 1e-12 and abs(got[1].near_next - want) < 1e-12
    # a text of other words with this text's second half replaced keeps half of its anchors
    assert abs(got[2].near_edited - 1 / 3) < 0.02 and abs(got[1].near_edited - 1 / 3) < 0.02
