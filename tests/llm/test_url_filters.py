import random
import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from shelflens.llm import oracles
from shelflens.llm import url_filters as U
from shelflens.llm.queries import URL_RULES, op6_url_filters
from tests_llm import SF, frame

PAGES = "page_id long, url string, html string"


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


def test_query_rules(spark):
    got = {r.page_id: r for r in op6_url_filters(spark, SF).collect()}
    pages = frame(SF, "pages")
    assert len(got) == len(pages)
    for i, url in zip(pages.page_id, pages.url):
        host, path = split(url)
        name, verdict = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, name)
        assert got[i].verdict == (verdict or ("block" if got[i].distrust > got[i].trust else "allow"))


def test_propagation_by_brute_force(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "a"), ("c", "e")]
    score = {h: s * 0.15 for h, s in (("a", 0.75), ("d", 0.25))}
    base = dict(score)
    for _ in range(400):
        new = dict(base)
        for s, d in edges:
            new[d] = new.get(d, 0) + U.DAMPING * score.get(s, 0) / sum(x == s for x, _ in edges)
        score = new
    got = {r.host: r.score for r in U.propagate(spark.createDataFrame(edges, "src string, dst string"),
           spark.createDataFrame([("a", 0.75), ("d", 0.25)], "host string, seed double")).collect()}
    assert got.keys() == score.keys() and all(abs(got[k] - score[k]) <= 6 * U.TOLERANCE for k in score)


def test_links_carry_trust_and_distrust(spark):
    pages = spark.createDataFrame([
        (1, "http://good.org/x", '<a href="https://Friend.net/a">'), (2, "http://friend.net/", "<A HREF='//pal.net'>"), (3, "http://pal.net/", None),
        (4, "http://farm.net/", '<a href="http://bad.com/de/1"><a href=http://bad.com/>'), (5, "http://bad.com/de/2", ""), (6, "http://far.net/", '<a href="/own">')], PAGES)
    got = {r.page_id: (r.verdict, r.trust > 0, r.distrust > 0) for r in U.judge(pages, URL_RULES).collect()}
    assert got == {1: ("allow", True, False), 2: ("allow", True, False), 3: ("allow", True, False), 4: ("block", False, True),
                   5: ("block", False, True), 6: ("allow", False, False)}


def test_a_chain_of_40_links_is_blocked_to_its_end(spark):
    n = 40
    pages = [(k, f"http://h{k}.net/", f'<a href="http://h{k + 1}.net/">' + "x" * (200_000 if k == 3 else 0)) for k in range(n)]
    pages += [(n, f"http://h{n}.net/", '<a href="http://bad.com/de/1">'), (n + 1, "http://bad.com/de/2", None)]
    df = spark.createDataFrame(pages, PAGES).withColumns({"trust": F.lit("t"), "host": F.lit("h"), "rule": F.lit(1), "__fit": F.lit(2)})
    got = {r.page_id: r for r in U.judge(df, URL_RULES).collect()}
    assert {r.verdict for r in got.values()} == {"block"} and len(got) == n + 2
    assert got[0].distrust < got[n].distrust and abs(got[0].distrust - 0.15 * 0.85 ** (n + 1)) < 1e-12


def test_oracle_follows_links(spark):
    rng = random.Random(5)
    hosts = [f"h{k}.net" for k in range(12)] + ["bad.com", "good.org", "b.com"]
    pages = [(k, f"http://{rng.choice(hosts)}/de/{k}", "".join(f'<a href="http://{rng.choice(hosts)}/">' for _ in range(rng.randint(0, 3)))) for k in range(60)]
    want = duckdb.connect()
    want.register("pages", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    rows = {r[0]: r for r in want.execute(oracles.url_filters(URL_RULES)).fetchall()}
    got = U.judge(spark.createDataFrame(pages, PAGES), URL_RULES).collect()
    assert len(rows) == len(got) == 60 and len({r.verdict for r in got}) == 2
    for r in got:
        w = rows[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == w[1:5] and abs(r.trust - w[5]) < 1e-12 and abs(r.distrust - w[6]) < 1e-12


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG", "http://example.org/en/1?x", "http://notexample.org/es/", "x://com/fr/#a", "a://b.com/de/://c", "http://org?/es"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(4, urls[4], None), (None, None, None)], PAGES)
    rows = U.judge(pages, URL_RULES).collect()
    assert len(rows) == 12
    for r in rows:
        if r.page_id is not None:
            host, path = split(urls[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule(host, path)[0])
    assert U.judge(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in U.judge(pages, []).collect()} == {"allow"}
