"""URL filters (operator 6): host rules plus trust propagated over host links.

Hosts of pages that a rule allows seed a personalised PageRank along the host
links (trust); hosts of pages that a rule blocks seed one along the reversed
links (distrust: a host that links to blocked hosts is suspect).  A page that
no rule fits is blocked if its host's distrust exceeds ``threshold`` times its
trust.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.llm.common import stash

DAMPING = 0.85
TOLERANCE = 1e-6  # of all mass (1): the rounds end when one adds no more than this


def host_of(url):
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host, path, rules):
    """``(rule text, verdict)`` of the longest fitting rule, else null.  ``rules``:
    (verdict, host, path) with host suffixes by label and path prefixes."""
    fitting = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, value) if fitting is None else fitting.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if fitting is None else fitting


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` host links of ``pages(host, html)``: absolute and
    ``//host`` targets of href attributes.  Relative links stay on their host
    and links of a host to itself carry nothing, so both are left out."""
    target = F.explode(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1)))
    lower = F.translate("dst", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (pages.select(F.col("host").alias("src"), target.alias("dst")).withColumn("dst", lower)
            .where("src <> '' and dst <> '' and src <> dst").distinct())


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank ``(host, score)`` from ``seeds(host, seed)`` (weights
    summing to 1) along ``edges(src, dst)``; hosts that no mass reaches are
    absent.  A host without links keeps its share of mass (it is not spread).

    Rounds only ever add to a score, so a round's change is the growth of the sum of
    all scores; at most ``damping**k`` is left to add after k rounds, which bounds their
    number (86 with the defaults).  Every round is written; joins read written tables, so
    AQE can split a host with very many links.
    """
    degree = stash(edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")), "host-degrees")
    weighted = stash(edges.join(degree, "src"), "host-edges")
    base = stash(seeds.select("host", (F.col("seed") * (1 - damping)).alias("score")), "host-base")
    score, change, total = base, float("inf"), base.agg(F.coalesce(F.sum("score"), F.lit(0.0))).first()[0]
    if weighted.isEmpty():
        return base
    while change > tolerance:
        passed = (weighted.join(score.withColumnRenamed("host", "src"), "src")
                  .select(F.col("dst").alias("host"), (F.col("score") * damping / F.col("degree")).alias("score")))
        score = stash(base.unionAll(passed).groupBy("host").agg(F.sum("score").alias("score")), "host-scores")
        before, total = total, score.agg(F.coalesce(F.sum("score"), F.lit(0.0))).first()[0]
        change = total - before
    return score


def judge(pages: DataFrame, rules, threshold: float = 1.0) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` of every page.

    Null or malformed urls have empty host and path, fit no rule and are
    allowed (no host, no distrust).  Hosts that no seed reaches are allowed.
    Rows are kept as they come: repeated pages are judged alike, a null page_id is
    kept.  Null or very long html is read whole; other columns are ignored, whatever
    their names; an empty table gives an empty table.  Ties of trust and distrust allow.
    """
    pages = pages.select("page_id", "url", "html")
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    read = read.withColumn("__fit", rule_for(F.col("host"), F.col("path"), rules))
    seeds = stash(read.where("host <> '' and __fit is not null").groupBy("host")
                  .agg(F.sum(F.expr("cast(__fit.verdict = 'allow' as long)")).alias("allow"),
                       F.sum(F.expr("cast(__fit.verdict = 'block' as long)")).alias("block")), "seeds")
    allow, block = seeds.agg(F.coalesce(F.sum("allow"), F.lit(0)), F.coalesce(F.sum("block"), F.lit(0))).first()
    edges = stash(host_edges(pages.select(host_of(F.col("url")).alias("host"), "html")), "host-links")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    trust = propagate(edges, seeds.where("allow > 0").select("host", (F.col("allow") / F.lit(float(max(allow, 1)))).alias("seed")))
    distrust = propagate(back, seeds.where("block > 0").select("host", (F.col("block") / F.lit(float(max(block, 1)))).alias("seed")))
    scores = stash(trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust"))
                   .unionAll(distrust.select("host", F.lit(0.0), F.col("score")))
                   .groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "scores")
    # a host may hold a third of all pages; both sides are plain tables, so AQE can split it
    out = read.join(scores, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    guess = F.when(distrust > F.lit(threshold) * trust, "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("__fit.rule").alias("rule"),
                      F.coalesce(F.col("__fit.verdict"), guess).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
