import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402
from shelflens.llm import decontaminate, jaccard_join, language_id, stages  # noqa: E402
from shelflens.llm.common import table  # noqa: E402
from test_jaccard_join import brute  # noqa: E402
from test_mixing import WORD, targets  # noqa: E402
from tests_llm import SF, frame  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage gives for the one before it, as rows."""
    docs, out, base = table(spark, SF, "documents"), [], tmp_path_factory.mktemp("pipeline")
    for k, (name, stage) in enumerate(P.STAGES):
        path = str(base / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_and_order(spark, steps):
    assert [n for n, _ in P.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    for df in steps[:-1]:
        assert df.columns == table(spark, SF, "documents").columns


def test_language_stage_keeps_clear_documents(spark, steps):
    docs = table(spark, SF, "documents")
    judged = language_id.identify(docs, language_id.train(docs))
    assert sorted(rows(steps[0])) == sorted(rows(judged.where("margin >= 0.005 and lang_pred <> 'und'")))
    assert steps[0].count() > 0.95 * docs.count()


def test_one_document_of_each_group_stays(steps):
    before = rows(steps[0])
    assert sorted(i for i, _ in rows(steps[1])) == sorted({c for _, _, c in brute(before)})


def test_contaminated_documents_go(steps):
    items = frame(SF, "benchmark").text.tolist()
    assert sorted(rows(steps[2])) == sorted(r for r in rows(steps[1]) if not any(x in r[1] for x in items))


def test_mix_takes_what_was_asked(steps):
    docs = steps[2].toPandas()
    docs["size"] = docs.text.map(lambda t: len(WORD.findall(t)))
    sizes = docs.groupby("source")["size"].sum().to_dict()
    got = steps[3].toPandas()
    taken = got.text.map(lambda t: len(WORD.findall(t))).groupby(got.source).sum().to_dict()
    for s, want in targets(sizes).items():
        assert abs(taken.get(s, 0) - want) <= max(0.02 * want, docs["size"][docs.source == s].max() / 2 + 1)
    assert got.groupby("doc_id").size().max() <= 3


def test_shards(steps):
    got = steps[4].toPandas()
    count = got.groupby("shard").size()
    assert len(got) == steps[3].count() and count.max() - count.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_run(spark, steps):
    got = P.run(spark, SF).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, steps[4].select("doc_id", "shard", "slot").collect()))


def test_edges(spark, edge, none, edge_rows):
    for _, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0
    kept = stages.deduplicated(spark, edge, SF)
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted({c for _, _, c in brute([(r[0], r[1]) for r in edge_rows])}, key=str)
    assert kept.columns == edge.columns and stages.mixed(spark, edge, SF).columns == edge.columns
    assert stages.decontaminated(spark, edge, SF).count() == len(edge_rows)
    assert stages.sharded(spark, edge, SF).count() == len(edge_rows)
    assert decontaminate.THRESHOLD <= 0.6 and jaccard_join.SHINGLE == 5


def test_stages_keep_columns_with_the_names_they_use(spark, edge, edge_rows):
    from pyspark.sql import functions as F
    names = ["__id", "__h", "__g", "__n", "__k", "__pid", "__pos", "__all", "__off", "__place"]
    odd = edge.select("doc_id", "text", "lang", "source", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in P.STAGES:
        out = stage(spark, odd, SF)
        assert out.columns[:len(odd.columns)] == odd.columns or sorted(out.columns) == sorted([*odd.columns, "row_number", "shard", "slot"])
        got = out.collect()
        assert got and all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in got for n in odd.columns[4:])
