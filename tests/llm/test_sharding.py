import numpy as np
import pytest

from shelflens.llm import sharding as S
from shelflens.llm.queries import op5_sharding
from tests_llm import SF, frame


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_permutation(n):
    x = S.permute(np.arange(n), n, seed=4)
    assert sorted(x.tolist()) == list(range(n)) and (S.permute(x, n, seed=4, backwards=True) == np.arange(n)).all()
    if n == 1000:
        assert (x != S.permute(np.arange(n), n, seed=5)).mean() > 0.9 and abs(np.corrcoef(x, np.arange(n))[0, 1]) < 0.1


def test_outside():
    with pytest.raises(ValueError):
        S.permute([3], 3)


def test_query(spark):
    docs = frame(SF, "documents").sort_values("doc_id").reset_index(drop=True)
    got = op5_sharding(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    place = S.permute(np.arange(len(docs)), len(docs))
    assert (got["shard"] == place % 24).all() and (got.slot == place // 24).all()
    assert (got["size"] == docs.text.map(lambda t: len(t.encode()) + 8)).all()
    sizes = got.groupby("shard").slot.agg(["count", "max"])
    assert sizes["count"].max() - sizes["count"].min() <= 1 and (sizes["max"] == sizes["count"] - 1).all()
    r = got.iloc[17]
    assert docs.doc_id[S.row_at(int(r["shard"]), int(r.slot), len(docs), 24)] == r.doc_id


def test_edges(spark, edge, none, edge_rows):
    out = S.shard(edge, 4)
    rows = out.collect()
    assert sorted(r.row_number for r in rows) == list(range(len(edge_rows)))
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.row_number)] == sorted((r[0] for r in edge_rows), key=lambda i: (i is not None, i))
    assert sorted(tuple(r) for r in out.select("row_number", "shard").collect()) == sorted(tuple(r) for r in S.shard(edge.coalesce(1), 4).select("row_number", "shard").collect())
    assert S.shard(none, 4).count() == 0 and "a.b" in out.columns
    one = S.shard(spark.range(1).withColumnRenamed("id", "doc_id"), 3).first()
    assert one["slot"] == 0
