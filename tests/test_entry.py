import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "Flag" in df.columns


def test_oracle_keys_subset():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # DBSCAN over two components and t-SNE have no SQL form; all others have
    own = {k for k in qs if k.startswith("q_")}  # the training-data queries have tests of their own
    assert own - set(sql) == {"q_pca_dbscan", "q_tsne"}


def test_every_query_runs_small(spark):
    for name, fn in E.queries().items():
        if not name.startswith("q_"):
            continue  # tests/llm runs the training-data queries
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.count() >= 0, name


def test_scale_conf_sizes_partitions():
    from shelflens.session import scale_conf
    big = scale_conf(100 << 40, 8000)
    small = scale_conf(10 << 20, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)  # no cap
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
