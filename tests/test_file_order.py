"""Row numbers and samples in the order of the files, whatever the splits."""
from shelflens.operators import profile as PR
from shelflens.operators.file_order import PLACE, placed, with_file_index
from shelflens.sources import files as FS


def write_lines(path, files, per_file):
    path.mkdir()
    expected = []
    for k in range(files):
        lines = [f"{(k * per_file + i) * 7919 % 10007},{'x' * (i % 50)}" for i in range(per_file - k)]
        (path / f"part-{k:02d}.csv").write_text("v,w\n" + "\n".join(lines) + "\n")
        expected += [line.split(",")[0] for line in lines]
    (path / "part-99.csv").write_text("v,w\n")
    return expected


def test_index_follows_files_over_many_splits(spark, tmp_path):
    expected = write_lines(tmp_path / "d", 5, 900)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "500")
    try:
        df, place = placed(FS.read_text_csv(spark, str(tmp_path / "d")))
        assert df.rdd.getNumPartitions() > 10
        out = with_file_index(df, place, "i")
        assert out.columns == ["v", "w", "i"]
        rows = sorted(out.collect(), key=lambda r: r["i"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert [r["i"] for r in rows] == list(range(len(expected)))
    assert [r["v"] for r in rows] == expected


def test_no_sort_of_the_rows(spark, tmp_path):
    write_lines(tmp_path / "d", 2, 50)
    df, place = placed(FS.read_text_csv(spark, str(tmp_path / "d")))
    plan = with_file_index(df, place)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_clashing_names_and_empty_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text(f"{PLACE},_metadata,path,at\n1,2,3,4\n5,6,7,8\n")
    df, place = placed(FS.read_text_csv(spark, str(tmp_path / "d")))
    assert place != PLACE
    got = with_file_index(df, place, "i").orderBy("i").collect()
    assert [tuple(r) for r in got] == [("1", "2", "3", "4", 0), ("5", "6", "7", "8", 1)]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("a,b\n")
    df, place = placed(FS.read_text_csv(spark, str(tmp_path / "e")))
    assert with_file_index(df, place).count() == 0


def test_samples_are_the_first_rows_in_their_types(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("n,x,t,price\n9,1.50,b,10\n10,n/a,a,11\n")
    (tmp_path / "d" / "b.csv").write_text("n,x,t,price\n" + "".join(f"{k},2,c,12\n" for k in range(6)))
    raw = FS.read_text_csv(spark, str(tmp_path / "d"))
    prof = PR.column_profile(raw, "f", "sales", untyped=True)
    got = {r["column"]: r["samples"] for r in PR.file_samples(raw, "f", prof).collect()}
    assert got == {"n": "9 | 10 | 0 | 1 | 2", "x": "1.5 | None | 2.0 | 2.0 | 2.0", "t": "b | a | c | c | c", "price": "10 | 11 | 12 | 12 | 12"}
    assert all(not r["issues"] for r in prof.collect())
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("n,x\n")
    raw = FS.read_text_csv(spark, str(tmp_path / "e"))
    prof = PR.column_profile(raw, "f", "sales", untyped=True)
    assert [r["samples"] for r in PR.file_samples(raw, "f", prof).collect()] == ["", ""]
