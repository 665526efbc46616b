"""Files as vendors send them: tokens, types by value, rows equal to the header."""
import pytest

from shelflens.operators import cleaning as CLN
from shelflens.operators import profile as PR
from shelflens.operators import text_types as TT
from shelflens.plans import performance as PF
from shelflens.sources import files as FS


def write(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text)
    return str(path)


@pytest.fixture
def perf(spark, tmp_path):
    return FS.read_typed_csv(spark, write(tmp_path / "perf", "Date,on_time_delivery_rate,order_defect_rate,note\n"
                                          '1/2/25 03:04:05 GMT (x),98.5%,0.02,a\n1/3/25 03:04:05 GMT (x),97.5%,n/a,b\n1/4/25 03:04:05 GMT (x),NA,0.04,\n'))


def test_rates_survive_cleaning(perf):
    out = CLN.clean_performance(perf)
    rows = out.orderBy("Date").collect()
    assert [r.on_time_delivery_rate for r in rows] == [0.985, 0.975, None]
    assert [r.order_defect_rate for r in rows] == [0.02, None, 0.04]
    assert dict(out.dtypes)["Date"].startswith("timestamp") and rows[0].note == "a"


def test_numeric_text_is_not_a_percentage(spark):
    df = spark.createDataFrame([("0.02", "2%"), ("n/a", "4%")], "defect_rate string, late_rate string")
    assert [tuple(r) for r in CLN.clean_percent_columns(df).collect()] == [(0.02, 0.02), (None, 0.04)]


def test_a_bad_value_does_not_fail_the_summary(spark, perf):
    df = spark.createDataFrame([("0.5", "2025-01-01"), ("n/a", "2025-01-02"), ("1.5", "x")], "order_defect_rate string, Date string")
    got = {r.statistic: r.order_defect_rate for r in PF.performance_summary(df).collect()}
    assert got["count"] == 2 and got["mean"] == 1.0
    assert PF.performance_trend(df).count() == 3


def test_types_by_value(spark):
    df = spark.createDataFrame([("1", "1", "1.5", "x", "NA", "1d"), ("2", "n/a", "2", "3", None, "2")], "a string, b string, c string, d string, e string, f string")
    assert [t for _, t in TT.typed(df).dtypes] == ["bigint", "double", "double", "string", "string", "string"]
    prof = {r.column: (r.data_type, r.missing_count) for r in PR.column_profile(df, "t", "inventory").collect()}
    assert prof == {"a": ("bigint", 0), "b": ("double", 1), "c": ("double", 0), "d": ("string", 0), "e": ("double", 2), "f": ("string", 0)}
    assert TT.typed(df.limit(0)).count() == 0


def test_missing_profile_plan_has_no_issue_checks(spark):
    df = spark.createDataFrame([("1", "$2")], "Date string, price string")
    plan = PR.column_profile(df, "t", "sales", types=False, issues=False)._jdf.queryExecution().toString()
    assert "RLIKE" not in plan.upper() and "timestamp" not in plan.lower()


def test_only_the_first_line_of_each_file_is_a_header(spark, tmp_path):
    path = tmp_path / "ragged"
    path.mkdir()
    for k in range(2):
        (path / f"{k}.csv").write_text('a,b\n1,2\na,b\n3\n"x,y",z\n1,2,3\n\n')
    rows = sorted((tuple(r) for r in FS.read_ragged_csv(spark, str(path), ["a", "b"]).collect()), key=str)
    assert rows == sorted(2 * [("1", "2"), ("a", "b"), ("3", None), ("x,y", "z")], key=str)


def test_unreadable_candidates_are_logged(spark, tmp_path, caplog):
    good = write(tmp_path / "good", "a\n1\n")

    def reader(p):
        if p.endswith("bad"):
            raise ValueError("broken")
        return spark.read.option("header", True).csv(p)

    (tmp_path / "bad").mkdir()
    with caplog.at_level("WARNING"):
        assert FS.first_readable(spark, [str(tmp_path / "none"), str(tmp_path / "bad"), good], reader).count() == 1
    assert "broken" in caplog.text


def test_a_report_without_dates_needs_as_of(spark):
    with pytest.raises(ValueError):
        FS.daily_sales_projection(spark.createDataFrame([("1",)], "`Units Ordered` string"))


def test_catalog_choice_does_not_depend_on_the_input_order(spark):
    from shelflens.sources.marketplace import enrich_with_catalog
    rows = [("A", "z", "2"), ("A", "b", "1"), ("A", "b", "0")]
    listings = spark.createDataFrame([("A",), ("B",), (None,)], "SKU string")
    for order in (rows, rows[::-1]):
        got = enrich_with_catalog(listings, spark.createDataFrame(order, "SKU string, Author string, ISBN string")).collect()
        assert {(r.SKU, r.Author, r.ISBN) for r in got} == {("A", "b", "0"), ("B", None, None), (None, None, None)}


def test_revenue_is_not_rounded_per_line(spark):
    from datetime import datetime
    from shelflens.operators.sales_metrics import revenue_windows
    sales = spark.createDataFrame([("A", datetime(2025, 1, 1), 100.0, 0.125)], "SKU string, Date timestamp_ntz, quantity double, Price double")
    assert revenue_windows(sales, datetime(2025, 1, 2)).first()["Revenue_30d"] == 12.5


def jobs_of(spark, group, work):
    """Jobs started; without AQE (which starts one a stage) a job is one scan here."""
    spark.sparkContext.setJobGroup(group, group)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        work()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_reading_and_cleaning_scans_a_file_twice(spark, tmp_path):
    path = write(tmp_path / "perf", "Date,on_time_rate,order_defect_rate,end_time,note\n1/2/25 03:04:05 GMT (x),98.5%,0.02,x,a\n1/3/25 03:04:05 GMT (x),97.5%,n/a,y,b\n")
    out = []
    # the header line, the types, the result
    assert jobs_of(spark, "clean", lambda: out.extend(CLN.clean_performance_text(FS.read_text_csv(spark, path)).collect())) == 3
    assert sorted(tuple(r)[1:] for r in out) == [(0.975, None, "y", "b"), (0.985, 0.02, "x", "a")]
    assert jobs_of(spark, "read", lambda: FS.read_performance(spark, path).collect()) == 3


def test_performance_types(spark, tmp_path):
    path = write(tmp_path / "perf", "a,b,c,d,e,f,g,h\n1,99999999999,1.5,2024-01-02,2024-01-02 03:04:05,true,2024,x\n2,1,2,2024-02-03,2024-01-02T03:04:06,FALSE,n/a,\n")
    df = FS.read_performance(spark, path)
    assert [t for _, t in df.dtypes] == ["int", "bigint", "double", "date", "timestamp", "boolean", "double", "string"]
    rows = df.orderBy("a").collect()
    assert rows[0].f is True and rows[1].g is None and rows[1].e.second == 6 and str(rows[1].d) == "2024-02-03"
    assert [t for _, t in FS.read_performance(spark, write(tmp_path / "none", "a,b\n")).dtypes] == ["string", "string"]
