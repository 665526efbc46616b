from shelflens.operators import profile as PR


def test_profile_missing_and_issues(spark):
    df = spark.createDataFrame([("2024-01-01", "$1,000", "5%"), ("bad date", None, "7")],
                               "Date string, `Ordered Product Sales` string, late_rate string")
    prof = {r["column"]: r for r in PR.column_profile(df, "t", "sales").collect()}
    assert prof["Ordered Product Sales"]["missing_count"] == 1
    assert prof["Ordered Product Sales"]["missing_pct"] == 50.0
    assert prof["Date"]["issues"] == ["Date format inconsistencies detected"]
    assert prof["Ordered Product Sales"]["issues"] == ["Currency formatting in column: Ordered Product Sales"]
    perf = {r["column"]: r for r in PR.column_profile(df, "t", "performance").collect()}
    assert perf["late_rate"]["issues"] == ["Percentage formatting in column: late_rate"]
    assert perf["Date"]["issues"] == ["Date format inconsistencies in column: Date"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string, b double")
    c = PR.table_counts(df, "t").first()
    assert c["row_count"] == 0 and c["column_count"] == 0 and c["issues"] == ["Empty or invalid DataFrame"]
    prof = PR.column_profile(df, "t", "inventory").collect()
    assert all(r["missing_pct"] == 0.0 for r in prof)


def test_samples_in_key_order(spark):
    df = spark.createDataFrame([(i, None if i == 2 else f"v{i}") for i in range(10, 0, -1)], "k long, v string")
    s = {r["column"]: r["samples"] for r in PR.column_samples(df, "t", "k").collect()}
    assert s["k"] == "1 | 2 | 3 | 4 | 5" and s["v"] == "v1 | None | v3 | v4 | v5"


def test_unparseable_currency_issue(spark):
    df = spark.createDataFrame([("$1,000",), ("soon",), ("n/a",)], "`Item Price` string")
    prof = {r["column"]: r for r in PR.column_profile(df, "t", "sales").collect()}
    assert "Unparseable currency values in column: Item Price" in prof["Item Price"]["issues"]
