from datetime import datetime

from pyspark.sql import functions as F

from shelflens import constants as K
from shelflens.functions import cleaning as CL
from shelflens.functions import dates as D
from shelflens.operators import cleaning as CLN


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).first()["o"]


def test_currency(spark):
    assert one(spark, CL.clean_currency, "$1,234.50") == 1234.5
    assert one(spark, CL.clean_currency, '"1,200"') == 1200.0
    assert one(spark, CL.clean_currency, "n/a") is None


def test_quantity(spark):
    assert one(spark, CL.clean_quantity, "n/a") == 0.0
    assert one(spark, CL.clean_quantity, "-3") == 0.0
    assert one(spark, CL.clean_quantity, "7") == 7.0


def test_percentage(spark):
    assert one(spark, CL.clean_percentage, "12.5%") == 0.125
    assert one(spark, CL.clean_percentage, "5%%") == 0.05


def test_excel_text(spark):
    assert one(spark, CL.unwrap_excel_text, '="ABC123"') == "ABC123"
    assert one(spark, CL.unwrap_excel_text, "plain") == "plain"


def test_gmt_two_digit_years(spark):
    parse = lambda c: D.parse_gmt_timestamp(c, K.GMT_FORMAT)
    assert one(spark, parse, "01/02/95 13:45:00 GMT (PST)") == datetime(1995, 1, 2, 13, 45)
    assert one(spark, parse, "1/2/01 3:04:05 GMT") == datetime(2001, 1, 2, 3, 4, 5)
    assert one(spark, parse, "12/31/69 00:00:00 GMT (X)") == datetime(1969, 12, 31)
    assert one(spark, parse, "2024-05-06") == datetime(2024, 5, 6)
    assert one(spark, parse, "garbage GMT") is None


def test_generic_dates(spark):
    for text, exp in [("2024-05-06", datetime(2024, 5, 6)), ("5/6/2024", datetime(2024, 5, 6)),
                      ("2024-05-06 07:08:09", datetime(2024, 5, 6, 7, 8, 9))]:
        assert one(spark, D.parse_timestamp, text) == exp
    assert one(spark, D.parse_timestamp, "not a date") is None


def test_parse_bool(spark):
    vals = ["True", "false", "yes", "no", "1", "0", "maybe", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r["o"] for r in df.select(CL.parse_bool(F.col("v")).alias("o")).collect()]
    assert got == [True, False, True, False, True, False, None, None]


def test_money_columns_by_name(spark):
    df = spark.createDataFrame([("$1,000.00", "$5", "note $")], "`Item Price` string, Units string, Comment string")
    out = CLN.clean_money_columns(df).first()
    assert out["Item Price"] == 1000.0 and out["Units"] == "$5" and out["Comment"] == "note $"


def test_clean_inventory_renames_and_fills(spark):
    df = spark.createDataFrame([("S1", None, "$2.50", "4"), (None, "T", None, None)],
                               "`seller-sku` string, `item-name` string, price string, quantity string")
    rows = CLN.clean_inventory(df).orderBy("Price").collect()
    assert rows[0].asDict() == {"SKU": "UNKNOWN", "Title": "T", "Price": 0.0, "Quantity": 0.0}
    assert rows[1].asDict() == {"SKU": "S1", "Title": "UNKNOWN", "Price": 2.5, "Quantity": 4.0}


def test_parsing_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, D.parse_timestamp, "2024-03-10 02:30:00") == datetime(2024, 3, 10, 2, 30)
        assert one(spark, D.parse_timestamp, "3/10/2024 2:30") == datetime(2024, 3, 10, 2, 30)
        gmt = lambda c: D.parse_gmt_timestamp(c, K.GMT_FORMAT)
        assert one(spark, gmt, "03/10/24 02:30:00 GMT (PST)") == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
