import os
from datetime import datetime

from pyspark.sql import types as T

from shelflens.sources import files as FS
from shelflens.sources import marketplace as MP


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_ragged_csv(spark, tmp_out):
    """Short rows kept with a NULL tail, over-long rows dropped, quoted commas respected."""
    p = write(os.path.join(tmp_out, "m.csv"),
              'Column1,Column2\nValue1,Value2\nValue3,Value4\nMissingColumn\nExtra,Columns,Here\n"a,b",c\n')
    rows = FS.read_ragged_csv(spark, p, ["Column1", "Column2"]).collect()
    assert [(r[0], r[1]) for r in rows] == [("Value1", "Value2"), ("Value3", "Value4"),
                                           ("MissingColumn", None), ("a,b", "c")]


def test_sales_report_reader(spark, tmp_out):
    header = ",".join(f'"{c}"' for c in FS.K.SALES_REPORT_COLUMNS)
    tail = "," * 13                      # 13 empty trailing columns (18 in all)
    body = ('2024-01-02,"$1,200.50",$0.00,3,0' + tail + "\n"
            + "2024-01-01,$10.00,$0.00,n/a,0" + tail + "\n")
    p = write(os.path.join(tmp_out, "sales.csv"), header + "\n" + body)
    rows = FS.read_sales_report(spark, p).orderBy("Date").collect()
    assert [r["SKU"] for r in rows] == ["SALE_20240101_1", "SALE_20240102_0"]      # numbered as in the file
    assert rows[1]["OrderedProductSales"] == 1200.5 and rows[1]["quantity"] == 3.0
    assert rows[0]["quantity"] == 0.0 and rows[0]["Sales"] == 10.0


def test_listing_tsv(spark, tmp_out):
    p = write(os.path.join(tmp_out, "inv.txt"),
              "seller-sku\tasin1\titem-name\tprice\tquantity\thas_image\n"
              "S1\tB1\tBook One\t$3.50\t-2\ttrue\nS2\tB2\tBook Two\tbad\t4\t\n")
    rows = {r["SKU"]: r for r in FS.read_listing_tsv(spark, p).collect()}
    assert rows["S1"]["Price"] == 3.5 and rows["S1"]["quantity"] == 0.0 and rows["S1"]["Has_Image"] is True
    assert rows["S2"]["Price"] == 0.0 and rows["S2"]["quantity"] == 4.0 and rows["S2"]["Has_Image"] is False
    assert rows["S1"]["ISBN"] == "" and rows["S1"]["Title"] == "Book One"


def test_first_readable_and_empty(spark, tmp_out):
    p = write(os.path.join(tmp_out, "perf.csv"), "Date,late_shipment_rate\n2024-01-01,0.1\n")
    reader = lambda path: FS.read_performance(spark, path)
    df = FS.first_readable(spark, [os.path.join(tmp_out, "missing.csv"), p], reader)
    assert df.count() == 1 and dict(df.dtypes)["late_shipment_rate"] == "double"
    assert FS.first_readable(spark, [os.path.join(tmp_out, "nope.csv")], reader) is None
    empty = FS.empty_frame(spark, FS.EMPTY_SALES)
    assert empty.columns == list(FS.EMPTY_SALES) and empty.count() == 0


def test_report_round_trip(spark, tmp_out):
    df = spark.createDataFrame([("A", "⚠️", 1.5)], "SKU string, Flag string, Price double")
    path = FS.write_report(df, os.path.join(tmp_out, "rep"), fmt="csv")
    back = FS.read_report(spark, path, T.StructType([T.StructField("SKU", T.StringType()),
                                                      T.StructField("Flag", T.StringType()),
                                                      T.StructField("Price", T.DoubleType())]))
    assert back.first().asDict() == {"SKU": "A", "Flag": "⚠️", "Price": 1.5}


def test_sales_history_bounds(spark):
    as_of = datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", datetime(2023, 1, 1)), ("B", datetime(2022, 12, 31)),
                                ("C", datetime(2024, 1, 2))], "SKU string, Date timestamp_ntz")
    assert sorted(r["SKU"] for r in MP.sales_history(df, as_of).collect()) == ["A"]


def test_catalog_lookup_and_enrich(spark):
    cat = spark.createDataFrame([("A", "a1", "t", "au", "i", True, "2000-01-01"),
                                 ("B", "b1", "t", "au", None, False, "2000-01-01")],
                                "SKU string, ASIN string, Title string, Author string, ISBN string, "
                                "Has_Image boolean, Publication_Date string")
    skus = spark.createDataFrame([("B",), ("B",), (None,)], "SKU string")
    assert [r["SKU"] for r in MP.catalog_lookup(cat, skus).collect()] == ["B"]
    inv = spark.createDataFrame([("A", 1.0), ("Z", 2.0)], "SKU string, Price double")
    rows = {r["SKU"]: r for r in MP.enrich_with_catalog(inv, cat).collect()}
    assert rows["A"]["ISBN"] == "i" and rows["Z"]["Author"] is None


def test_inventory_summary_columns_and_marketplace(spark):
    snap = spark.createDataFrame([("A", "a", "t", "New", 1.0, 2, "M1"), ("B", "b", "t", "Used", 2.0, 0, "M2")],
                                 "SKU string, ASIN string, Title string, Condition string, Price double, "
                                 "Quantity long, marketplace_id string")
    out = MP.inventory_summary(snap, "M1")
    assert out.columns == MP.SUMMARY_COLUMNS and [r["SKU"] for r in out.collect()] == ["A"]
    assert MP.inventory_summary(snap).count() == 2


def test_demo_data_shapes(spark):
    sales, inv = MP.demo_data(spark, datetime(2024, 1, 1))
    assert sales.count() == 5 and inv.count() == 5
    assert set(inv.columns) == {"SKU", "Title", "ISBN", "Price", "Has_Image", "quantity"}
