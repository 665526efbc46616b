"""File sources and sinks.

Every reader declares its schema (all text for vendor files) so no pass is
spent on inference, and file splits replace the reference's 10,000-row
chunks.  Paths may be local, HDFS or object-store URIs.
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions import cleaning as CL
from shelflens.functions.dates import parse_timestamp, ts_literal
from shelflens.operators import columns as C
from shelflens.operators import text_types as TT
from shelflens.operators.file_order import placed, with_file_index
from shelflens.operators.ordering import with_row_index

log = logging.getLogger(__name__)


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# -- A2 / A5 -------------------------------------------------------------------
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def first_readable(spark: SparkSession, candidates, reader):
    """First candidate that exists and whose reader succeeds (plan-time check)."""
    for path in candidates:
        if not path_exists(spark, path):
            continue
        try:
            df = reader(path)
            df.schema  # noqa: B018 - forces header/schema resolution
            return df
        except Exception as problem:  # noqa: BLE001 - a bad file falls through to the next
            log.warning("Skipped %s: %s", path, problem)
    return None


def empty_frame(spark: SparkSession, names, types=None) -> DataFrame:
    types = types or {}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    return spark.createDataFrame([], schema)


EMPTY_SALES = ("Date", "SKU", "quantity", "Sales")
EMPTY_LISTINGS = ("SKU", "Title", "Price", "Has_Image", "ISBN", "quantity")


# -- A1 / B10 / B8 ---------------------------------------------------------------
def daily_sales_projection(raw: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The raw report columns plus typed ``Date``, ``OrderedProductSales``,
    ``Sales`` (missing -> 0) and ``quantity`` (missing/negative -> 0).

    The reference also writes ``Quantity``; Spark cannot hold it beside
    ``quantity`` (names are case-insensitive), so only the canonical one is kept.
    """
    ex = C.ExactColumns(raw)
    if ex.has("Date"):
        date = parse_timestamp(ex.col("Date"))
    else:
        if as_of is None:
            raise ValueError("a report without a Date column needs as_of")
        date = ts_literal(as_of, T.TimestampNTZType())
    ops = (CL.clean_currency(ex.col("Ordered Product Sales"), ex.dtype("Ordered Product Sales"))
           if ex.has("Ordered Product Sales") else F.lit(None).cast(T.DoubleType()))
    units = (CL.clean_quantity(ex.col("Units Ordered"), ex.dtype("Units Ordered"))
             if ex.has("Units Ordered") else F.lit(0.0))
    derived = {"date", "orderedproductsales", "sales", "quantity"}
    keep = [(n, ex.col(n)) for n in ex.names if n.lower() not in derived]
    return ex.select(keep + [
        ("Date", date),
        ("OrderedProductSales", ops),
        ("Sales", F.coalesce(ops, F.lit(0.0))),
        ("quantity", units),
    ])


def synthetic_sku(df: DataFrame, place: str | None = None) -> DataFrame:
    """``SALE_<yyyyMMdd>_<row index>``; the index is contiguous and follows the order
    of the files if ``place`` names the column that ``file_order.placed`` gave the scan
    (the column goes), else the Date."""
    if place is not None:
        indexed = with_file_index(df, place, "__row")
    else:
        indexed = with_row_index(df, [F.col("Date").asc_nulls_last()], "__row")
    return indexed.withColumn(
        "SKU", F.concat_ws("_", F.lit("SALE"), F.date_format("Date", "yyyyMMdd"),
                           F.col("__row").cast(T.StringType()))).drop("__row")


def read_sales_report(spark: SparkSession, path: str, as_of: datetime | None = None,
                      with_sku: bool = True) -> DataFrame:
    """A1: 18 fixed text columns, header skipped, normal CSV quoting; SKUs number the
    rows as the files hold them."""
    raw = (spark.read.schema(text_schema(K.SALES_REPORT_COLUMNS))
           .option("header", True).option("encoding", "UTF-8").csv(path))
    return sales_lines(raw, as_of, with_sku)


def sales_lines(scan: DataFrame, as_of: datetime | None = None, with_sku: bool = True) -> DataFrame:
    """B10 and B8 on the scan of a daily report."""
    names = ["Date", "OrderedProductSales", "Sales", "quantity"]
    if not with_sku:
        return daily_sales_projection(TT.missing_to_null(scan), as_of).select(*names)
    scan, place = placed(scan)
    return synthetic_sku(daily_sales_projection(TT.missing_to_null(scan), as_of).select(*names, place), place)


# -- A3 ------------------------------------------------------------------------
def read_listing_tsv(spark: SparkSession, path: str, names=None) -> DataFrame:
    """Tab-separated listing report, header row, all text, then standardised."""
    reader = spark.read.option("sep", "\t").option("header", True).option("encoding", "UTF-8")
    if names is not None:
        reader = reader.schema(text_schema(names))
    return C.standardize_listing(TT.missing_to_null(reader.csv(path)))


# -- A4 ------------------------------------------------------------------------
def read_performance(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     sampling_ratio: float = 1.0) -> DataFrame:
    """Seller performance CSV.  Without ``schema`` the values decide each column's type
    (INT, BIGINT, DOUBLE, DATE, TIMESTAMP, BOOLEAN or text; missing-value tokens are NULL
    and make whole numbers DOUBLE) in one aggregate over the file, or over a share of its
    rows: values that do not fit a type decided on a share become NULL."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    raw = reader.csv(path)
    seen = raw if sampling_ratio >= 1.0 else raw.sample(sampling_ratio, seed=0)
    return TT.typed(raw, TT.kinds(seen, calendar=True))


def read_text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A vendor file with a header, every column as text."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)


def read_typed_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A vendor file with a header: missing-value tokens become NULL, columns
    whose present values are all numbers become numeric, the rest stays text."""
    return TT.typed(read_text_csv(spark, path, sep))


# -- A9 ------------------------------------------------------------------------
def _field_count(line):
    """Fields in a CSV line, commas inside double quotes not counted."""
    unquoted = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(unquoted) - F.length(F.regexp_replace(unquoted, ",", "")) + F.lit(1)


def read_ragged_csv(spark: SparkSession, path: str, names, header: bool = True) -> DataFrame:
    """Short rows keep NULL tails; rows with more fields than ``names`` are dropped.

    Lines are read as text and parsed with ``from_csv`` next to a quote-aware
    field count, so the over-long test is an ordinary column predicate.
    With ``header`` the first line of each file is left out, and only that: a
    data line with the same text stays.  Missing-value tokens become NULL.
    """
    # one unquoted column per line, so that the reader itself drops each file's first line
    lines = (spark.read.schema("value STRING").option("header", header).option("sep", "\x01").option("quote", "")
             .option("escape", "").option("emptyValue", "").option("maxCharsPerColumn", -1).csv(path))
    lines = lines.where(F.length(F.trim("value")) > 0)
    ddl = ", ".join(f"`{n}` STRING" for n in names)
    parsed = lines.select(F.from_csv("value", ddl, {"mode": "PERMISSIVE"}).alias("r"),
                          _field_count(F.col("value")).alias("__nf"))
    return parsed.where(F.col("__nf") <= F.lit(len(names))).select(
        *[TT.present(F.col("r").getField(n)).alias(n) for n in names])


# -- A10 / A11 -----------------------------------------------------------------
def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Report sink; CSV gets a header row, parquet keeps types."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None,
                fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        r = spark.read.option("header", True).option("encoding", "UTF-8")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    return spark.read.format(fmt).load(path)
