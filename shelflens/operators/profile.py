"""Data profiling (D1-D7) in one aggregation pass per table.

For every column one global ``agg`` computes the non-null count and the issue
indicators (partial aggregates per task, one tiny final merge); the single
result row is then exploded to one row per column.  Samples are a top-k
(``orderBy(key).limit(5)``), so no task ever sees more than 5 rows of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions import cleaning as CL
from shelflens.operators import text_types as TT
from shelflens.operators.file_order import placed
from shelflens.functions.dates import parse_timestamp

# fixed values: issue texts
ISSUE_EMPTY = "Empty or invalid DataFrame"
ISSUE_SALES_DATE = "Date format inconsistencies detected"
ISSUE_DATE_COLUMN = "Date format inconsistencies in column: {}"
ISSUE_CURRENCY = "Currency formatting in column: {}"
ISSUE_PERCENT = "Percentage formatting in column: {}"
ISSUE_UNPARSEABLE = "Unparseable currency values in column: {}"   # ours: bad values become NULL

FAMILIES = ("sales", "inventory", "performance")
SAMPLE_ROWS = 5


def _hinted(name: str, hints) -> bool:
    return any(h in name.lower() for h in hints)


def _issue_checks(field: T.StructField, family: str) -> list[tuple[str, object]]:
    """(issue text, column expression that is 1 on an offending row)."""
    name, dtype = field.name, field.dataType
    is_text = isinstance(dtype, T.StringType)
    c = TT.present(F.col(f"`{name}`")) if is_text else F.col(f"`{name}`")
    checks = []
    bad_date = (c.isNotNull() & parse_timestamp(c).isNull()) if is_text else F.lit(False)
    if family == "sales":
        if name == "Date":
            checks.append((ISSUE_SALES_DATE, bad_date))
        if is_text and _hinted(name, K.MONEY_NAME_HINTS):
            checks.append((ISSUE_CURRENCY.format(name), CL.has_money_text(c)))
            checks.append((ISSUE_UNPARSEABLE.format(name), c.isNotNull() & CL.clean_currency(c).isNull()))
    elif family == "performance":
        if _hinted(name, K.TIME_NAME_HINTS):
            checks.append((ISSUE_DATE_COLUMN.format(name), bad_date))
        if is_text and _hinted(name, K.PERCENT_NAME_HINTS):
            checks.append((ISSUE_PERCENT.format(name), CL.has_percent_text(c)))
    return checks


def column_profile(df: DataFrame, table: str, family: str, types: bool = True, issues: bool = True,
                   untyped: bool = False) -> DataFrame:
    """One row per column: table, ordinal, column, data_type, row_count,
    missing_count, missing_pct (one decimal, 0 when empty), issues (array).

    Missing-value tokens of text columns count as missing.  The type of a text
    column is decided by its values: ``bigint`` if all are whole numbers and
    none is missing, ``double`` if the present ones are numbers (or there are
    none), else ``string``.  Type and issue checks that are not asked for
    (``types``, ``issues``) are left out of the plan.  ``untyped`` says that the
    columns are a file's text whose types are still open: one whose present values are
    all numbers is a number, and text issues are not its own.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}")
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    issue_names: list[list[str]] = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text_column = TT.is_text(f)
        aggs.append(F.count(TT.present(c) if text_column else c).alias(f"__nn{i}"))
        if types and text_column:
            aggs.append(F.bool_and(TT.matches(c, TT.NUMBER)).alias(f"__num{i}"))
            aggs.append(F.bool_and(F.coalesce(TT.matches(c, TT.WHOLE), F.lit(False))).alias(f"__int{i}"))
        names = []
        for j, (text, pred) in enumerate(_issue_checks(f, family) if issues else ()):
            aggs.append(F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0))).alias(f"__is{i}_{j}"))
            names.append(text)
        if untyped and text_column and names and not types:
            aggs.append(F.bool_and(TT.matches(c, TT.NUMBER)).alias(f"__num{i}"))
        issue_names.append(names)
    one = df.agg(*aggs)
    rows = F.col("__rows")
    structs = []
    for i, f in enumerate(fields):
        missing = rows - F.col(f"__nn{i}")
        data_type = F.lit(f.dataType.simpleString())
        if types and TT.is_text(f):
            data_type = (F.when(rows == 0, data_type).when(F.col(f"__int{i}"), F.lit("bigint"))
                         .when(F.coalesce(f"__num{i}", F.lit(True)), F.lit("double")).otherwise(F.lit("string")))
        as_number = F.coalesce(F.col(f"__num{i}"), F.lit(False)) if untyped and TT.is_text(f) and issue_names[i] else F.lit(False)
        found = F.array(*[F.when((F.col(f"__is{i}_{j}") == 1) & ~as_number, F.lit(t)) for j, t in enumerate(issue_names[i])]) \
            if issue_names[i] else F.array().cast("array<string>")
        structs.append(F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column"),
            data_type.alias("data_type"),
            rows.alias("row_count"),
            missing.alias("missing_count"),
            F.when(rows > 0, F.round(missing * 100.0 / rows, 1)).otherwise(F.lit(0.0)).alias("missing_pct"),
            F.filter(found, lambda x: x.isNotNull()).alias("issues")))
    return (one.select(F.explode(F.array(*structs)).alias("s"))
            .select(F.lit(table).alias("table"), "s.*"))


def table_counts(df: DataFrame, table: str) -> DataFrame:
    """Row and column count; an empty table carries the empty-table issue."""
    n_cols = len(df.columns)
    one = df.agg(F.count(F.lit(1)).alias("row_count"))
    return one.select(
        F.lit(table).alias("table"),
        F.col("row_count"),
        F.when(F.col("row_count") > 0, F.lit(n_cols)).otherwise(F.lit(0)).alias("column_count"),
        F.when(F.col("row_count") > 0, F.array().cast("array<string>"))
         .otherwise(F.array(F.lit(ISSUE_EMPTY))).alias("issues"))


def file_samples(scan: DataFrame, table: str, profile: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """D4 for a file read as text: the first ``n`` values of every column as the files hold
    them (a top-k by place, no sort), shown in the type that ``profile`` found."""
    rows, place = placed(TT.missing_to_null(scan))
    head = rows.orderBy(place).limit(n)
    names = scan.columns
    gathered = head.agg(F.sort_array(F.collect_list(F.struct(F.col(place).alias("__key"), *[
        F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(names)]))).alias("__rows"))

    def field_of(i):
        return lambda r: r[f"__v{i}"]
    values = gathered.select(F.explode(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.transform(
        "__rows", field_of(i)).alias("__values")) for i, c in enumerate(names)])).alias("s")).select("s.*")
    shown = F.transform("__values", lambda v: F.coalesce(
        F.when(F.col("data_type") == "double", F.trim(v).try_cast(T.DoubleType()).cast(T.StringType()))
        .when(F.col("data_type") == "bigint", F.trim(v).try_cast(T.LongType()).cast(T.StringType())).otherwise(v), F.lit("None")))
    return (values.join(profile.select("ordinal", "data_type"), "ordinal")
            .select(F.lit(table).alias("table"), "ordinal", "column", F.array_join(shown, " | ").alias("samples")))


def column_samples(df: DataFrame, table: str, order_by, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` values of every column in ``order_by`` order, as text
    (``NULL`` shown as the string ``None``), joined with ``' | '``."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    head = df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order_by]).limit(n)
    keyed = head.select(F.struct(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(order_by)]).alias("__key"),
                        *[F.coalesce(F.col(f"`{f.name}`").cast(T.StringType()), F.lit("None")).alias(f"__v{i}")
                          for i, f in enumerate(df.schema.fields)])
    gathered = keyed.agg(F.sort_array(F.collect_list(F.struct("__key", *[f"__v{i}" for i in range(len(df.columns))])))
                         .alias("__rows"))
    def field_of(i):
        return lambda r: r[f"__v{i}"]

    structs = [F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"),
                        F.array_join(F.transform("__rows", field_of(i)), " | ").alias("samples"))
               for i, f in enumerate(df.schema.fields)]
    return gathered.select(F.explode(F.array(*structs)).alias("s")).select(F.lit(table).alias("table"), "s.*")


def column_issues(profile: DataFrame) -> DataFrame:
    """One row per (table, column, issue)."""
    return (profile.select("table", "column", F.explode("issues").alias("issue")))


def profile_report(profiles: list[DataFrame], samples: list[DataFrame]) -> DataFrame:
    """All tables, one row per column with type, missing share, issues, samples."""
    prof = profiles[0]
    for p in profiles[1:]:
        prof = prof.unionByName(p)
    samp = samples[0]
    for s in samples[1:]:
        samp = samp.unionByName(s)
    return (prof.join(samp, ["table", "ordinal", "column"], "left")
            .select("table", "ordinal", "column", "data_type", "row_count", "missing_count",
                    "missing_pct", F.array_join("issues", "; ").alias("issues"), "samples"))
