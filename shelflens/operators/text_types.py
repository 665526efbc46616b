"""Missing-value tokens and column types of text read from files.

Vendor files are read as text.  What counts as missing is decided per value
(a fixed token list), what type a column has by all of its values: one
aggregate over the table, never a sample.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions.dates import parse_gmt_timestamp

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
STAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?$"
FLAG = r"(?i)^(true|false)$"


def is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def present(c: Column) -> Column:
    """The text, or NULL where it is a missing-value token."""
    return F.when(~c.isin(*K.MISSING_TOKENS), c)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Missing-value tokens of every text column become NULL."""
    return df.select(*[present(F.col(f"`{f.name}`")).alias(f.name) if is_text(f) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def holds_for_all(df: DataFrame, tests: dict[str, Column]) -> dict[str, bool]:
    """For each name whether its condition is true on every row where it is not
    NULL, and not NULL on one row at least (one aggregate for all of them)."""
    if not tests:
        return {}
    names = list(tests)
    row = df.agg(*[F.bool_and(tests[n]).alias(f"t{k}") for k, n in enumerate(names)]).first()
    return {n: row[k] is True for k, n in enumerate(names)}


def matches(c: Column, pattern: str) -> Column:
    """``rlike`` on present values, NULL on missing ones."""
    return present(c).rlike(pattern)


class Kind(NamedTuple):
    """What all present values of a text column are (no present value: nothing)."""
    number: bool = False
    whole: bool = False       # whole numbers, none missing
    small: bool = False       # and all fit an INT
    date: bool = False
    stamp: bool = False
    flag: bool = False
    time: bool = False        # asked for by name only: parses as one of the vendors' times


def _whole_cell(c: Column) -> Column:
    return F.coalesce(matches(c, WHOLE), F.lit(False))


def kinds(df: DataFrame, calendar: bool = False, times=()) -> dict[str, Kind]:
    """The kind of every text column by all of its values, from one aggregate (one scan
    of the file).  ``calendar`` also tells dates, timestamps and booleans; ``times`` names
    the columns to try as vendor times."""
    tests = {}
    for n in (f.name for f in df.schema.fields if is_text(f)):
        c = F.col(f"`{n}`")
        tests[n, "number"] = matches(c, NUMBER)
        tests[n, "whole"] = _whole_cell(c)
        if calendar:
            tests[n, "small"] = _whole_cell(c) & F.trim(c).try_cast(T.IntegerType()).isNotNull()
            tests[n, "date"] = matches(c, DATE) & c.try_cast(T.DateType()).isNotNull()
            tests[n, "stamp"] = matches(c, STAMP) & c.try_cast(T.TimestampType()).isNotNull()
            tests[n, "flag"] = matches(c, FLAG)
        if n in times:
            tests[n, "time"] = F.when(present(c).isNotNull(), parse_gmt_timestamp(c, K.GMT_FORMAT).isNotNull())
    found = holds_for_all(df, tests)
    return {n: Kind(**{kind: held for (name, kind), held in found.items() if name == n})
            for n in dict.fromkeys(n for n, _ in tests)}


def _type_of(kind: Kind) -> T.DataType | None:
    if kind.number:
        return (T.IntegerType() if kind.small else T.LongType()) if kind.whole else T.DoubleType()
    return T.DateType() if kind.date else T.TimestampType() if kind.stamp else T.BooleanType() if kind.flag else None


def typed(df: DataFrame, found: dict[str, Kind] | None = None) -> DataFrame:
    """Text columns whose present values are all numbers become BIGINT (whole
    numbers, none missing) or DOUBLE; tokens become NULL; the rest stays text.
    ``found`` are the kinds if they are known already; their calendar types and INT
    apply as far as they were asked for."""
    found = kinds(df) if found is None else found
    df = missing_to_null(df)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        to = _type_of(found.get(f.name, Kind()))
        out.append((c if to is None else F.trim(c).try_cast(to)).alias(f.name))
    return df.select(*out)
