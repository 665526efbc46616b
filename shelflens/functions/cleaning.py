"""Scalar cleaning expressions for vendor text (currency, %, quoting)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_text(dtype: T.DataType | None) -> bool:
    return dtype is None or isinstance(dtype, T.StringType)


def clean_currency(c: Column, dtype: T.DataType | None = None) -> Column:
    """``'$1,234.50'`` -> 1234.5; unparseable text -> NULL."""
    if not _is_text(dtype):
        return c.cast(T.DoubleType())
    stripped = F.regexp_replace(c, r'[$,"]', "")
    return F.trim(stripped).try_cast(T.DoubleType())


def clean_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text or number -> double, unparseable -> NULL (quotes dropped)."""
    if not _is_text(dtype):
        return c.cast(T.DoubleType())
    return F.trim(F.regexp_replace(c, '"', "")).try_cast(T.DoubleType())


def clean_quantity(c: Column, dtype: T.DataType | None = None) -> Column:
    """Number, missing -> 0, negative -> 0."""
    return F.greatest(F.coalesce(clean_number(c, dtype), F.lit(0.0)), F.lit(0.0))


def clean_percentage(c: Column, dtype: T.DataType | None = None) -> Column:
    """``'12.5%'`` -> 0.125 for text columns; numeric columns untouched."""
    if not _is_text(dtype):
        return c
    return F.trim(F.regexp_replace(c, "%+$", "")).try_cast(T.DoubleType()) / F.lit(100.0)


def unwrap_excel_text(c: Column) -> Column:
    """Spreadsheet-forced text ``="ABC"`` -> ``ABC``."""
    return F.regexp_replace(c, r'^="(.*)"$', "$1")


def parse_bool(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text booleans (true/false/yes/no/1/0/t/f/y/n) -> boolean, else NULL."""
    if isinstance(dtype, T.BooleanType):
        return c
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.cast(T.DoubleType()) != F.lit(0.0)
    return F.trim(c).try_cast(T.BooleanType())


def title_length(c: Column) -> Column:
    """Length in code points (same as Python ``len``)."""
    return F.char_length(c)


def has_money_text(c: Column) -> Column:
    """True when the text carries a currency sign or thousands separator."""
    return F.coalesce(c.rlike(r"[$,]"), F.lit(False))


def has_percent_text(c: Column) -> Column:
    return F.coalesce(c.contains("%"), F.lit(False))
