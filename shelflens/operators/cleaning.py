"""Table-level cleaning (C1-C10): pick columns by name hints and type at plan
time, rewrite them with the scalar expressions of ``functions.cleaning`` in a
single projection.  Unparseable values become NULL instead of failing the
file, and ``profile`` reports them as issues.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions import cleaning as CL
from shelflens.functions import dates as D
from shelflens.operators import columns as C
from shelflens.operators import text_types as TT


def _hinted(name: str, hints) -> bool:
    low = name.lower()
    return any(h in low for h in hints)


def _text_columns(df: DataFrame, hints) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and _hinted(f.name, hints)]


def clean_money_columns(df: DataFrame) -> DataFrame:
    """Text columns named like price/sales/revenue -> numbers."""
    targets = _text_columns(df, K.MONEY_NAME_HINTS)
    if not targets:
        return df
    return C._rebuild(df, {t: (lambda ex, n=t: CL.clean_currency(ex.col(n))) for t in targets})


def _kinds(df: DataFrame, targets, times=()) -> dict:
    """Kinds of these text columns (one aggregate; none without columns)."""
    names = list(dict.fromkeys([*targets, *times]))
    return TT.kinds(df.select(*[F.col(f"`{n}`") for n in names]), times=times) if names else {}


def clean_percent_columns(df: DataFrame, found: dict | None = None) -> DataFrame:
    """Text columns named like rate/percentage/pct: strip '%', divide by 100.

    A column whose present values are all plain numbers is a numeric column
    that came as text: its values are kept, only the type changes.  ``found``
    are the columns' kinds if they are known already.
    """
    targets = _text_columns(df, K.PERCENT_NAME_HINTS)
    if not targets:
        return df
    found = _kinds(df, targets) if found is None else found
    return C._rebuild(df, {t: (lambda ex, n=t: F.trim(ex.col(n)).try_cast(T.DoubleType()) if found[n].number
                               else CL.clean_percentage(ex.col(n))) for t in targets})


def clean_time_columns(df: DataFrame, hints=K.TIME_NAME_HINTS, found: dict | None = None) -> DataFrame:
    """Text columns named like date/time/period -> timestamps (GMT aware).

    Only columns whose present values all parse are converted; a column that
    merely has such a name (``on_time_delivery_rate``) is left as it is.
    ``found`` are the columns' kinds if they are known already.
    """
    targets = _text_columns(df, hints)
    found = _kinds(df, (), targets) if found is None else found
    targets = [t for t in targets if found[t].time]
    if not targets:
        return df
    return C._rebuild(df, {t: (lambda ex, n=t: D.parse_gmt_timestamp(ex.col(n), K.GMT_FORMAT))
                           for t in targets})


def unwrap_excel_columns(df: DataFrame) -> DataFrame:
    """``="ABC"`` -> ``ABC`` in SKU / sku / seller-sku text columns."""
    targets = [f.name for f in df.schema.fields
               if f.name in K.EXCEL_TEXT_COLUMNS and isinstance(f.dataType, T.StringType)]
    if not targets:
        return df
    return C._rebuild(df, {t: (lambda ex, n=t: CL.unwrap_excel_text(ex.col(n))) for t in targets})


def parse_date_column(df: DataFrame, name: str = "Date") -> DataFrame:
    """C4: ``Date`` to a timestamp unless it already is one."""
    if name not in df.columns:
        return df
    dtype = df.schema[name].dataType
    return C._rebuild(df, {name: lambda ex: D.ensure_timestamp(dtype, ex.col(name))})


def fill_defaults(df: DataFrame) -> DataFrame:
    """SKU/Title -> 'UNKNOWN', Price -> 0.0, Quantity -> 0 (when present)."""
    defaults = {"SKU": F.lit(K.UNKNOWN_TEXT), "Title": F.lit(K.UNKNOWN_TEXT),
                "Price": F.lit(0.0), "Quantity": F.lit(0)}
    changes = {}
    for name, default in defaults.items():
        if name in df.columns:
            changes[name] = lambda ex, n=name, d=default: F.coalesce(ex.col(n), d.cast(ex.dtype(n)))
    return C._rebuild(df, changes) if changes else df


def clean_quantity_column(df: DataFrame, name: str = "Quantity") -> DataFrame:
    """Quantity text -> number; missing -> 0, negative -> 0."""
    if name not in df.columns:
        return df
    dtype = df.schema[name].dataType
    return C._rebuild(df, {name: lambda ex: CL.clean_quantity(ex.col(name), dtype)})


# -- per-family compositions ---------------------------------------------------
def clean_sales(df: DataFrame) -> DataFrame:
    """C8 = C4 + C1."""
    return clean_money_columns(parse_date_column(df))


def clean_inventory(df: DataFrame) -> DataFrame:
    """C9 = B3 (rename) + C1 on Price + numeric Quantity + C3."""
    df = C.map_vendor_columns(df, K.CLEANER_COLUMN_MAP, rename=True)
    changes = {}
    if "Price" in df.columns:
        pt = df.schema["Price"].dataType
        changes["Price"] = lambda ex: CL.clean_currency(ex.col("Price"), pt)
    if "Quantity" in df.columns:
        qt = df.schema["Quantity"].dataType
        changes["Quantity"] = lambda ex: CL.clean_number(ex.col("Quantity"), qt)
    if changes:
        df = C._rebuild(df, changes)
    return fill_defaults(df)


def clean_performance(df: DataFrame, found: dict | None = None) -> DataFrame:
    """C10 = C5 + C6 + C7; the kinds of all columns come from one aggregate, or from
    ``found`` where the reader has decided them."""
    if found is None:
        found = _kinds(df, _text_columns(df, K.PERCENT_NAME_HINTS), _text_columns(df, K.TIME_NAME_HINTS))
    return clean_percent_columns(unwrap_excel_columns(clean_time_columns(df, found=found)), found)


def clean_performance_text(raw: DataFrame) -> DataFrame:
    """A performance file read as text to typed, cleaned columns: one scan decides all
    columns (number, whole, time, percent), the result's own scan is the second."""
    found = TT.kinds(raw, times=_text_columns(raw, K.TIME_NAME_HINTS))
    return clean_performance(TT.typed(raw, found), found)
