"""Column resolution: vendor names -> canonical names.

All choices here are *plan-time* decisions on ``df.columns`` / ``df.schema``;
no data is touched.  Spark resolves names case-insensitively, so ``Quantity``
and ``quantity`` collide; every function therefore first renames columns
positionally (``toDF``) and then picks sources by their exact original name.
"""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflens import constants as K
from shelflens.functions import cleaning


class ExactColumns:
    """Exact-name (case-sensitive) view over a DataFrame's columns."""

    def __init__(self, df: DataFrame):
        self.names = list(df.columns)
        self.types = [f.dataType for f in df.schema.fields]
        self.df = df.toDF(*[f"__c{i}" for i in range(len(self.names))])

    def has(self, name: str) -> bool:
        return name in self.names

    def index(self, name: str) -> int:
        return self.names.index(name)

    def col(self, name: str) -> Column:
        return F.col(f"__c{self.index(name)}")

    def dtype(self, name: str) -> T.DataType:
        return self.types[self.index(name)]

    def find_ci(self, name: str) -> str | None:
        low = name.lower()
        for n in self.names:
            if n.lower() == low:
                return n
        return None

    def select(self, outputs: list[tuple[str, Column]]) -> DataFrame:
        seen = set()
        for n, _ in outputs:
            key = n.lower()
            if key in seen:
                raise ValueError(f"duplicate output column {n!r}")
            seen.add(key)
        return self.df.select(*[c.alias(n) for n, c in outputs])


def _rebuild(df: DataFrame, changes: dict[str, Callable[[ExactColumns], Column]],
             drop: Iterable[str] = ()) -> DataFrame:
    """Keep columns in order, replace/add ``changes`` (exact names), drop ``drop``.

    A replaced column also removes any other column equal to it ignoring case,
    so the output never holds two names Spark would consider the same.
    """
    ex = ExactColumns(df)
    drop = set(drop)
    lowered = {k.lower(): k for k in changes}
    outputs: list[tuple[str, Column]] = []
    placed = set()
    for n in ex.names:
        if n in drop:
            continue
        target = lowered.get(n.lower())
        if target is not None:
            if target not in placed:
                outputs.append((target, changes[target](ex)))
                placed.add(target)
            continue
        if any(n.lower() == o.lower() for o, _ in outputs):
            continue
        outputs.append((n, ex.col(n)))
    for target, fn in changes.items():
        if target not in placed:
            outputs.append((target, fn(ex)))
    return ex.select(outputs)


# -- B1 -------------------------------------------------------------------
def normalize_quantity(df: DataFrame) -> DataFrame:
    """``Quantity`` (exact name) overwrites/creates ``quantity``."""
    if "Quantity" not in df.columns:
        return df
    return _rebuild(df, {"quantity": lambda ex: ex.col("Quantity")})


# -- B2 -------------------------------------------------------------------
def require_columns(df: DataFrame | None, required: Iterable[str], what: str) -> DataFrame:
    if df is None:
        raise ValueError(f"{what} data must be loaded before analysis")
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} data missing required columns: {missing}")
    return df


# -- B3 -------------------------------------------------------------------
def map_vendor_columns(df: DataFrame, mapping=K.LOADER_COLUMN_MAP, rename: bool = False) -> DataFrame:
    """Vendor names -> canonical names.

    ``rename=False`` (loader): canonical columns are copies, originals stay.
    ``rename=True`` (cleaner): originals are replaced.  Many-to-one is
    resolved once: the last map entry present wins, never duplicate names.
    """
    names = list(df.columns)
    winner: dict[str, str] = {}
    for src, dst in mapping:
        if src in names:
            winner[dst] = src
    if not winner:
        return df
    changes = {dst: (lambda ex, s=src: ex.col(s)) for dst, src in winner.items()}
    drop = set(winner.values()) - set(winner.keys()) if rename else set()
    if rename:
        # Every mapped source goes away, not only the winners.
        drop |= {s for s, d in mapping if s in names and s not in winner.keys() and s != d}
    return _rebuild(df, changes, drop=drop)


# -- B4 -------------------------------------------------------------------
def resolve_title(df: DataFrame) -> DataFrame:
    """If no ``Title``: first column named like name/title/description, else a constant."""
    if "Title" in df.columns:
        return df
    for n in df.columns:
        if any(h in n.lower() for h in K.TITLE_HINTS):
            return _rebuild(df, {"Title": lambda ex, s=n: ex.col(s)})
    return _rebuild(df, {"Title": lambda ex: F.lit(K.UNKNOWN_TITLE)})


# -- B5 -------------------------------------------------------------------
def ensure_columns(df: DataFrame, required=K.REQUIRED_LISTING_COLUMNS) -> DataFrame:
    """Each required column: exact name, else same name ignoring case, else default."""
    changes = {}
    ex = ExactColumns(df)
    for name in required:
        if ex.has(name):
            continue
        other = ex.find_ci(name)
        if other is not None:
            changes[name] = lambda e, s=other: e.col(s)
        elif name in ("Price", "quantity"):
            changes[name] = lambda e: F.lit(0.0)
        else:
            changes[name] = lambda e: F.lit("")
    if not changes:
        return df
    return _rebuild(df, changes)


# -- B6 -------------------------------------------------------------------
def resolve_has_image(df: DataFrame) -> DataFrame:
    """``has_image`` parsed as boolean, else ``main-image-url`` present, else False."""
    ex = ExactColumns(df)
    if ex.has("has_image"):
        dt = ex.dtype("has_image")
        fn = lambda e: F.coalesce(cleaning.parse_bool(e.col("has_image"), dt), F.lit(False))
    elif ex.has("main-image-url"):
        fn = lambda e: e.col("main-image-url").isNotNull()
    else:
        fn = lambda e: F.lit(False)
    # Spark cannot hold both ``has_image`` and ``Has_Image``: the parsed
    # column takes the source's place.
    return _rebuild(df, {"Has_Image": fn})


# -- B7 -------------------------------------------------------------------
def resolve_isbn(df: DataFrame) -> DataFrame:
    """First present of isbn / external_product_id / product-id, else empty text."""
    for cand in K.ISBN_CANDIDATES:
        if cand in df.columns:
            return _rebuild(df, {"ISBN": lambda ex, s=cand: ex.col(s).cast(T.StringType())})
    return _rebuild(df, {"ISBN": lambda ex: F.lit("")})


# -- B9 -------------------------------------------------------------------
def project_existing(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """Select the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in order if c in present])


# -- loader composition (A3 semantics) --------------------------------------
def standardize_listing(df: DataFrame) -> DataFrame:
    """Listing report as loaded: title, vendor names, required columns,
    numeric Price (missing -> 0) and quantity (missing/negative -> 0),
    text SKU, Has_Image, ISBN."""
    df = resolve_title(df)
    df = map_vendor_columns(df, K.LOADER_COLUMN_MAP, rename=False)
    df = ensure_columns(df)
    ex = ExactColumns(df)
    price_t, qty_t = ex.dtype("Price"), ex.dtype("quantity")
    df = _rebuild(df, {
        "Price": lambda e: F.coalesce(cleaning.clean_currency(e.col("Price"), price_t), F.lit(0.0)),
        "quantity": lambda e: cleaning.clean_quantity(e.col("quantity"), qty_t),
        "SKU": lambda e: e.col("SKU").cast(T.StringType()),
    })
    df = resolve_has_image(df)
    df = resolve_isbn(df)
    return df
