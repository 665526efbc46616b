"""Business-rule predicates and scores over the per-item columns.

Every comparison is wrapped with ``coalesce(pred, false)``: in the reference a
comparison with a missing value is False (never NULL), so a never-sold item
(NULL days) is not stale.  Optional inputs switch terms on and off by column
presence, decided at plan time from ``columns``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflens import constants as K


def _f(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def _no_image(columns) -> Column | None:
    # A missing Has_Image value counts as "no image".
    if "Has_Image" not in columns:
        return None
    return ~F.coalesce(F.col("Has_Image"), F.lit(False))


def _isbn_missing(columns, empty_is_missing: bool) -> Column | None:
    if "ISBN" not in columns:
        return None
    if empty_is_missing:
        return F.col("ISBN").isNull() | (F.col("ISBN") == F.lit(""))
    return F.col("ISBN").isNull()


def _low_price(columns) -> Column | None:
    if "Price" not in columns:
        return None
    return _f(F.col("Price") < F.lit(K.LOW_PRICE))


def _short_title(columns, limit: int) -> Column | None:
    if "Title" not in columns:
        return None
    return _f(F.char_length("Title") < F.lit(limit))


def is_stale(days: Column, sales30: Column) -> Column:
    """``days > 120 OR (sales30 = 0 AND days > 90)``."""
    return _f(days > K.STALE_DAYS) | (_f(sales30 == 0) & _f(days > K.STALE_DAYS_NO_RECENT))


def bad_metadata(columns, empty_isbn_is_missing: bool = False) -> Column:
    """Short title, missing ISBN, no image, or price < 2 (by column presence)."""
    terms = [
        _short_title(columns, K.SHORT_TITLE_BAD),
        _isbn_missing(columns, empty_isbn_is_missing),
        _no_image(columns),
        _low_price(columns),
    ]
    terms = [t for t in terms if t is not None]
    if not terms:
        return F.lit(False)
    return reduce(or_, terms)


def flag(stale: Column, bad: Column) -> Column:
    return F.when(stale | bad, F.lit(K.FLAG_WARN)).otherwise(F.lit(K.FLAG_OK))


def notes(stale: Column, bad: Column) -> Column:
    """Both notes are concatenated with no separator when both apply."""
    both_text = F.concat(
        F.when(stale, F.lit(K.NOTE_STALE)).otherwise(F.lit("")),
        F.when(bad, F.lit(K.NOTE_BAD_METADATA)).otherwise(F.lit("")),
    )
    return F.when(~stale & ~bad, F.lit(K.NOTE_GOOD)).otherwise(both_text)


def metadata_quality_score(columns) -> Column:
    """100 minus 25 per failed check (title < 10, ISBN, image, price < 2)."""
    terms = [
        _short_title(columns, K.SHORT_TITLE_SCORE),
        _isbn_missing(columns, False),
        _no_image(columns),
        _low_price(columns),
    ]
    score = F.lit(100)
    for t in terms:
        if t is not None:
            score = score - F.when(t, F.lit(K.SCORE_PENALTY)).otherwise(F.lit(0))
    return score.cast("int")


def annual_sales_low(sales90: Column) -> Column:
    """Annualised stand-in for "fewer than 3 sales in 12 months"."""
    return _f(sales90 * K.ANNUALISE_FACTOR < K.ANNUAL_MIN_SALES)


def stale_strict(days: Column, sales90: Column, quantity: Column) -> Column:
    """File-report rule: old, or in stock but unsold for 90d, or slow annual rate."""
    return (_f(days > K.STALE_DAYS)
            | (_f(sales90 == 0) & _f(quantity > 0))
            | annual_sales_low(sales90))


def good_seller_strict(columns, days: Column, sales30: Column) -> Column:
    title_ok = (F.col("Title").isNotNull() & (F.col("Title") != F.lit(""))
                & (F.col("Title") != F.lit(K.UNKNOWN_TITLE)))
    pred = _f(sales30 > 0) & _f(days <= K.GOOD_SELLER_MAX_DAYS) & _f(title_ok)
    if "Has_Image" in columns:
        pred = pred & F.coalesce(F.col("Has_Image"), F.lit(False))
    else:
        pred = pred & F.lit(False)
    if "quantity" in columns:
        pred = pred & _f(F.col("quantity") > 0)
    return pred


def heuristic_score(columns, days: Column, sales90: Column) -> Column:
    """1 - 0.25 (old) - 0.25 (slow) - 0.125 per metadata problem, in [0, 1]."""
    score = F.lit(1.0)
    score = score - F.when(_f(days > K.STALE_DAYS), F.lit(K.HEURISTIC_MAJOR)).otherwise(0.0)
    score = score - F.when(annual_sales_low(sales90), F.lit(K.HEURISTIC_MAJOR)).otherwise(0.0)
    minor = [
        _short_title(columns, K.SHORT_TITLE_BAD),
        _isbn_missing(columns, True),
        _no_image(columns),
        _low_price(columns),
    ]
    for t in minor:
        if t is not None:
            score = score - F.when(t, F.lit(K.HEURISTIC_MINOR)).otherwise(0.0)
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
