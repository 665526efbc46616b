"""Date/time column expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000

# Formats tried, in order, by the generic parser (ISO first), each with the
# shape a string must have before the (comparatively costly) formatter runs.
GENERIC_TIMESTAMP_FORMATS = (
    (None, None),                                    # Spark's ISO-8601 parser
    ("M/d/yyyy H:mm:ss", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$"),
    ("M/d/yyyy H:mm", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("d MMM yyyy", r"^\d{1,2} [A-Za-z]{3} \d{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"),
)


def ts_literal(value: datetime, like: T.DataType | None = None) -> Column:
    """A timestamp literal typed like ``like`` so comparisons push down.

    Comparing a TIMESTAMP_NTZ column with a TIMESTAMP literal would put a
    cast on the column and defeat parquet predicate pushdown.
    """
    lit = F.lit(value.replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S.%f"))
    if isinstance(like, T.TimestampNTZType):
        return lit.cast(T.TimestampNTZType())
    if isinstance(like, T.DateType):
        return lit.cast(T.DateType())
    return lit.cast(T.TimestampType())


def window_start(as_of: datetime, days: int, like: T.DataType | None = None) -> Column:
    """Inclusive lower bound ``as_of - days`` (no upper bound is applied)."""
    return ts_literal(as_of - timedelta(days=days), like)


def floor_days_since(as_of: datetime, ts: Column) -> Column:
    """Whole elapsed days ``floor((as_of - ts) / 24h)``; negative for future ts.

    Not ``datediff`` (calendar days) and not a truncating division; elapsed
    microseconds floored is the pandas ``.days`` rule.  Both ends are naive
    wall-clock times, so the session time zone (and DST) cannot shift it, and
    the floor division is exact integer arithmetic.
    """
    ts_ntz = ts.cast(T.TimestampNTZType())
    micros = F.timestamp_diff("MICROSECOND", ts_ntz, ts_literal(as_of, T.TimestampNTZType()))
    day = F.lit(MICROS_PER_DAY)
    whole = (micros - F.pmod(micros, day)).cast(T.DecimalType(20, 0))   # an exact multiple of a day
    return (whole / day.cast(T.DecimalType(20, 0))).cast(T.LongType())


def _ntz_with_format(s: Column, fmt: str) -> Column:
    """Wall-clock parse with ``fmt`` that never consults the session time zone.

    ``to_timestamp_ntz`` raises on bad text under ANSI, so it only runs where
    ``try_to_timestamp`` has accepted the same text (validity does not depend
    on the zone); CASE evaluates the branch lazily.
    """
    f = F.lit(fmt)
    return F.when(F.try_to_timestamp(s, f).isNotNull(), F.to_timestamp_ntz(s, f))


def parse_timestamp(c: Column) -> Column:
    """Generic text -> naive (wall-clock) timestamp, NULL when no format matches."""
    s = F.trim(c.cast(T.StringType()))
    tries = []
    for fmt, shape in GENERIC_TIMESTAMP_FORMATS:
        if fmt is None:
            tries.append(s.try_cast(T.TimestampNTZType()))
            # text carrying its own zone/offset: read as an instant, shown in session time
            tries.append(F.try_to_timestamp(s).cast(T.TimestampNTZType()))
        else:
            tries.append(F.when(s.rlike(shape), _ntz_with_format(s, fmt)))
    return F.coalesce(*tries)


def ensure_timestamp(df_type: T.DataType, c: Column) -> Column:
    """Keep timestamp columns, parse everything else (naive wall-clock time)."""
    if isinstance(df_type, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(df_type, T.DateType):
        return c.cast(T.TimestampNTZType())
    return parse_timestamp(c)


def fix_two_digit_year(ts: Column) -> Column:
    """Map Spark's 2069-2099 reading of ``yy`` back to 1969-1999 (Python rule)."""
    return F.when(F.year(ts) >= 2069, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)


def parse_gmt_timestamp(c: Column, gmt_format: str) -> Column:
    """``'01/02/25 13:45:00 GMT (PST)'`` -> timestamp of the text before ``(``.

    Values without ``GMT`` fall back to the generic parser; failures are NULL.
    """
    s = c.cast(T.StringType())
    head = F.trim(F.regexp_extract(s, r"^(.*?)\s*(?:\(|$)", 1))
    gmt = fix_two_digit_year(_ntz_with_format(head, gmt_format))
    return F.when(s.contains("GMT"), gmt).otherwise(parse_timestamp(s))
