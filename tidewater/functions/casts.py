"""Scalar helpers: the warehouse cast family re-expressed as built-in Spark
expressions (all JVM-side, all inside whole-stage codegen).

Under ANSI mode a plain ``cast`` of bad text throws, so every "try" helper is
``try_cast``: bad input becomes NULL, as the warehouse's TRY_ functions do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_number(c) -> Column:
    """TRY_TO_NUMBER(text): DECIMAL(38,0) with half-away rounding; '' / junk -> NULL."""
    return F.trim(_c(c).cast("string")).try_cast("decimal(38,0)")


def try_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """TRY_TO_NUMBER(text, p, s)."""
    return F.trim(_c(c).cast("string")).try_cast(f"decimal({precision},{scale})")


def try_timestamp_ntz(c) -> Column:
    """TRY_TO_TIMESTAMP_NTZ(text): zone suffix dropped, wall clock kept."""
    return _c(c).cast("string").try_cast("timestamp_ntz")


def try_date(c) -> Column:
    """TRY_TO_DATE(text): NULL for impossible dates; date-time text -> its date."""
    return _c(c).cast("string").try_cast("date")


def ts_to_date(c) -> Column:
    """CAST(ts AS DATE) for a typed timestamp (never fails)."""
    return _c(c).cast("date")


def date_key(c) -> Column:
    """yyyymmdd as INT."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def iso_day_of_week(c) -> Column:
    """Monday = 1 ... Sunday = 7 (``dayofweek`` is Sunday = 1, not wanted)."""
    return (F.weekday(_c(c)) + 1).cast("int")


def month_name(c) -> Column:
    return F.date_format(_c(c), "MMMM")


def day_name(c) -> Column:
    return F.date_format(_c(c), "E")


def rounded_ratio(amount, count) -> Column:
    """ROUND(amount / NULLIF(count, 0), 2) computed exactly in integer cents.

    ``amount`` is a DECIMAL with two places.  The quotient is rounded half away
    from zero to a cent with integer arithmetic only, so no double rounding and
    no floating point: the result is DECIMAL(18,2), NULL when count is 0.
    """
    cents = (_c(amount) * 100).cast("decimal(38,0)")
    n = _c(count).cast("decimal(38,0)")
    num = F.abs(cents) * 2 + n
    den = n * 2
    # exact floor division: (num - num mod den) is a multiple of den
    q = ((num - F.pmod(num, den)) / den).cast("decimal(38,0)")
    signed = F.when(cents < 0, -q).otherwise(q)
    return F.when(n == 0, F.lit(None).cast("decimal(18,2)")).otherwise(
        (signed / 100).cast("decimal(18,2)"))


def rounded_quotient(num, den, scale: int = 4) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) for integer counts, exact, half away
    from zero, as DECIMAL(18, scale)."""
    f = 10 ** scale
    a = _c(num).cast("decimal(38,0)") * f
    n = _c(den).cast("decimal(38,0)")
    top = F.abs(a) * 2 + n
    q = ((top - F.pmod(top, n * 2)) / (n * 2)).cast("decimal(38,0)")
    signed = F.when(a < 0, -q).otherwise(q)
    return F.when(n == 0, F.lit(None).cast(f"decimal(18,{scale})")).otherwise(
        (signed / f).cast(f"decimal(18,{scale})"))
