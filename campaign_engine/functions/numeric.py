"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(c: Column) -> Column:
    """NaN to null: only null means missing here."""
    return F.when(~F.isnan(c), c)


def clip(c: Column, low: Column | float, high: Column | float) -> Column:
    """Bound to [low, high]; null stays null although least and greatest skip nulls."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def round_int(c: Column) -> Column:
    """Half-even rounding to bigint."""
    return F.rint(c).cast("long")


def round_places(c: Column, places: int) -> Column:
    """Half-even rounding to decimal places: scale, round, scale back."""
    return F.rint(c * float(10**places)) / float(10**places)


def ratio(a: Column, b: Column) -> Column:
    """Quotient, or 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def outside(c: Column, low: Column | float, high: Column | float) -> Column:
    """Known and outside [low, high]; NaN, which Spark orders above all numbers, is not known."""
    return c.isNotNull() & ((c < low) | ((c > high) & ~F.isnan(c.cast("double"))))


def reaches(c: Column, threshold: float) -> Column:
    """At or above the threshold; null where the value is null or NaN."""
    return known(c.cast("double")) >= threshold


def hash_number(key: Column, seed: int) -> Column:
    """52-bit number from the md5 of key and seed: the same for any partitioning and exact as double."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
