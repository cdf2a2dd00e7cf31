"""Scalar column helpers.

Every field of a probe record is text, so conversions use ``try_cast``: under
ANSI mode a stray ``''`` becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marker for a missing text value (fixed value of the data model).
MISSING = "-1"


def number(c: Column | str) -> Column:
    """Text to double, null when it is not a number."""
    return _col(c).try_cast("double")


def whole(c: Column | str) -> Column:
    """Text to bigint, null when it is not a whole number."""
    return _col(c).try_cast("bigint")


def lenient_int(c: Column | str) -> Column:
    """Text to int; anything but an optionally signed digit string gives 0."""
    c = _col(c)
    return F.coalesce(F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int")), F.lit(0))


def equals_number(c: Column | str, n: int) -> Column:
    """``text = n`` without failing on blank or non-numeric text."""
    return whole(c) == F.lit(n)


def above_zero(c: Column | str) -> Column:
    return number(c) > 0


def fill_null(c: Column | str, default: str = MISSING) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(default))


def fill_blank(c: Column | str, default: str = MISSING) -> Column:
    """Empty or null text becomes ``default``."""
    c = _col(c)
    return F.when(F.length(c) > 0, c).otherwise(F.lit(default))


def percent(part: Column, total: Column, digits: int | None = None) -> Column:
    """``part / total * 100``; null when nothing was attempted."""
    rate = F.try_divide(part * F.lit(100.0), total)
    return rate if digits is None else F.round(rate, digits)


def quotient(total: Column, n: Column, digits: int | None = None) -> Column:
    """Mean as sum over count; null for an empty group."""
    mean = F.try_divide(total, n)
    return mean if digits is None else F.round(mean, digits)


def contains_any(c: Column, needles: Sequence[str]) -> Column:
    """Whether the text holds any of the given substrings."""
    test = F.lit(False)
    for needle in needles:
        test = test | c.contains(needle)
    return test


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | c.startswith(prefix)
    return test


def spread_key(msisdn: Column, *parts: Column, sep: str = "_") -> Column:
    """Row key that starts with the reversed number, so that neighbouring
    numbers land far apart in a key-ordered store."""
    return F.concat_ws(sep, F.reverse(msisdn), *parts)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
