"""Delimited-line parsing as native column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import MISSING


def split_keep(line: Column, sep: str = "|") -> Column:
    """Split, keeping trailing empty fields."""
    return F.split(line, re.escape(sep), -1)


def split_drop(line: Column, sep: str = "|") -> Column:
    """Split after removing trailing empty fields."""
    return F.split(F.rtrim(line, F.lit(sep)), re.escape(sep), -1)


def field(fields: Column, i: int | Column) -> Column:
    """Field ``i`` (0-based), null when the line is too short."""
    return F.get(fields, i if isinstance(i, Column) else F.lit(i))


def optional_field(fields: Column, i: int, default: str = MISSING) -> Column:
    return F.coalesce(field(fields, i), F.lit(default))


def tail_groups(fields: Column, start: int, width: int) -> Column:
    """Fields from ``start`` on, cut into arrays of ``width`` (last may be short).

    ``fields`` should be a column that already holds the split line: the groups
    slice it directly, so a long line is split once and not once per group.
    """
    n = F.ceil((F.size(fields) - start) / F.lit(width)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.slice(fields, i * F.lit(width) + F.lit(start + 1), F.lit(width)),
    )
    return F.when(n > 0, cut).otherwise(F.array().cast("array<array<string>>"))


def counted_groups(fields: Column, count: Column, start: int, width: int) -> Column:
    """Up to ``count`` complete groups of ``width`` fields from ``start`` on.

    A count larger than the line can hold yields the complete groups only.
    """
    n = whole_groups(fields, count, start, width)
    cut = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.slice(fields, i * F.lit(width) + F.lit(start + 1), F.lit(width)),
    )
    return F.when(n > 0, cut).otherwise(F.array().cast("array<array<string>>"))


def whole_groups(fields: Column, count: Column, start: int, width: int) -> Column:
    """Number of complete groups present, at most ``count`` and at least 0."""
    room = F.floor((F.size(fields) - start) / F.lit(width)).cast("int")
    return F.greatest(F.least(count, room), F.lit(0))


def join_groups(groups: Column, inner: str, outer: str, leading: bool = False) -> Column:
    """Groups as text: ``inner`` between fields, ``outer`` between groups.

    ``leading`` also puts ``outer`` before the first group, the form in which
    the published tables hold it.
    """
    parts = F.transform(groups, lambda g: F.array_join(g, inner))
    text = F.array_join(parts, outer)
    if leading:
        text = F.when(F.size(groups) > 0, F.concat(F.lit(outer), text)).otherwise(F.lit(""))
    return text
