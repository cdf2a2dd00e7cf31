"""Per-key value lists that never need one task to hold a whole key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .enrich import fold_listed


def value_lists(rows: DataFrame, key: str, value: str, times: str = "times", only: DataFrame | None = None) -> DataFrame:
    """``key, value, times``: all values of a key and how often each is there.

    The list of a key is its rows, of the same shape for any number of values,
    so no key has to fit into one task. ``only`` is a table of the keys asked
    for.
    """

    def fold(some: DataFrame) -> DataFrame:
        return some.groupBy(key, value).agg(F.count(F.lit(1)).alias(times))

    return fold(rows) if only is None else fold_listed(rows, only, key, key, fold)


def joined_lists(lists: DataFrame, key: str, value: str, name: str, times: str = "times", sep: str = ",") -> DataFrame:
    """One row per key: its values, sorted, repeated ones repeated, as one text.

    For reports: a text is one cell, so a task holds the distinct values of the
    keys that it writes.
    """
    runs = F.array_sort(F.collect_list(F.struct(value, times)))
    texts = F.transform(runs, lambda r: F.array_join(F.array_repeat(r[value], r[times].cast("int")), sep))
    return lists.groupBy(key).agg(F.array_join(texts, sep).alias(name))
