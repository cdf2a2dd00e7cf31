"""Row shapes of multi-section reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Section:
    """A block of report columns with its own key column.

    ``present`` is a counter that is above zero where the section has a row.
    """

    key_column: str
    columns: tuple[str, ...]
    present: str


def aligned(df: DataFrame, key: str, sections: Sequence[Section]) -> DataFrame:
    """One row per key; absent sections are null."""
    return df.select(key, *[c for s in sections for c in _cells(s, key)[1:]])


def chained(df: DataFrame, key: str, sections: Sequence[Section]) -> DataFrame:
    """The rows of full outer joins of all sections on the *first* one's key.

    A key missing from the first section matches nothing there, so each of its
    other sections stands in a row of its own. ``df`` has one row per key, so
    this needs no join at all.
    """
    first, *others = sections
    whole = F.struct(*[c for s in sections for c in _cells(s, key)])
    alone = [
        F.when(
            F.col(one.present) > 0,
            F.struct(*[c for s in sections for c in (_cells(s, key) if s is one else _blank(df, s, key))]),
        )
        for one in others
    ]
    rows = F.when(F.col(first.present) > 0, F.array(whole)).otherwise(F.array_compact(F.array(*alone)))
    return df.select(F.explode(rows).alias("_row")).select("_row.*")


def _cells(section: Section, key: str) -> list[Column]:
    here = F.col(section.present) > 0
    cells = [F.when(here, F.col(key)).alias(section.key_column)]
    return cells + [F.when(here, F.col(c)).alias(c) for c in section.columns]


def _blank(df: DataFrame, section: Section, key: str) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [F.lit(None).cast(types[key]).alias(section.key_column)]
    return cells + [F.lit(None).cast(types[c]).alias(c) for c in section.columns]
