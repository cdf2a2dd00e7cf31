"""One-pass KPI aggregation.

A KPI is a set of conditional counts and sums over one scan of a feed. Rates,
delays and "all counters present" rules are then arithmetic on one row per
group, instead of several aggregates of the same feed joined to each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fill_null


@dataclass(frozen=True)
class Measure:
    """Counts the rows where ``when`` holds, or sums ``value`` over them."""

    name: str
    when: Column | None = None
    value: Column | None = None

    def column(self) -> Column:
        if self.value is None:
            counted = F.lit(1) if self.when is None else F.when(self.when, 1)
            return F.count(counted).alias(self.name)
        summed = self.value if self.when is None else F.when(self.when, self.value)
        return F.sum(summed).alias(self.name)

    def again(self) -> Column:
        """The same measure over rows that already hold it per subgroup."""
        return F.sum(self.name).alias(self.name)


def count_by(
    df: DataFrame, by: Sequence[str], measures: Sequence[Measure], distinct: dict[str, str] | None = None
) -> DataFrame:
    return df.groupBy(*by).agg(*[m.column() for m in measures], *_distinct(distinct))


def recount_by(
    df: DataFrame, by: Sequence[str], measures: Sequence[Measure], distinct: dict[str, str] | None = None
) -> DataFrame:
    return df.groupBy(*by).agg(*[m.again() for m in measures], *_distinct(distinct))


def _distinct(distinct: dict[str, str] | None) -> list[Column]:
    return [F.count_distinct(F.col(c)).alias(name) for name, c in (distinct or {}).items()]


def with_total(groups: DataFrame, key: str, measures: Sequence[Measure], total_label: str) -> DataFrame:
    """Adds one row that sums all groups, labelled in ``key``.

    Takes the grouped rows, so the feed itself is not expanded for the total.
    A null group keeps its null; ``is_total`` tells the two apart.
    """
    rolled = groups.rollup(key).agg(
        *[m.again() for m in measures], F.grouping_id().alias("_level")
    )
    is_total = F.col("_level") > 0
    label = F.when(is_total, F.lit(total_label)).otherwise(F.col(key))
    return rolled.select(
        label.alias(key), is_total.alias("is_total"), *[F.col(m.name) for m in measures]
    )


def long_form(df: DataFrame, keys: Sequence[str], values: dict[str, str], name: str, value: str) -> DataFrame:
    """One row per (group, metric): ``values`` maps column to metric label."""
    cells = df.unpivot([F.col(k) for k in keys], [F.col(c) for c in values], "_metric", value)
    label = F.coalesce(*[F.when(F.col("_metric") == c, F.lit(text)) for c, text in values.items()])
    return cells.select(*keys, label.alias(name), value)


def all_present(df: DataFrame, counters: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Groups that have every counter above zero and no null key: what joining
    one aggregate per counter on the keys would leave."""
    keep = F.lit(True)
    for c in counters:
        keep = keep & (F.col(c) > 0)
    for k in keys:
        keep = keep & F.col(k).isNotNull()
    return df.where(keep)


def labelled(df: DataFrame, columns: Sequence[str], default: str = "-1") -> DataFrame:
    """Null group labels become ``default``."""
    return df.withColumns({c: fill_null(c, default) for c in columns})


def distinct_with_null(c: Column) -> Column:
    """Distinct count that counts a null as one more value."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))
