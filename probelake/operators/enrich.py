"""Joining facts with dimensions, and counting what comes out.

A dimension is broadcast only when its size was checked. Where one is too
large, the facts are first counted per join key, so that a key holding a third
of all rows crosses the shuffle as a few rows per task instead of as one giant
partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast
from .kpi import Measure, count_by, recount_by

#: Fixed value: part of the access point names of the NB network.
NB_MARKER = "ctnb"


@dataclass(frozen=True)
class Lookup:
    """``fact_key = dim_key`` brings ``columns`` of ``dim`` to the facts.

    Rows of ``dim`` that share a key multiply the facts, as in any join.
    """

    dim: DataFrame
    fact_key: str
    dim_key: str
    columns: tuple[str, ...]
    how: str = "inner"

    @property
    def side(self) -> DataFrame:
        """The part of the dimension the join needs."""
        return self.dim.select(F.col(self.dim_key).alias(f"_key_{self.fact_key}"), *self.columns)

    def attach(self, fact: DataFrame, small: bool = False) -> DataFrame:
        """``small`` is the result of a size check, see ``count_enriched``."""
        side = F.broadcast(self.side) if small else self.side
        on = F.col(self.fact_key) == F.col(f"_key_{self.fact_key}")
        return fact.join(side, on, self.how).drop(f"_key_{self.fact_key}")


def count_enriched(
    fact: DataFrame,
    lookups: Sequence[Lookup],
    by: Sequence[str],
    measures: Sequence[Measure],
    distinct: dict[str, str] | None = None,
    prefold: bool | None = None,
) -> DataFrame:
    """Joins the lookups and counts, in the order their sizes call for.

    Small dimensions are joined as the facts are read. Ahead of the others the
    facts are folded to one row per combination of what is still needed, with
    the measures already counted. ``distinct`` maps result column to the fact
    column whose distinct values are counted. ``prefold`` forces either way
    for all lookups.
    """
    distinct = distinct or {}
    if prefold is None:
        small = [lookup for lookup in lookups if fits_broadcast(lookup.side)]
    else:
        small = [] if prefold else list(lookups)
    for lookup in small:
        fact = lookup.attach(fact, small=prefold is None)
    large = [lookup for lookup in lookups if lookup not in small]
    if not large:
        return count_by(fact, by, measures, distinct)
    later = {c for lookup in large for c in lookup.columns}
    kept = [c for c in by if c not in later] + [lookup.fact_key for lookup in large] + list(distinct.values())
    folded = count_by(fact, list(dict.fromkeys(kept)), measures)
    for lookup in large:
        folded = lookup.attach(folded)
    return recount_by(folded, by, measures, distinct)


def duplicated_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a dimension, with their count."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unknown_keys(seen: DataFrame, known: DataFrame, seen_key: str, known_key: str | None = None) -> DataFrame:
    """Distinct values of ``seen_key`` that ``known`` lacks; a null counts as unknown."""
    known = known.select(F.col(known_key or seen_key).alias(seen_key))
    return seen.select(seen_key).distinct().join(known, seen_key, "left_anti")


def only_listed(df: DataFrame, ids: DataFrame, key: str, id_key: str | None = None) -> DataFrame:
    """Rows whose key is in an id list; duplicates in the list do not matter."""
    ids = ids.select(F.col(id_key or key).alias(key))
    return df.join(ids, key, "left_semi")


def fold_listed(
    rows: DataFrame, ids: DataFrame, key: str, id_key: str, fold: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``fold`` of the rows whose key is listed; ``fold`` keeps the key.

    A list small enough to broadcast filters the rows as they are read. A larger
    one is compared with the folded rows, so that a key with many records meets
    the join as the few rows it was folded into.
    """
    if fits_broadcast(ids.select(id_key)):
        return fold(only_listed(rows, ids, key, id_key))
    return only_listed(fold(rows), ids, key, id_key)


def tag_network(apn: Column, marker: str = NB_MARKER) -> Column:
    """``NB`` or ``4G`` by access point; null belongs to neither."""
    return F.when(apn.contains(marker), F.lit("NB")).when(~apn.contains(marker), F.lit("4G"))
