"""Sets of whole numbers as merged ranges: offsets read, batches landed.

A ledger of many batches becomes a few rows, from which gaps, overlaps and resume points follow. Ranges are half open,
``[lo, hi)``; empty ones hold nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _islands(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges that touch or overlap merged, with their ``covered`` sums. All rows of a key are ordered in one task."""
    along = Window.partitionBy(*keys).orderBy("lo", "hi")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.when(F.col("lo") <= F.max("hi").over(before), 0).otherwise(1)
    numbered = rows.withColumn("_starts", starts).withColumn("_island", F.sum("_starts").over(along))
    return numbered.groupBy(*keys, "_island").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("covered").alias("covered")
    ).drop("_island")


def merge_ranges(rows: DataFrame, keys: Sequence[str], bucket: int = 1 << 20) -> DataFrame:
    """``keys, lo, hi, covered``: the ranges ``lo, hi`` of each key merged where they touch or overlap.

    ``covered`` is how many numbers the merged ranges had in all; beyond ``hi - lo`` it counts what was read repeatedly.
    Rows that have a ``covered`` column already (merged ranges) keep their counts, so ranges of ranges are the same as
    ranges of rows. Keys may be null; rows whose ends are null or out of order hold nothing.

    First the ranges that begin in one stretch of ``bucket`` numbers are merged, then what is left of a key: so a key with
    most of the ledger is ordered by many tasks, and its last task sees a row for each stretch and gap.
    """
    kept = rows.where(F.col("lo") < F.col("hi"))
    if "covered" not in kept.columns:
        kept = kept.withColumn("covered", F.col("hi") - F.col("lo"))
    kept = kept.select(*keys, "lo", "hi", "covered").withColumn("_stretch", F.floor(F.col("lo") / F.lit(bucket)))
    return _islands(_islands(kept, [*keys, "_stretch"]), keys)


def gaps(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, lo, hi`` of the numbers missing between a key's merged ranges."""
    along = Window.partitionBy(*keys).orderBy("lo")
    after = ranges.select(*keys, F.col("hi").alias("lo"), F.lead("lo").over(along).alias("_next"))
    return after.where(F.col("_next").isNotNull()).withColumnRenamed("_next", "hi")


def repeated(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, repeated``: how many numbers of a key were read again, copies counted each time; keys with some only."""
    again = ranges.groupBy(*keys).agg(F.sum(F.col("covered") - (F.col("hi") - F.col("lo"))).alias("repeated"))
    return again.where(F.col("repeated") > 0)


def resume_at(partitions: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, start_offset, safe_offset`` for each of ``partitions``.

    ``start_offset`` goes on after the last number read, ``safe_offset`` at the first one missing behind the first
    range, so that nothing is lost; both 0 for partitions that nothing was read of. Keys are compared null-safely.
    """
    ends = ranges.groupBy(*keys).agg(F.max("hi").alias("_last"), F.min(F.struct("lo", "hi")).alias("_first"))
    on = [partitions[k].eqNullSafe(ends[k]) for k in keys]
    last, first = F.coalesce("_last", F.lit(0)), F.coalesce(F.col("_first.hi"), F.lit(0))
    joined = partitions.join(ends, on, "left")
    return joined.select(*[partitions[k] for k in keys], last.cast("long").alias("start_offset"), first.cast("long").alias("safe_offset"))
