"""Offset ledger: gaps between batches, resume points, last batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("grp", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("batch", T.LongType()),
        T.StructField("p_from", T.LongType()),
        T.StructField("p_until", T.LongType()),
        T.StructField("cost_ms", T.LongType()),
    ]
)
KEYS = ("topic", "grp", "part")


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, bucket_size: int
) -> DataFrame:
    """``lag(value)`` per key in ``order``, with long histories cut into buckets.

    Each (key, bucket) is sorted on its own, so one key with most of the rows
    is spread over many tasks. The first row of a bucket takes its value from
    the end of the key's previous bucket; only those bucket ends are ordered
    per key.
    """
    bucketed = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(bucket_size)))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    marked = bucketed.withColumns(
        {"_lag": F.lag(value).over(inside), "_first": F.row_number().over(inside) == 1}
    )
    ends = bucketed.groupBy(*keys, "_bucket").agg(F.max(F.struct(order, value)).alias("_end"))
    along = Window.partitionBy(*keys).orderBy("_bucket")
    carried = ends.select(*keys, "_bucket", F.lag(F.col("_end")[value]).over(along).alias("_carried"))
    on = [marked[k].eqNullSafe(carried[k]) for k in (*keys, "_bucket")]
    joined = marked.join(carried, on, "left").select(*[marked[c] for c in marked.columns], "_carried")
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag"))
    return joined.select(*df.columns, previous.alias(name))


def offset_gaps(ledger: DataFrame, bucket_size: int = 4096) -> DataFrame:
    """Adds ``p_delta``: how far a batch starts from where the one before it
    ended; 0 without history. ``bucket_size`` is a range of batch ids; its default
    suits ids that count batches, millisecond ids call for about a day."""
    previous = previous_value(ledger, KEYS, "batch", "p_until", "_before", bucket_size)
    delta = F.coalesce(F.col("p_from") - F.col("_before"), F.lit(0))
    return previous.select(*ledger.columns, delta.cast("bigint").alias("p_delta"))


def resume_points(partitions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Where each partition continues: its last ``p_until``, 0 if it is new."""
    last = ledger.groupBy(*KEYS).agg(F.max(F.struct("batch", "p_until")).alias("_last"))
    joined = partitions.join(last, list(KEYS), "left")
    start = F.coalesce(F.col("_last")["p_until"], F.lit(0)).cast("bigint")
    return joined.select(*KEYS, start.alias("start_offset"))


def last_batch(ledger: DataFrame, topic: str, grp: str) -> DataFrame:
    """One row with the newest batch id, -1 when there is none."""
    mine = ledger.where((F.col("topic") == topic) & (F.col("grp") == grp))
    return mine.agg(F.coalesce(F.max("batch"), F.lit(-1)).cast("bigint").alias("batch"))
