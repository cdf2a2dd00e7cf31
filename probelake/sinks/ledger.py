"""Progress ledgers: cycles sent per table and slices already processed.

Both are append-only tables; the state is computed from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.slices import read_table

CYCLES = T.StructType([T.StructField("tab_name", T.StringType()), T.StructField("cycle", T.StringType())])
DONE = T.StructType([T.StructField("feed", T.StringType()), T.StructField("slice", T.StringType())])


def progress_state(cycles: DataFrame) -> DataFrame:
    """``tab_name, curr_cycle, last_cycle`` after sending all cycles.

    A cycle below both slots is ignored, one between them becomes the last, a
    newer or equal one moves both on. So the slots are the two highest cycles
    sent, duplicates included, in whatever order they arrived; ``''`` stands
    for a missing last cycle.
    """
    newest_first = Window.partitionBy("tab_name").orderBy(F.col("cycle").desc())
    top = cycles.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= 2)
    return top.groupBy("tab_name").agg(
        F.max("cycle").alias("curr_cycle"),
        F.coalesce(F.max(F.when(F.col("_rank") == 2, F.col("cycle"))), F.lit("")).alias("last_cycle"),
    )


def send_cycle(spark: SparkSession, root: str, tab_name: str, cycle: str) -> None:
    spark.createDataFrame([(tab_name, cycle)], CYCLES).coalesce(1).write.mode("append").parquet(root)


def read_progress(spark: SparkSession, root: str, tab_name: str | None = None) -> DataFrame:
    cycles = read_table(spark, root, CYCLES, (), fmt="parquet")
    if tab_name is not None:
        cycles = cycles.where(F.col("tab_name") == tab_name)
    return progress_state(cycles)


def mark_done(spark: SparkSession, root: str, feed: str, slice_id: str) -> None:
    spark.createDataFrame([(feed, slice_id)], DONE).coalesce(1).write.mode("append").parquet(root)


def read_done(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, DONE, (), fmt="parquet")


def pending_slices(available: DataFrame, done: DataFrame) -> DataFrame:
    """Slices that were delivered and not yet processed."""
    return available.select("feed", "slice").distinct().join(done, ["feed", "slice"], "left_anti")
