"""Wide rows to key-value cells, in total order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import fill_blank

CELL_ORDER = ("rowkey", "cf", "qualifier")
#: Cells that one task sorts, about; more make more partitions.
TASK_CELLS = 1 << 20


def to_cells(df: DataFrame, rowkey: Column, columns: Sequence[str], family: str = "cf1") -> DataFrame:
    """``rowkey, cf, qualifier, value``, one row per column; blanks become -1."""
    filled = df.select(rowkey.alias("rowkey"), *[fill_blank(F.col(c).cast("string")).alias(c) for c in columns])
    cells = filled.unpivot(["rowkey"], list(columns), "qualifier", "value")
    return cells.select("rowkey", F.lit(family).alias("cf"), "qualifier", "value")


def in_total_order(cells: DataFrame, partitions: int | None = None, most: int = TASK_CELLS) -> DataFrame:
    """Cells sorted across and within partitions, of about ``most`` cells or fewer: ``partitions``, or as many as that takes.

    The range key goes on beyond the row key, so the cells of one hot row key
    can fall into several neighbouring partitions. It holds data only: a task
    that runs again sorts its rows as before.
    """
    key = [*CELL_ORDER, "value"]
    needed = -(-cells.count() // most)
    # Without a number the session's holds, and small partitions are put together.
    usual = partitions or int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = needed if needed > usual else partitions
    ranged = cells.repartitionByRange(number, *key) if number else cells.repartitionByRange(*key)
    return ranged.sortWithinPartitions(*key)


def write_cells(cells: DataFrame, path: str, partitions: int | None = None, codec: str = "snappy") -> None:
    """Sorted cell files; file order is key order."""
    ordered = in_total_order(cells, partitions)
    ordered.write.mode("overwrite").option("compression", codec).parquet(path)


# -- Given split points and a sparse index -----------------------------------

#: Folders below a table with regions.
CELLS, INDEX = "cells", "index"
#: Cells that one row of the index stands for.
BLOCK_CELLS = 4096


def region_of(rowkey: Column, splits: Sequence[str]) -> Column:
    """How many of the listed split points are at or below a key: its region, from 0 to ``len(splits)``.

    The points are looked at in stretches of about their square root, so long lists cost little a row.
    """
    points = sorted(set(splits))
    if not points:
        return F.lit(0)
    width = math.isqrt(len(points) - 1) + 1
    stretches = [points[at : at + width] for at in range(0, len(points), width)]
    below = lambda some: F.size(F.filter(some, lambda s: s <= rowkey))
    at = below(F.array(*[F.lit(stretch[0]) for stretch in stretches]))
    inner = F.element_at(F.array(*[F.array(*[F.lit(s) for s in stretch]) for stretch in stretches]), F.greatest(at, F.lit(1)))
    return F.when(at == 0, 0).otherwise((at - 1) * width + below(inner))


def write_regions(
    cells: DataFrame, root: str, splits: Sequence[str], codec: str = "snappy", most_cells: int | None = None,
    block: int = BLOCK_CELLS,
) -> None:
    """Cells in one sorted file for each region between listed split points, and an index with a row for each block of them.

    A region with more than ``most_cells`` gets as many files as it takes, each sorted; its cells are dealt by their
    content, so also those of one hot row key. Keys are no nulls, as in any store that sorts by them.
    """
    region = region_of(F.col("rowkey"), splits)
    n, file = len(set(splits)) + 1, region
    if most_cells is not None:
        counts = {r["region"]: r["n"] for r in cells.groupBy(region.alias("region")).agg(F.count(F.lit(1)).alias("n")).collect()}
        files = [max(1, -(-counts.get(i, 0) // most_cells)) for i in range(n)]
        starts = [sum(files[:i]) for i in range(n)]
        n = sum(files)
        of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), region + 1)
        dealt = F.pmod(F.xxhash64(*cells.columns), of(files).cast("long")).cast("int")
        file = of(starts) + dealt
    key = [*CELL_ORDER, "value"]
    ordered = cells.repartitionById(n, file.cast("int")).sortWithinPartitions(*key)
    ordered.write.mode("overwrite").option("compression", codec).parquet(f"{root}/{CELLS}")
    written = cells.sparkSession.read.schema(cells.schema).parquet(f"{root}/{CELLS}")
    blocks = written.groupBy(
        F.col("_metadata.file_path").alias("file"), F.floor(F.col("_metadata.row_index") / block).alias("block")
    ).agg(F.min("rowkey").alias("first_key"), F.max("rowkey").alias("last_key"), F.count(F.lit(1)).alias("n_cells"))
    blocks.repartitionByRange("first_key", "file").sortWithinPartitions("first_key", "file").write.mode("overwrite").parquet(f"{root}/{INDEX}")


def read_keys(spark: SparkSession, root: str, schema: T.StructType, first: str, last: str | None = None) -> DataFrame:
    """Cells with row keys from ``first`` up to, not including, ``last`` (of ``first`` alone without it).

    Only the files that the index names are opened; within them the row groups' and pages' own ranges do the rest.
    """
    end = F.col("first_key") < last if last is not None else F.col("first_key") <= first
    index = spark.read.parquet(f"{root}/{INDEX}")
    files = [r["file"] for r in index.where(end & (F.col("last_key") >= first)).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schema)
    wanted = F.col("rowkey") == first if last is None else (F.col("rowkey") >= first) & (F.col("rowkey") < last)
    return spark.read.schema(schema).parquet(*files).where(wanted)
