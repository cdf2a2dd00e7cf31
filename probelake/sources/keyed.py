"""Reading keyed tables: the last write of each key wins.

A keyed table is a list of files (see ``sources.manifest``): a base, sorted in buckets by key, with the newest row of each
key, and the writes since. Readers merge the writes first, which costs what they weigh, and deal them to the base's
buckets; the base is read where it lies, without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .manifest import live_files, newest, read_manifest

#: Number of the write that a row came with.
SEQUENCE = "_written"
BASE, WRITES = "base", "writes"


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` values per key.

    A grouped maximum combines on the map side, so a key written a billion
    times reaches the reducer as one row per task. The remaining columns break
    ties, which keeps the result the same on every run.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    picked = rows.groupBy(*keys).agg(newest)
    columns = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns]
    return picked.select(*columns)


def bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """Files that were written in sorted buckets, with the buckets known to the planner.

    Only a catalog table can say so; it is named for this call and dropped again, which leaves the files alone.
    """
    name = f"probelake_bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"create table {name} ({columns}) using orc clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'"
    )
    rows = spark.table(name)
    spark.sql(f"drop table {name}")
    return rows


def base_folder(spark: SparkSession, root: str, version: int) -> tuple[str, int] | None:
    """Where the base lies and in how many buckets; None before the first fold."""
    found = live_files(spark, root, BASE, version).select("path").limit(1).collect()
    if not found:
        return None
    folder = found[0]["path"].rpartition("/")[0]
    return folder, int(folder.rpartition("-")[2])


def read_writes(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = (),
    version: int | None = None,
) -> DataFrame:
    """Each key's last write with its number. ``order`` decides among the rows of
    one write, and should name the time of the record where there is one."""
    at_version = newest(spark, root) if version is None else version
    numbered = T.StructType([*schema.fields, T.StructField(SEQUENCE, T.LongType())])
    rank = [SEQUENCE, *order]
    writes = latest_per_key(read_manifest(spark, root, numbered, WRITES, version=at_version), keys, rank)
    at = base_folder(spark, root, at_version)
    if at is None:
        return writes
    folder, buckets = at
    base = bucketed(spark, f"{root}/{folder}", numbered, keys, buckets)
    if not live_files(spark, root, WRITES, at_version).take(1):
        return base
    # Null keys match no others in a join by buckets; they are few and merged by grouping.
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    loose = latest_per_key(base.where(~known).unionByName(writes.where(~known)), keys, rank)
    # Writes go to the base's buckets, so that the base stays where it is.
    dealt = writes.where(known).repartition(buckets, *keys)
    new = dealt.select(*[F.col(c).alias(f"_new_{c}") for c in numbered.names])
    on = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    joined = base.where(known).join(new, on, "full_outer")
    ranked = [*rank, *[c for c in numbered.names if c not in keys and c not in rank]]
    stays = F.col(f"_new_{keys[0]}").isNull() | (
        F.col(keys[0]).isNotNull() & (F.struct(*ranked) >= F.struct(*[F.col(f"_new_{c}").alias(c) for c in ranked]))
    )
    merged = joined.select(*[F.when(stays, F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c) for c in numbered.names])
    return merged.unionByName(loose)


def read_keyed(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Current state of a keyed table, see ``sinks.keyed``."""
    return read_writes(spark, root, schema, keys, order).drop(SEQUENCE)
