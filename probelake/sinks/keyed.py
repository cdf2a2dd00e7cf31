"""Keyed tables on plain files.

Writing a batch costs what the batch weighs: it becomes files of its own under a number that grows with time. Readers
merge, and the last write wins per key (``sources.keyed``). When the writes have outgrown their share of the base,
``fold`` writes a new base, sorted in buckets by key, and takes the folded writes out in the same version; writes that
come meanwhile stay beside it.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.keyed import BASE, SEQUENCE, WRITES, read_writes
from ..sources.manifest import live_files, newest
from .manifest import MIB, Change


def upsert(df: DataFrame, root: str, batch: str, sequence: int | None = None) -> None:
    """Write one batch of puts as it is; readers pick each key's last write.

    ``sequence`` orders the writes and defaults to the time in microseconds, so
    a batch that is run again late counts as written late. A batch that comes again
    under the same sequence is left out.
    """
    at = time.time_ns() // 1000 if sequence is None else sequence
    change = Change(df.sparkSession, root)
    change.add(WRITES, df.withColumn(SEQUENCE, F.lit(at).cast("long")), [])
    change.commit(batch, at)


def weights(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, int]:
    """Bytes of the base and of the writes since."""
    found = live_files(spark, root, version=version).groupBy("label").agg(F.sum("n_bytes").alias("n")).collect()
    of = {row["label"]: row["n"] for row in found}
    return of.get(BASE, 0), of.get(WRITES, 0)


def fold(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = (),
    buckets: int | None = None, share: float = 0.0, bucket_bytes: int = 128 * MIB,
) -> bool:
    """Merge base and writes into a new base, if the writes weigh more than ``share`` of the base; whether it was done.

    Rows keep the numbers of their writes. Without ``buckets`` there is one for each ``bucket_bytes``. Readers see the
    old base and its writes, or the new base; a failed fold changes nothing.
    """
    version = newest(spark, root)
    base, written = weights(spark, root, version)
    if not written or written <= share * base:
        return False
    change = Change(spark, root)
    n = buckets or max(1, math.ceil((base + written) / bucket_bytes))
    merged = read_writes(spark, root, schema, keys, order, version)
    folder = f"data/{BASE}/{uuid.uuid4().hex}-{n}"
    name = f"probelake_bucketed_{uuid.uuid4().hex}"
    # One task for each bucket, so that it is one sorted file.
    writer = merged.repartition(n, *keys).write.format("orc").bucketBy(n, *keys).sortBy(*keys)
    writer.option("path", f"{root}/{folder}").saveAsTable(name)
    spark.sql(f"drop table {name}")
    change.record(BASE, folder, merged.schema, [])
    # Only what was merged goes; writes since that version stay.
    change.remove(live_files(spark, root, version=version))
    change.commit()
    return True
