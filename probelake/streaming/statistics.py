"""Five-minute session statistics, on the stream and on landed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.radius import PARTITION_COLUMNS as M5
from ..sinks.manifest import Change, cluster
from ..sources.manifest import holds_batch, read_manifest
from .landing import run_id


def windowed_sessions(
    events: DataFrame, time: str, by: Sequence[str], number: str, late: str = "1 hour", width: str = "5 minutes",
    rsd: float = 0.01,
) -> DataFrame:
    """Sessions and approximate distinct numbers per window and group.

    Exact distinct counts are not available on a stream; use ``landed_sessions``
    on the partition once it is closed, or ``start_statistics``, which keeps
    exact numbers and lets every late record count. This is the live view:
    records later than ``late`` behind the newest one no longer change a window.
    """
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, width).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("session_cnt"),
            F.approx_count_distinct(number, rsd).alias("mdn_cnt"),
        )
        .select(F.col("w.start").alias("window_start"), *by, "session_cnt", "mdn_cnt")
    )


def _numbers_schema(rows: DataFrame, by: Sequence[str], number: str) -> T.StructType:
    return rows.select(*M5, *by, number).schema


def add_statistics(rows: DataFrame, batch: int, root: str, run: str, by: Sequence[str], number: str) -> int | None:
    """One micro-batch of sessions as one version of the table at ``root``; None if it is there already.

    The version holds the rows, the numbers that the batch was the first to bring to their five minutes and group, and
    what the batch adds to the counts. Numbers that are known already are looked up in the files of the touched five
    minutes only, so the work follows the batch and not the table.
    """
    spark, columns = rows.sparkSession, [*M5, *by]
    if holds_batch(spark, root, run, batch):
        return None
    change = Change(spark, root)
    written = change.add("rows", rows, M5)
    brought = written.where(F.col(number).isNotNull()).select(*columns, number).distinct()
    touched = [tuple(row) for row in written.select(*M5).distinct().collect()]
    known = read_manifest(spark, root, _numbers_schema(rows, by, number), "numbers", M5, touched)
    same = [brought[c].eqNullSafe(known[c]) for c in (*columns, number)]
    fresh = change.add("numbers", brought.join(known, same, "left_anti"), M5)
    sessions = written.groupBy(*columns).agg(F.count(F.lit(1)).alias("session_cnt"))
    numbers = fresh.groupBy(*columns).agg(F.count(F.lit(1)).alias("mdn_cnt"))
    both = sessions.withColumn("mdn_cnt", F.lit(0).cast("long")).unionByName(
        numbers.withColumn("session_cnt", F.lit(0).cast("long"))
    )
    change.add("counts", both.groupBy(*columns).agg(*[F.sum(c).alias(c) for c in ("session_cnt", "mdn_cnt")]), M5)
    return change.commit(run, batch)


def start_statistics(
    events: DataFrame, root: str, checkpoint: str, by: Sequence[str], number: str, seconds: int | None = 300
) -> StreamingQuery:
    """Land events and keep exact statistics of every five minutes that a batch touches.

    ``events`` have the text columns ``d, h, m5``. Each batch is one version of the table at ``root`` (see
    ``add_statistics``), read by ``read_statistics``. So late records count, distinct numbers are exact, no window waits
    for a watermark, and a replayed batch changes nothing.
    """
    run = run_id(events.sparkSession, checkpoint)

    def publish(rows: DataFrame, batch_id: int) -> None:
        add_statistics(rows, batch_id, root, run, by, number)

    writer = events.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def read_statistics(
    spark: SparkSession, root: str, by: T.StructType, wanted: Sequence[tuple[str, str, str]] | None = None
) -> DataFrame:
    """``d, h, m5, by, session_cnt, mdn_cnt`` up to the newest batch; ``by`` is the schema of the grouping columns.

    With ``wanted`` those of these ``(d, h, m5)`` only, from the files that can hold them.
    """
    names = [f.name for f in by.fields]
    text = [T.StructField(c, T.StringType()) for c in M5]
    sums = [T.StructField(c, T.LongType()) for c in ("session_cnt", "mdn_cnt")]
    added = read_manifest(spark, root, T.StructType([*text, *by.fields, *sums]), "counts", M5, wanted)
    return added.groupBy(*M5, *names).agg(*[F.sum(c.name).alias(c.name) for c in sums])


def compact_statistics(spark: SparkSession, root: str, rows: T.StructType, by: Sequence[str], number: str, size_mb: int = 128) -> None:
    """Merges the small files of all three parts of the table; ``rows`` is the schema of the landed rows."""
    column = {f.name: f for f in rows.fields}
    numbers = T.StructType([column[c] for c in (*M5, *by, number)])
    counts = T.StructType([*[column[c] for c in (*M5, *by)], *[T.StructField(n, T.LongType()) for n in ("session_cnt", "mdn_cnt")]])
    for label, schema in (("rows", rows), ("numbers", numbers), ("counts", counts)):
        cluster(spark, root, schema, M5, label, target_bytes=size_mb * 1024 * 1024)


def landed_sessions(rows: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """Exact counterpart over landed five-minute partitions."""
    return rows.groupBy("d", "h", "m5", *by).agg(
        F.count(F.lit(1)).alias("session_cnt"), F.count_distinct(F.col(number)).alias("mdn_cnt")
    )
