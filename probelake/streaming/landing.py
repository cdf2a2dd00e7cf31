"""Streaming landing of RADIUS messages into a table of five-minute rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.radius import PARTITION_COLUMNS, RadiusLayout, parse_messages
from ..operators.ranges import merge_ranges
from ..session import path_exists
from ..sinks.manifest import LAST_KEY, Change, cluster
from ..sources.manifest import SEPARATOR, holds_batch, read_manifest

#: Where a message came from, if its source says so; kept beside the message's fields.
PLACE = ("topic", "partition", "offset")
OFFSETS = T.StructType(
    [
        T.StructField("topic", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("lo", T.LongType()),
        T.StructField("hi", T.LongType()), T.StructField("covered", T.LongType()),
    ]
)


def landed_schema(layout: RadiusLayout) -> T.StructType:
    """All text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in layout.columns])


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to, made with it and kept beside it."""
    kept = f"{checkpoint.rstrip('/')}/landing_run"
    if not path_exists(spark, f"{kept}/_SUCCESS"):
        name = uuid.uuid4().hex[:12]
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(kept)
    return spark.read.text(kept).first()["value"]


def offset_ranges(rows: DataFrame) -> DataFrame:
    """``topic, part, lo, hi, covered``: the offsets of rows with the columns ``PLACE``."""
    one = rows.where(F.col("offset").isNotNull()).select(
        "topic", F.col("partition").cast("int").alias("part"), F.col("offset").alias("lo"), (F.col("offset") + 1).alias("hi")
    )
    return merge_ranges(one, ["topic", "part"], bucket=1 << 16).select(*OFFSETS.names)


def land_batch(rows: DataFrame, batch: int, root: str, run: str) -> int | None:
    """Publish one micro-batch as one version of the table at ``root``; None, without writing, if it holds it already.

    The batch is named in the version that brings its rows, so it is known as long as the table is, also after its files
    have been merged; a run with a new checkpoint, whose ids start at 0 again, adds to what earlier runs landed. Late
    records are rows like all others. Rows that say where they come from bring their offsets with them, in the same
    version.
    """
    spark = rows.sparkSession
    if holds_batch(spark, root, run, batch):
        return None
    change = Change(spark, root)
    placed = all(c in rows.columns for c in PLACE)
    written = change.add("rows", rows, PARTITION_COLUMNS)
    if placed:
        change.add("offsets", offset_ranges(written), ["topic"])
    return change.commit(run, batch)


def start_landing(
    messages: DataFrame, layout: RadiusLayout, root: str, checkpoint: str, seconds: int | None = 5, value: str = "value",
) -> StreamingQuery:
    """Start the landing query; ``seconds=None`` drains what is there and stops.

    Batch ids come from the checkpoint: after a restart the last unfinished batch runs again under its old id, and is
    left out if its version was published before.
    """
    kept = [c for c in PLACE if all(p in messages.columns for p in PLACE)]
    parsed = parse_messages(messages, layout, value, kept)
    run = run_id(messages.sparkSession, checkpoint)

    def publish(rows: DataFrame, batch_id: int) -> None:
        land_batch(rows, batch_id, root, run)

    writer = parsed.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def read_landed(
    spark: SparkSession, root: str, layout: RadiusLayout, wanted: Sequence[tuple[str, str, str]] | None = None
) -> DataFrame:
    """Landed messages; with ``wanted`` those of these ``(d, h, m5)``, from the files that can hold them."""
    return read_manifest(spark, root, landed_schema(layout), "rows", PARTITION_COLUMNS, wanted)


def read_offsets(spark: SparkSession, root: str) -> DataFrame:
    """``topic, part, lo, hi, covered``: the offsets of all landed rows, merged."""
    return merge_ranges(read_manifest(spark, root, OFFSETS, "offsets"), ["topic", "part"])


def compact_landed(spark: SparkSession, root: str, layout: RadiusLayout, prefix: str, size_mb: int = 128) -> tuple[int, int]:
    """Merges small files that lie within a day, an hour or five minutes (8 to 12 digits of time); files gone and come."""
    parts = [prefix[:8], prefix[8:10], prefix[10:12]]
    least = SEPARATOR.join(p for p in parts if p)
    return cluster(
        spark, root, landed_schema(layout), PARTITION_COLUMNS, "rows", least, least + LAST_KEY, size_mb * 1024 * 1024
    )
