"""The slice ETL job, one for all feeds: lines to a landed and published slice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.compaction import admits
from ..sinks.files import replace_slice
from ..sinks.keyed import upsert
from ..sinks.ledger import mark_done
from ..sources.feeds import Feed, parse_lines, publication, rejected_lines
from ..sources.slices import read_lines, read_table


@dataclass(frozen=True)
class SliceJob:
    """``lines_root/<slice>`` to ``table_root`` (partition ``slice``).

    ``max_bytes`` leaves larger slices untouched for another run. ``publish``
    receives the published columns and the slice id.
    """

    feed: Feed
    lines_root: str
    table_root: str
    profile: str = "full"
    publish: Callable[[DataFrame, str], None] | None = None
    rejects_root: str | None = None
    done_root: str | None = None
    max_bytes: int | None = None

    def clean(self, lines: DataFrame) -> DataFrame:
        rows = parse_lines(lines, self.feed)
        return rows.where(self.feed.land_filter) if self.feed.land_filter else rows

    def published(self, landed: DataFrame) -> DataFrame:
        rows = landed.where(self.feed.publish_filter) if self.feed.publish_filter else landed
        return publication(rows, self.feed, self.profile)

    def landed(self, spark: SparkSession, slice_id: str) -> DataFrame:
        """Exactly this slice, not those whose ids begin with its id."""
        schema = T.StructType(
            [
                T.StructField(c, T.IntegerType() if c in self.feed.ints else T.StringType())
                for c in self.feed.output_columns
            ]
        )
        return read_table(spark, self.table_root, schema).where(F.col("slice") == slice_id)

    def run(self, spark: SparkSession, slice_id: str) -> bool:
        """Process one slice; False when the size gate held it back."""
        if self.max_bytes is not None and not admits(spark, f"{self.lines_root}/{slice_id}", self.max_bytes):
            return False
        lines = read_lines(spark, self.lines_root, slice_id)
        replace_slice(self.clean(lines), self.table_root, slice_id)
        if self.rejects_root:
            replace_slice(rejected_lines(lines, self.feed), self.rejects_root, slice_id)
        if self.publish:
            self.publish(self.published(self.landed(spark, slice_id)), slice_id)
        if self.done_root:
            mark_done(spark, self.done_root, self.feed.name, slice_id)
        return True


def keyed_publisher(root: str) -> Callable[[DataFrame, str], None]:
    """Publishes each slice as one batch of a keyed table."""

    def publish(rows: DataFrame, slice_id: str) -> None:
        upsert(rows, root, slice_id)

    return publish
