"""Partial figures of ten minutes, merged to hours and days without going back to the records.

A partial holds counts and sums, which add up, and for distinct numbers both a sketch, which merges in a fixed size, and
the numbers themselves, each once for a slot and group. An hour's numbers are merged from its slots', a day's from its
hours', so what is read becomes less with every step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.manifest import Change
from ..sources.manifest import holds_batch, live_files, newest, read_manifest

#: Digits of a slot's name: ten minutes, an hour, a day.
SLOT, HOUR, DAY = 11, 10, 8
LEVELS = (SLOT, HOUR, DAY)


class RollUp:
    """A table of partials at ``root``: records have ``time`` (``yyyyMMddHHmm...`` text), ``by`` columns and ``number``.

    ``sums`` maps names to columns that are added up; ``records`` counts all rows. ``by`` gives the grouping columns'
    types. Times, groups and numbers may be null; null numbers are counted as records only.
    """

    def __init__(
        self, spark: SparkSession, root: str, by: T.StructType, number: T.StructField, sums: Mapping[str, str] | None = None
    ) -> None:
        self.spark, self.root, self.by, self.number = spark, root, by, number
        self.sums = dict(sums or {})
        self.keys = ["slot", *by.names]

    def _schema(self, *more: T.StructField) -> T.StructType:
        return T.StructType([T.StructField("slot", T.StringType()), *self.by.fields, *more])

    @property
    def figures(self) -> T.StructType:
        added = [T.StructField(name, T.DoubleType()) for name in self.sums]
        return self._schema(T.StructField("records", T.LongType()), *added, T.StructField("sketch", T.BinaryType()))

    @property
    def numbers(self) -> T.StructType:
        return self._schema(self.number)

    def add(self, rows: DataFrame, run: str, batch: int, time: str) -> int | None:
        """The partials of a batch of records as one version; None, without work, if the table holds the batch.

        Several batches may bring records of one slot, also late ones, in any order.
        """
        if holds_batch(self.spark, self.root, run, batch):
            return None
        change = Change(self.spark, self.root)
        slotted = rows.withColumn("slot", F.substring(time, 1, SLOT))
        number = F.col(self.number.name)
        added = [F.sum(F.col(column).cast("double")).alias(name) for name, column in self.sums.items()]
        figures = slotted.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("records"), *added, F.hll_sketch_agg(number.cast("string")).alias("sketch")
        )
        change.add(f"figures-{SLOT}", figures.select(*self.figures.names), ["slot"])
        once = slotted.where(number.isNotNull()).select(*self.keys, self.number.name).distinct()
        change.add(f"numbers-{SLOT}", once, ["slot"])
        return change.commit(run, batch)

    def _read(self, kind: str, schema: T.StructType, version: int | None = None) -> DataFrame:
        """All partials of a kind, at whatever level they are kept now."""
        parts = [read_manifest(self.spark, self.root, schema, f"{kind}-{level}", version=version) for level in LEVELS]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def _merge_figures(self, rows: DataFrame, digits: int) -> DataFrame:
        cut = rows.withColumn("slot", F.substring("slot", 1, digits))
        added = [F.sum(c).alias(c) for c in ("records", *self.sums)]
        return cut.groupBy(*self.keys).agg(*added, F.hll_union_agg("sketch").alias("sketch")).select(*self.figures.names)

    def _merge_numbers(self, rows: DataFrame, digits: int) -> DataFrame:
        return rows.withColumn("slot", F.substring("slot", 1, digits)).select(*self.numbers.names).distinct()

    def fold(self, digits: int, until: str) -> int:
        """Replaces the partials of slots before ``until`` that are finer than ``digits`` by merged ones; files replaced.

        ``until`` is a time that ``digits`` divide. Records that come later for a folded slot are partials of their own
        beside it, and the next fold takes them in. Readers see all partials once, before and after.
        """
        version = newest(self.spark, self.root)
        change, gone = Change(self.spark, self.root), 0
        for kind, schema, merge in (("figures", self.figures, self._merge_figures), ("numbers", self.numbers, self._merge_numbers)):
            finer = [f"{kind}-{level}" for level in LEVELS if level > digits] + [f"{kind}-{digits}"]
            files = live_files(self.spark, self.root, version=version).where(F.col("label").isin(finer))
            old = files.where(F.col("least") < until)
            paths = [row["path"] for row in old.select("path").collect()]
            if not paths:
                continue
            gone += len(paths)
            rows = self.spark.read.schema(schema).orc([f"{self.root}/{path}" for path in paths])
            ripe = F.coalesce(F.col("slot") < until, F.lit(True))
            change.add(f"{kind}-{digits}", merge(rows.where(ripe), digits), ["slot"])
            # A file may reach beyond the time; its later rows stay as fine as they were.
            rest = rows.where(~ripe)
            if not rest.isEmpty():
                change.add(f"{kind}-{SLOT}", rest, ["slot"])
            change.remove(old)
        if gone:
            change.commit()
        return gone

    def read(self, digits: int, version: int | None = None) -> DataFrame:
        """``slot, by, records, sums, numbers, numbers_estimate`` of each slot, hour or day and group; ``numbers`` is exact."""
        version = newest(self.spark, self.root) if version is None else version
        figures = self._merge_figures(self._read("figures", self.figures, version), digits)
        once = self._merge_numbers(self._read("numbers", self.numbers, version), digits)
        counted = once.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("numbers"))
        on = self._same(figures, counted)
        named = [figures[c] for c in (*self.keys, "records", *self.sums)]
        return figures.join(counted, on, "left").select(
            *named, F.coalesce("numbers", F.lit(0)).cast("long").alias("numbers"),
            F.hll_sketch_estimate(figures["sketch"]).alias("numbers_estimate"),
        )

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        condition = F.lit(True)
        for key in self.keys:
            condition = condition & left[key].eqNullSafe(right[key])
        return condition


def text_field(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def group_fields(names: Sequence[str]) -> T.StructType:
    """Grouping columns that are all text."""
    return T.StructType([text_field(name) for name in names])
