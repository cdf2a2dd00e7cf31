"""Sharding by sampled splitters: near-equal bytes per shard, copies together.

Records are ordered by a 64-bit key of their text, so equal texts are neighbours. A size-weighted sample of keys gives
quantile boundaries; records are range-partitioned by them; overfull ranges (a text with very many copies, for example)
are subdivided by id; the ranges, in key order, are dealt to the shards by their bytes. Only DataFrame functions are used.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged

#: Range of the unit draws below.
_SPAN = 1 << 53


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def sampled_splitters(sized: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """At most ``ranges - 1`` ascending key boundaries at byte quantiles.

    A record is drawn with probability ``min(1, size * m / total)`` for ``m = ranges * per_range``, by a hash of its id
    and key, so about ``m`` records at most come back whatever the size of the table. A drawn record stands for
    ``max(size, total / m)`` bytes.
    """
    step = max(total // (ranges * per_range), 1)
    unit = F.pmod(F.xxhash64(F.lit("draw"), "_id", "_key"), F.lit(_SPAN)) / F.lit(float(_SPAN))
    drawn = sized.where(unit < F.col("size") / F.lit(float(step))).select(
        "_key", F.greatest("size", F.lit(step)).alias("bytes")
    )
    sample = sorted((row["_key"], row["bytes"]) for row in drawn.collect())
    if not sample:
        return []
    reached = list(accumulate(weight for _, weight in sample))
    marks = (bisect_left(reached, reached[-1] * i / ranges) for i in range(1, ranges))
    return sorted({sample[min(at, len(sample) - 1)][0] for at in marks})


def _longs(values: list[int]) -> Column:
    """A constant array, built by one call however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at or below ``key``: a binary search inside one expression."""
    if not splitters:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(splitters).bit_length()))]
    boundaries = _longs(splitters)
    found = lambda at, step: F.when(
        (at + step <= len(splitters)) & (F.get(boundaries, at + step - 1) <= key), at + step
    ).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), found)


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, ranges: int = 4096, per_range: int = 16, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per record: ``id_col, size, text_crc32, shard, slot``; sizes per shard are near equal.

    Records with equal texts share a shard unless their range holds over twice the mean bytes or rows, when it is
    subdivided by a hash of the id. A shard misses ``total / shards`` by about two ranges (``2 * shards / ranges`` of
    it) or its largest record. ``slot`` numbers a shard's records from 0 without gaps, in key order.

    The driver sees the drawn keys (see ``sampled_splitters``) and one line per range and subdivision: at most
    ``3 * ranges`` lines however many records there are. Null ids and null texts (size 1, CRC of no bytes) are records
    like others; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    sized = staged(
        docs.select(
            F.col(id_col).alias("_id"),
            record_size(F.col(text)).alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col(text)).alias("_key"),
        ),
        "sized-records",
    )
    total, n = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    splitters = sampled_splitters(sized, total, ranges, per_range)
    ranged = sized.withColumn("_range", range_of(F.col("_key"), splitters))
    found = ranged.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    parts = {
        row["_range"]: max(row["bytes"] * ranges // max(total, 1), row["rows"] * ranges // max(n, 1))
        for row in found
    }
    split = {at: count for at, count in parts.items() if count > 2}
    counts = [split.get(i, 1) for i in range(len(splitters) + 1)]
    divided = ranged.withColumn(
        "_part",
        F.pmod(F.xxhash64(F.lit("part"), "_id"), F.get(_longs(counts), F.col("_range"))),
    )
    cells = divided.groupBy("_range", "_part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    plan, before, used = [], 0, [0] * shards
    for cell in sorted(cells, key=lambda c: (c["_range"], c["_part"])):
        shard = min(shards - 1, (2 * before + cell["bytes"]) * shards // (2 * max(total, 1)))
        plan.append((cell["_range"], cell["_part"], shard, used[shard]))
        used[shard] += cell["rows"]
        before += cell["bytes"]
    dealt = spark.createDataFrame(plan, "_range int, _part long, shard int, _first long")
    here = Window.partitionBy("_range", "_part").orderBy("_key", "_id", "size")
    return (
        divided.withColumn("_at", F.row_number().over(here))
        .join(dealt, ["_range", "_part"])
        .select(
            F.col("_id").alias(id_col), "size", "text_crc32", "shard",
            (F.col("_first") + F.col("_at") - 1).alias("slot"),
        )
    )
