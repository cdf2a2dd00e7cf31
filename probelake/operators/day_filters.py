"""Which keys are new: membership filters of the known ones, one for each day that keys were found on.

A filter is a Bloom filter in bitmaps of 32,768 bits, made with Spark's own bitmap aggregates; filters of several days merge
by OR. Most of the known list is never read: a key that no filter has is new for sure, the others are looked up in the days
whose filter has them, and of those days only rows cross the network that the filter of the asked keys has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from ..sinks.files import replace_slice
from ..sources.slices import read_table

#: Bits of a bitmap, as Spark's bitmap functions cut them.
BITMAP_BITS = 32_768
#: Bits of a filter, and bits that a key sets. For a million keys a day one in 400 others passes.
BITS, HASHES = 1 << 23, 4
DAY = "day"
FILTER = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType())])


def bit_places(key: Column, bits: int = BITS, hashes: int = HASHES) -> Column:
    """The bits of a key, from 1 on, as Spark's bitmap functions count them."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) + 1 for i in range(hashes)])


def key_filter(keys: DataFrame, key: str, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """``bucket, bitmap`` of the keys that are not null; buckets without a bit are left out. Combines on the map side."""
    places = keys.where(F.col(key).isNotNull()).select(F.explode(bit_places(F.col(key), bits, hashes)).alias("_at"))
    return places.groupBy(F.bitmap_bucket_number("_at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bitmap")
    )


def merged_filter(filters: DataFrame) -> DataFrame:
    """The filter of all keys of several filters."""
    return filters.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def has_bit(bitmap: Column, place: Column) -> Column:
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0


def passing(keys: DataFrame, key: str, filters: DataFrame, by: list[str], bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """``by, key`` for the distinct ``keys`` that a filter has; ``by`` names the filter, none if there is one only.

    Keys meet the bitmaps by bucket, as ``hashes`` rows each, so no task needs a whole filter.
    """
    asked = keys.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    places = asked.select("_key", F.explode(bit_places(F.col("_key"), bits, hashes)).alias("_at"))
    met = places.withColumn("bucket", F.bitmap_bucket_number("_at")).join(filters, "bucket").where(has_bit(F.col("bitmap"), F.col("_at")))
    hits = met.groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == hashes)
    return hits.select(*by, F.col("_key").alias(key))


def known_keys(
    spark: SparkSession, asked: DataFrame, key: str, known_root: str, filters_root: str, before: str,
    bits: int = BITS, hashes: int = HASHES,
) -> DataFrame:
    """The distinct ``asked`` keys that the known list has from days before ``before``. Exact: filters only spare reading."""
    filters = read_table(spark, filters_root, FILTER, (DAY,), fmt="parquet").where(F.col(DAY) < before)
    likely = staged(passing(asked, key, merged_filter(filters), [], bits, hashes), "keys-likely-known")
    hits = staged(passing(likely, key, filters, [DAY], bits, hashes), "keys-by-day")
    days = [row[DAY] for row in hits.select(DAY).distinct().collect()]
    schema = T.StructType([likely.schema[key]])
    if not days:
        return spark.createDataFrame([], schema)
    listed = read_table(spark, known_root, schema, (DAY,), fmt="parquet").where(F.col(DAY).isin(days))
    return hits.join(listed, [DAY, key], "left_semi").select(key).distinct()


def find_new(
    spark: SparkSession, seen: DataFrame, key: str, known_root: str, filters_root: str, day: str,
    bits: int = BITS, hashes: int = HASHES,
) -> DataFrame:
    """The distinct keys of ``seen`` that no earlier day had, and takes them up as those of ``day``.

    Null counts as new whenever it is seen and is not kept. A day that runs again finds the same keys and replaces its
    own. Days may be added in any order, but a key is new to each day that has no earlier one.
    """
    asked = staged(seen.select(key).distinct(), "keys-seen")
    known = known_keys(spark, asked, key, known_root, filters_root, day, bits, hashes)
    fresh = staged(asked.join(known, key, "left_anti"), "keys-new")
    found = fresh.where(F.col(key).isNotNull())
    replace_slice(found, known_root, day, fmt="parquet", column=DAY)
    replace_slice(key_filter(found, key, bits, hashes), filters_root, day, fmt="parquet", column=DAY)
    return fresh
