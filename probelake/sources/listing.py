"""File listings as DataFrames: sizes, counts per feed and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])


def list_files(spark: SparkSession, pattern: str, recursive: bool = True) -> DataFrame:
    """``path, length`` of every file below a glob; file contents are not read."""
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], LISTING)
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(pattern).select("path", "length")


def with_directory(listing: DataFrame) -> DataFrame:
    return listing.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).withColumn(
        "file", F.regexp_extract("path", r"([^/]*)$", 1)
    )


def total_bytes(listing: DataFrame) -> int:
    row = listing.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()
    return int(row["n"])


def count_files(listing: DataFrame, day: str, tag: str) -> DataFrame:
    """One row: how many files carry the day in their name."""
    hits = with_directory(listing).where(F.col("file").contains(day))
    return hits.agg(F.count(F.lit(1)).alias("n")).select(F.lit(tag).alias("tag"), "n")
