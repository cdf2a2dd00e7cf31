"""Readers for slice directories and partitioned tables.

Partition columns stay text (``m5=05`` must not become 5), so every reader of
a partitioned table passes its schema instead of inferring it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import starts_with_any
from ..session import path_exists


def with_text_columns(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    """``schema`` with the partition columns ``names`` as text at its end."""
    body = [f for f in schema.fields if f.name not in names]
    return T.StructType([*body, *[T.StructField(n, T.StringType()) for n in names]])


def read_lines(spark: SparkSession, root: str, slice_id: str | None = None) -> DataFrame:
    """Lines of one slice directory or of a file, gzip included (by suffix)."""
    return spark.read.text(f"{root}/{slice_id}" if slice_id else root)


def read_table(
    spark: SparkSession, root: str, schema: T.StructType, partitions: Sequence[str] = ("slice",), fmt: str = "orc"
) -> DataFrame:
    """A partitioned table; empty, with its schema, while nothing is landed."""
    full = with_text_columns(schema, partitions)
    if not path_exists(spark, root):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).format(fmt).load(root)


def read_slices(
    spark: SparkSession, root: str, schema: T.StructType, prefixes: Sequence[str], fmt: str = "orc"
) -> DataFrame:
    """Slices whose id starts with any prefix; prunes partitions, so only the
    matching directories are listed into the scan."""
    table = read_table(spark, root, schema, ("slice",), fmt)
    return table.where(starts_with_any(F.col("slice"), list(prefixes)))


def read_slice_dirs(
    spark: SparkSession, root: str, prefixes: Sequence[str], fmt: str = "orc", schema: T.StructType | None = None,
    below: str = "",
) -> DataFrame:
    """Plain ``<root>/<slice>`` directories by prefix, several globs as one table.

    ``below`` adds further levels (``"/*"`` for one more). Columns missing in
    some of the files are null, so two layouts of a feed can be read together.
    """
    globs = [f"{root}/{p}*{below}" for p in prefixes]
    present = [g for g in globs if path_exists(spark, g)]
    if not present:
        if schema is None:
            raise FileNotFoundError(f"nothing matches {globs}; pass a schema to read it as empty")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    return reader.load(present)


def read_m5(spark: SparkSession, root: str, schema: T.StructType, d: str, h: str, m5: str, fmt: str = "orc") -> DataFrame:
    """One five-minute partition."""
    table = read_table(spark, root, schema, ("d", "h", "m5"), fmt)
    return table.where((F.col("d") == d) & (F.col("h") == h) & (F.col("m5") == m5))


def read_days(table: DataFrame, first_day: str, last_day: str, column: str = "day") -> DataFrame:
    """A run of days of one day-partitioned table (both ends included)."""
    return table.where(F.col(column).between(first_day, last_day))


def read_json_lines(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """JSON-lines files by glob with a stated schema (no inference pass)."""
    return spark.read.schema(schema).json(pattern)
