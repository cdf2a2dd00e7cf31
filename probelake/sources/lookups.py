"""Lookup and id-list readers (text files) and renamed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P


def lookup_from_lines(
    lines: DataFrame, names: Sequence[str], sep: str = ",", exact: bool = False, value: str = "value"
) -> DataFrame:
    """First ``len(names)`` fields of each line. ``exact`` keeps only lines with
    exactly that many fields, otherwise shorter lines are left out."""
    n = len(names)
    split = lines.select(P.split_drop(F.col(value), sep).alias("_f"))
    size = F.size("_f")
    split = split.where(size == n if exact else size >= n)
    return split.select(*[P.field(F.col("_f"), i).alias(c) for i, c in enumerate(names)])


def read_sites_3g(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``sid, provName, cityName``; other arities are dropped."""
    return lookup_from_lines(spark.read.text(path), ("sid", "provName", "cityName"), "\t", exact=True)


def read_codes(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Comma-separated code table."""
    return lookup_from_lines(spark.read.text(path), names)


def read_ids(spark: SparkSession, path: str, name: str = "MDN", first_field: bool = True) -> DataFrame:
    """Id list: the first comma field of each line, or the whole line."""
    value = F.col("value")
    return spark.read.text(path).select(
        (P.field(P.split_keep(value, ","), 0) if first_field else value).alias(name)
    )


def read_dimension(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Columnar dimension with renames, e.g. ``["mdn", "custid as cust_id"]``."""
    return spark.read.format(fmt).load(path).selectExpr(*columns)
