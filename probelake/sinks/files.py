"""File sinks: slices, partitions, CSV and text reports.

A single slice is written by the tasks that read it, without a shuffle. Where
rows go to many partitions, or a report should be one file, a ``rebalance``
shuffle lets adaptive execution merge small outputs and split a partition that
holds most of the rows over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _spread(df: DataFrame, by: Sequence[str], tasks: int | None) -> DataFrame:
    return df.repartition(tasks, *by) if tasks else df.hint("rebalance", *by)


def replace_partitions(
    df: DataFrame, root: str, by: Sequence[str], fmt: str = "orc", tasks: int | None = None, **options: str
) -> None:
    """Overwrite exactly the partitions present in ``df``; a rerun gives the
    same table, other partitions stay.

    Without ``tasks`` the number of writing tasks follows the bytes, and a
    partition with most of the rows is split. A few rows for very many
    partitions cost time per file, not per byte: then name the ``tasks``, each
    of which writes whole partitions.
    """
    writer = _spread(df, by, tasks).write.mode("overwrite").partitionBy(*by)
    writer = writer.option("partitionOverwriteMode", "dynamic").options(**options)
    writer.format(fmt).save(root)


def append_partitions(
    df: DataFrame, root: str, by: Sequence[str], fmt: str = "orc", tasks: int | None = None, **options: str
) -> None:
    writer = _spread(df, by, tasks).write.mode("append").partitionBy(*by)
    writer.options(**options).format(fmt).save(root)


def replace_slice(df: DataFrame, root: str, slice_id: str, fmt: str = "orc", column: str = "slice") -> None:
    """Land one slice as a partition, replacing an earlier run of it."""
    writer = df.withColumn(column, F.lit(slice_id)).write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "dynamic").format(fmt).save(root)


def expire_slices(spark: SparkSession, root: str, oldest: str, column: str = "slice") -> int:
    """Retention that removes data: deletes the partitions of ``root`` below ``oldest``.

    Only folders named ``<column>=<id>`` directly under ``root`` are looked at.
    Returns how many went.
    """
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at = hadoop_path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.globStatus(hadoop_path(f"{root}/{column}=*")) or []]
    old = [path for path in found if path.getName().partition("=")[2] < oldest]
    for path in old:
        fs.delete(path, True)
    return len(old)


def keep_slices_from(table: DataFrame, oldest: str, column: str = "slice") -> DataFrame:
    """Retention: the slices from ``oldest`` on (prunes the partitions left out)."""
    return table.where(F.col(column) >= oldest)


def write_orc(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").orc(path)


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",", append: bool = False) -> None:
    """CSV report. A small report ends up in one file, a large one in many, so
    no report is ever squeezed through a single task."""
    writer = df.hint("rebalance").write.mode("append" if append else "overwrite")
    writer.option("header", header).option("sep", sep).csv(path)


def write_text(df: DataFrame, path: str, sep: str = ",") -> None:
    """Rows as text lines."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).hint("rebalance").write.mode("overwrite").text(path)
