"""Reading tables that are lists of files.

A manifest table is what the entries of its log add up to: each entry adds files, removes files and names the batches that
it holds. An entry is a folder ``log/<version>`` that appears at once or not at all, so readers see whole versions. Every
so often the log is folded into ``full/<version>``, and reading starts there.

Files carry the smallest and largest value of the columns that they are sorted by, so a reader opens those only that can
hold what it looks for. Rows marked as unusable, with ``MISSING`` for the first of these columns, are counted apart, so that
one of them does not widen a file's range.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import MISSING
from ..session import path_exists

#: ``action``: add or remove a file of ``label``, or hold batches ``[lo, hi)`` of a run.
ENTRY = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("action", "label", "path", "least", "most")),
        *(T.StructField(n, T.LongType()) for n in ("n_rows", "n_marked", "n_bytes")),
        T.StructField("run", T.StringType()), T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
    ]
)
#: Values that a filter lists; more are looked up.
LISTED = 1000
#: Between the values of a sort key; below every digit and letter.
SEPARATOR = "/"


def sort_key(keys: Sequence[str]) -> Column:
    """One text that orders like the text columns ``keys``, as long as their values are of equal length."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def _names(spark: SparkSession, folder: str) -> list[int]:
    """The versions below a folder, ascending."""
    if not path_exists(spark, folder):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    names = [status.getPath().getName() for status in found]
    return sorted(int(name) for name in names if name.isdigit())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that can be read: those still in the log, ascending."""
    return _names(spark, f"{root}/log")


def newest(spark: SparkSession, root: str) -> int:
    """The newest version, 0 for a table without any."""
    return max(versions(spark, root), default=0)


def folded(spark: SparkSession, root: str) -> list[int]:
    return _names(spark, f"{root}/full")


def entries(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All entries that make up a version; only those still in the log can be asked for."""
    known = versions(spark, root)
    if version == 0:
        return spark.createDataFrame([], ENTRY)
    if version and version not in known:
        raise ValueError(f"version {version} is not kept")
    start = max((v for v in folded(spark, root) if version is None or v <= version), default=0)
    later = [v for v in known if v > start and (version is None or v <= version)]
    paths = [f"{root}/full/{start:012d}"] * (start > 0) + [f"{root}/log/{v:012d}" for v in later]
    if not paths:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(paths)


def live_files(spark: SparkSession, root: str, label: str | None = None, version: int | None = None) -> DataFrame:
    """``label, path, least, most, n_rows, n_marked, n_bytes`` of the files of a version; paths are relative to the table."""
    found = entries(spark, root, version)
    if label is not None:
        found = found.where(F.col("label") == label)
    added = found.where("action = 'add'").select("label", "path", "least", "most", "n_rows", "n_marked", "n_bytes")
    gone = found.where("action = 'remove'").select("path")
    return added.join(gone, "path", "left_anti").select(*added.columns)


def landed_batches(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``run, lo, hi``: the batches that a version holds, wherever their rows are now."""
    return entries(spark, root, version).where("action = 'batch'").select("run", "lo", "hi")


def holds_batch(spark: SparkSession, root: str, run: str, batch: int) -> bool:
    found = landed_batches(spark, root).where((F.col("run") == run) & (F.col("lo") <= batch) & (F.col("hi") > batch))
    return not found.isEmpty()


def matching_files(files: DataFrame, wanted: Sequence[str] | None) -> list[str]:
    """Paths of the files that can hold one of the sort keys ``wanted`` (all files if None).

    Paths go through the driver, as they do for any read of files; the keys of a batch or a query are few.
    """
    if wanted is None:
        return [row["path"] for row in files.select("path").collect()]
    ordered = sorted(set(wanted))
    if not ordered:
        return []
    marked = F.lit(any(key.startswith(MISSING) for key in ordered)) & (F.col("n_marked") > 0)
    inside = (F.col("most") >= ordered[0]) & (F.col("least") <= ordered[-1])
    near = files.where(marked | inside).select("path", "least", "most", marked.alias("marked")).collect()

    def hit(row: Row) -> bool:
        at = bisect_left(ordered, row["least"] or "")
        return row["marked"] or (row["most"] is not None and at < len(ordered) and ordered[at] <= row["most"])

    return [row["path"] for row in near if hit(row)]


def read_manifest(
    spark: SparkSession, root: str, schema: T.StructType, label: str = "rows", keys: Sequence[str] = (),
    wanted: Sequence[Sequence[str]] | None = None, version: int | None = None,
) -> DataFrame:
    """Rows of a version; with ``wanted`` (values of ``keys``) only those, read from the files that can hold them."""
    sought = None if wanted is None else [SEPARATOR.join(values) for values in wanted]
    paths = matching_files(live_files(spark, root, label, version), sought)
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).orc([f"{root}/{path}" for path in paths])
    if sought is None:
        return rows
    if len(sought) <= LISTED:
        return rows.where(sort_key(keys).isin(sought))
    listed = spark.createDataFrame([(key,) for key in set(sought)], "_sought string")
    return rows.join(listed, sort_key(keys) == F.col("_sought"), "left_semi")
