"""Small-file maintenance: how many files, which files together, rewrite."""

from __future__ import annotations

import bisect
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.listing import list_files, total_bytes
from ..sources.slices import read_m5

MIB = 1024 * 1024
#: Groups that the files of one size class are numbered in.
CELLS = 1024
#: Fixed value: target size of a merged file.
GROUP_LIMIT = 128 * MIB


def files_by_size(length: Column, size_mb: int, round_up: bool = False) -> Column:
    """Number of files of ``size_mb`` MiB for ``length`` bytes: whole files plus
    one, or rounded up."""
    exact = length / F.lit(MIB) / F.lit(size_mb)
    return (F.ceil(exact) if round_up else F.floor(exact) + 1).cast("bigint")


def within_gate(listing: DataFrame, by: str, max_bytes: int) -> DataFrame:
    """Groups of files (slices, say) that are small enough to be processed."""
    sizes = listing.groupBy(by).agg(F.sum("length").alias("total_bytes"))
    return sizes.where(F.col("total_bytes") < max_bytes)


def admits(spark: SparkSession, pattern: str, max_bytes: int) -> bool:
    return total_bytes(list_files(spark, pattern)) < max_bytes


def size_class(length: Column) -> Column:
    """``length`` rounded up to its seven leading bits: at most 64 classes for each power of two, 1.6 per cent above."""
    shift = F.greatest(F.length(F.bin(length)) - 7, F.lit(0))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.greatest(F.ceil(length / unit) * unit, F.lit(1)).cast("long")


def group_small_files(listing: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """``dir, path, length, grp``: files of a directory packed below ``limit``.

    Files go largest first into the fullest group that still has room, by their size class; a file at or above the limit
    stays alone. A directory of any number of files has one plan, made from how many files each size class has (some
    thousand rows at most); files are numbered within a class and find their group by number. So the groups depend on
    the files alone, not on how they are dealt to tasks.
    """
    files = listing.select("dir", "path", "length", size_class(F.col("length")).alias("size"))
    cell = F.pmod(F.xxhash64("path"), F.lit(CELLS))
    counts = files.groupBy("dir", "size", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    plan_schema = "dir string, size long, ranges array<struct<first: long, n: long, grp: long, per: long>>"

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("size", ascending=False)
        planned = plan_groups(list(zip(ordered["size"].tolist(), ordered["n"].tolist(), strict=True)), limit)
        rows = [(pdf["dir"].iloc[0], size, [dict(zip(("first", "n", "grp", "per"), r, strict=True)) for r in own]) for size, own in planned]
        return pd.DataFrame(rows, columns=["dir", "size", "ranges"])

    groups = counts.groupBy("dir", "size").agg(F.sum("n").alias("n")).groupBy("dir").applyInPandas(plan, plan_schema)
    # Numbers within a class: first those of a cell of it, so that no task gathers a class that most files have.
    before = Window.partitionBy("dir", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("dir", "size", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("dir", "size", "cell").orderBy("path")
    numbered = files.withColumn("cell", cell).withColumn("_n", F.row_number().over(inside) - 1)
    placed = numbered.join(firsts, ["dir", "size", "cell"]).join(groups, ["dir", "size"])
    rank = F.col("_before") + F.col("_n")
    own = F.filter("ranges", lambda r: (r["first"] <= rank) & (rank < r["first"] + r["n"]))[0]
    grp = (own["grp"] + F.floor((rank - own["first"]) / own["per"])).cast("long")
    return placed.select("dir", "path", "length", grp.alias("grp"))


def plan_groups(classes: list[tuple[int, int]], limit: int) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """Best fit for ``(size, files)`` in descending sizes: per size, ranges ``(first, files, first group, files each)``.

    Equal files fill one group after the other, as they would one by one, so whole runs of groups are placed together.
    """
    room = limit - 1
    gaps: list[tuple[int, int, int]] = []  # (free, first group, groups), ascending
    planned, groups = [], 0
    for size, count in classes:
        ranges, first = [], 0
        while first < count:
            at = bisect.bisect_left(gaps, (size, -1, -1))
            if at < len(gaps):
                free, group, n = gaps.pop(at)
            else:
                free, group, n = max(room, size), groups, -(-(count - first) // max(1, room // size))
                groups += n
            per = free // size
            took = min(count - first, per * n)
            ranges.append((first, took, group, per))
            whole, rest = divmod(took, per)
            left = [(free - per * size, group, whole), (free - rest * size, group + whole, 1 if rest else 0)]
            left.append((free, group + whole + bool(rest), n - whole - bool(rest)))
            for run in left:
                if run[0] > 0 and run[2] > 0:
                    bisect.insort(gaps, run)
            first += took
        planned.append((size, ranges))
    return planned


def compact_m5(
    spark: SparkSession, root: str, target: str, schema: T.StructType, d: str, h: str, m5: str, size_mb: int = 128
) -> int:
    """Rewrite one closed five-minute partition below ``target`` with as many
    files as its bytes call for. Returns that number.

    The source stays as it is, so a failed run is simply repeated.
    """
    size = total_bytes(list_files(spark, f"{root}/d={d}/h={h}/m5={m5}"))
    n = math.floor(size / MIB / size_mb) + 1
    rows = read_m5(spark, root, schema, d, h, m5)
    body = [c for c in rows.columns if c not in ("d", "h", "m5")]
    rows.select(*body, "d", "h", "m5").coalesce(n).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("d", "h", "m5").orc(target)
    return n


def replace_m5(
    spark: SparkSession, root: str, aside: str, schema: T.StructType, d: str, h: str, m5: str, size_mb: int = 128
) -> int:
    """Compact one closed five-minute partition of ``root`` for its readers.

    The merged copy is written ``aside`` first and then replaces the partition;
    until that is committed readers see the old files. If it fails on the way,
    the copy is whole and the call can be repeated. Returns the files written.
    """
    n = compact_m5(spark, root, aside, schema, d, h, m5, size_mb)
    body = [c for c in schema.names if c not in ("d", "h", "m5")]
    merged = read_m5(spark, aside, schema, d, h, m5).select(*body, "d", "h", "m5")
    merged.coalesce(n).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d", "h", "m5").orc(root)
    return n
