"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every job relies on; a cluster may override all of them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Buckets of one sorted file are read as sorted.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Spark's default for a source whose size it does not know.
UNKNOWN_SIZE = 2**63 - 1
#: Sources beyond this many broadcast thresholds are not measured but called large.
MEASURED_AT_MOST = 20
#: Files may take so many times their size in memory; estimates from files are held against that.
MOST_COMPRESSED = 10


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would be lost
    with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="probelake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything matching a glob, exists."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system that Spark reads it from, for writers that do not go through Spark."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and gives several consumers one common scan. The copy
    survives the loss of any executor, unlike cached blocks.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimised plan of ``df``."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def source_bytes(df: DataFrame) -> int:
    """Estimated size of everything the plan of ``df`` reads, as far as known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_SIZE)


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to broadcast under the session threshold.

    A table's estimate is trusted when it is small even if its files are highly
    compressed. Catalyst multiplies the sizes of joined tables, so a larger
    estimate is checked by measuring decoded rows: at most as many are read as
    could fit.
    """
    limit = broadcast_limit(df.sparkSession)
    if limit <= 0:
        return False
    if 0 < MOST_COMPRESSED * plan_bytes(df) <= limit:
        return True
    if source_bytes(df) > MEASURED_AT_MOST * limit:
        return False
    row_floor = 8 * (len(df.columns) + 1)
    most = limit // row_floor
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns]
    width = F.lit(8)
    for w in widths:
        width = width + w
    seen = df.limit(most + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return seen["rows"] <= most and (seen["bytes"] or 0) <= limit
