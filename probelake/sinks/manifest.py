"""Writing tables that are lists of files (see ``sources.manifest``).

Data is written first, where no reader looks; then one entry of the log makes all of it visible at once. A batch is named
in the entry that brings its rows, so it is known however often its files are merged afterwards.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import MISSING
from ..operators.ranges import merge_ranges
from ..sources.manifest import ENTRY, folded, holds_batch, landed_batches, live_files, newest, sort_key, versions

MIB = 1024 * 1024
#: Rows that one task sorts into a merged file, about; rows that take few bytes fill more files than their bytes call for.
TASK_ROWS = 1 << 20
#: Versions after which the log is folded.
FOLD_EVERY = 20
#: Above every sort key.
LAST_KEY = "\U0010ffff"
#: Attempts at a version when others write as well.
ATTEMPTS = 100


class Conflict(RuntimeError):
    """Another writer removed a file that this change replaces."""


def _appears(spark: SparkSession, source: str, target: str) -> bool:
    """Moves a folder to a name that must be free; whether it was."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    if new.getFileSystem(conf).exists(new):
        return False
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(old.toUri(), conf).rename(old, new, plain)
    except Exception as error:  # noqa: BLE001
        if new.getFileSystem(conf).exists(new):
            return False
        raise error
    return True


def _make_folder(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)


def _key_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``name, n_bytes, key`` as one row a file: its smallest and largest key, how many rows, how many without key."""
    found: dict[tuple[str, int], tuple[str | None, str | None, int, int]] = {}
    for batch in batches:
        names = pc.dictionary_encode(batch.column("name"))
        for i, name in enumerate(names.dictionary.to_pylist()):
            own = batch if len(names.dictionary) == 1 else batch.filter(pc.equal(names.indices, i))
            n_bytes, keys = own.column("n_bytes")[0].as_py(), own.column("key")
            ends = pc.min_max(keys).as_py()
            least, most, n_rows, n_marked = found.get((name, n_bytes), (None, None, 0, 0))
            least = min((k for k in (least, ends["min"]) if k is not None), key=str.encode, default=None)
            most = max((k for k in (most, ends["max"]) if k is not None), key=str.encode, default=None)
            found[name, n_bytes] = least, most, n_rows + len(own), n_marked + keys.null_count
    if found:
        columns = zip(*[(*file, *held) for file, held in found.items()], strict=True)
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["name", "n_bytes", "least", "most", "n_rows", "n_marked"])


class Change:
    """One version in the making: files written by ``add``, replaced by ``replace``, visible after ``commit``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")
        self._entries: list[DataFrame] = []
        self._removed: DataFrame | None = None

    def _entry(self, rows: DataFrame, action: str) -> DataFrame:
        typed = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None) for f in ENTRY.fields}
        typed["action"] = F.lit(action)
        return rows.select(*[typed[f.name].cast(f.dataType).alias(f.name) for f in ENTRY.fields])

    def add(self, label: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Writes ``rows`` as files of ``label``, each sorted by the text columns ``keys``; returns them as written.

        The tasks that make the rows write them, so landing costs no shuffle and as many files as there are tasks.
        """
        folder = f"data/{label}/{uuid.uuid4().hex}"
        ordered = rows.sortWithinPartitions(*keys) if keys else rows
        ordered.write.orc(f"{self._root}/{folder}")
        return self.record(label, folder, rows.schema, keys)

    def record(self, label: str, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
        """Takes up the ORC files of a folder of the table that somebody else wrote; returns their rows."""
        written = self._spark.read.schema(schema).orc(f"{self._root}/{folder}")
        marked = F.col(keys[0]).eqNullSafe(F.lit(MISSING)) if keys else F.lit(False)
        held = written.select(
            F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("n_bytes"),
            F.when(~marked, sort_key(keys)).alias("key"),
        )
        # Tasks sum up what they read: an aggregate of texts would sort all rows by their file.
        parts = held.mapInArrow(_key_ranges, "name string, n_bytes long, least string, most string, n_rows long, n_marked long")
        files = parts.groupBy(F.concat(F.lit(f"{folder}/"), "name").alias("path"), "n_bytes").agg(
            F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n_rows").alias("n_rows"), F.sum("n_marked").alias("n_marked")
        )
        self._entries.append(self._entry(files.withColumn("label", F.lit(label)), "add"))
        return written

    def remove(self, files: DataFrame) -> None:
        """Takes ``files`` (rows of ``live_files``) out of the table; they stay readable in older versions."""
        self._removed = files if self._removed is None else self._removed.unionByName(files)

    def commit(self, run: str | None = None, batch: int | None = None) -> int | None:
        """The new version; None if the table holds this batch already, and then nothing changes.

        Raises ``Conflict`` if another writer removed one of the removed files first.
        """
        spark, root = self._spark, self._root
        if run is not None and holds_batch(spark, root, run, batch):
            return None
        rows = list(self._entries)
        if run is not None:
            one = spark.range(1).select(F.lit(run).alias("run"), F.lit(batch).alias("lo"), F.lit(batch + 1).alias("hi"))
            rows.append(self._entry(one, "batch"))
        if self._removed is not None:
            rows.append(self._entry(self._removed, "remove"))
        if not rows:
            return newest(spark, root)
        entry = rows[0]
        for more in rows[1:]:
            entry = entry.unionByName(more)
        staging = f"{root}/staging/{uuid.uuid4().hex}"
        entry.coalesce(1).write.json(staging)
        _make_folder(spark, f"{root}/log")
        seen = None
        for _ in range(ATTEMPTS):
            version = newest(spark, root)
            if seen != version:
                if self._removed is not None:
                    lost = self._removed.select("path").join(live_files(spark, root), "path", "left_anti")
                    if not lost.isEmpty():
                        raise Conflict("a file to be replaced is gone")
                if seen is not None and run is not None and holds_batch(spark, root, run, batch):
                    return None
                seen = version
            if _appears(spark, staging, f"{root}/log/{version + 1:012d}"):
                if (version + 1) % FOLD_EVERY == 0:
                    fold_log(spark, root, version + 1)
                return version + 1
        raise Conflict(f"no free version in {ATTEMPTS} attempts")


def fold_log(spark: SparkSession, root: str, version: int) -> None:
    """Writes a version's files and batches in one piece; reading starts there. Doing it twice changes nothing."""
    if version in folded(spark, root):
        return
    files = live_files(spark, root, version=version)
    held = merge_ranges(landed_batches(spark, root, version), ["run"])
    change = Change(spark, root)
    whole = change._entry(files, "add").unionByName(change._entry(held, "batch"))
    staging = f"{root}/staging/{uuid.uuid4().hex}"
    whole.write.json(staging)
    _make_folder(spark, f"{root}/full")
    _appears(spark, staging, f"{root}/full/{version:012d}")


def land(spark: SparkSession, root: str, run: str, batch: int, rows: DataFrame, keys: Sequence[str], label: str = "rows") -> int | None:
    """One batch of rows as one version; None, without writing, if the table holds the batch."""
    if holds_batch(spark, root, run, batch):
        return None
    change = Change(spark, root)
    change.add(label, rows, keys)
    return change.commit(run, batch)


def cluster(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], label: str = "rows",
    least: str = "", most: str = LAST_KEY, target_bytes: int = 128 * MIB, target_rows: int = TASK_ROWS,
) -> tuple[int, int]:
    """Merges the small files whose sort keys lie within ``least`` to ``most`` into files of about ``target_bytes``, or
    ``target_rows`` where that is less.

    Files of at least half of either target stay. The new ones hold ranges of the sort key, cut within a key that has most of
    the rows, so that later reads open few. Returns how many files went and came. Readers see the old files or the new
    ones, batches stay known. A failure before the commit changes nothing; raises ``Conflict`` if another writer was
    faster with the same files.
    """
    from_, to = F.coalesce("least", F.lit("")), F.coalesce("most", F.lit(""))
    small = live_files(spark, root, label, newest(spark, root)).where(
        (F.col("n_bytes") < target_bytes // 2) & (F.col("n_rows") < target_rows // 2) & (from_ >= least) & (to <= most)
    )
    found = small.agg(F.count(F.lit(1)).alias("files"), F.sum("n_bytes").alias("bytes"), F.sum("n_rows").alias("rows")).first()
    wanted = max(math.ceil((found["bytes"] or 0) / target_bytes), math.ceil((found["rows"] or 0) / target_rows))
    if found["files"] <= wanted or found["files"] < 2:
        return 0, 0
    paths = [f"{root}/{row['path']}" for row in small.select("path").collect()]
    rows = spark.read.schema(schema).orc(paths)
    # The hash lets a key with most of the rows fill several files.
    spread = rows.repartitionByRange(wanted, *keys, F.xxhash64(*rows.columns)) if wanted > 1 else rows.coalesce(1)
    change = Change(spark, root)
    change.add(label, spread, keys)
    change.remove(small)
    version = change.commit()
    entry = spark.read.schema(ENTRY).json(f"{root}/log/{version:012d}")
    return found["files"], entry.where("action = 'add'").count()


def expire(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Deletes the files that none of the newest ``keep`` versions has, and the log before them; returns how many went.

    Only files that an entry of the log removed are touched, never those of a change still in the making.
    """
    kept = versions(spark, root)[-keep:]
    if not kept:
        return 0
    fold_log(spark, root, kept[0])
    old = [v for v in versions(spark, root) if v <= kept[0]]
    removed = spark.read.schema(ENTRY).json([f"{root}/log/{v:012d}" for v in old]).where("action = 'remove'").select("path")
    paths = [row["path"] for row in removed.distinct().collect()]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    deleted = sum(1 for path in paths if fs.delete(hadoop.Path(f"{root}/{path}"), False))
    for version in old[:-1]:
        fs.delete(hadoop.Path(f"{root}/log/{version:012d}"), True)
    for version in folded(spark, root):
        if version < kept[0]:
            fs.delete(hadoop.Path(f"{root}/full/{version:012d}"), True)
    return deleted
