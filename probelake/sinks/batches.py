"""Per-partition buffered writes to a client of the caller's choice."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

from ..session import qualified

Client = Any


def write_batches(
    df: DataFrame, connect: Callable[[], Client], put: Callable[[Client, list[Row]], None], size: int = 1000
) -> None:
    """Open one client per partition, hand it rows in lists of at most ``size``
    and close it. A retried task repeats its puts, so ``put`` must be keyed."""

    def run(rows: Iterator[Row]) -> None:
        rows = iter(rows)
        first = list(islice(rows, size))
        if not first:
            return
        client = connect()
        try:
            chunk = first
            while chunk:
                put(client, chunk)
                chunk = list(islice(rows, size))
        finally:
            close = getattr(client, "close", None)
            if close:
                close()

    df.foreachPartition(run)


class FileClient:
    """A client of ``write_batches`` whose store is a folder: each list of rows becomes one Parquet file.

    Files are named by the partition and a count, so a task that runs again writes the same ones over. ``root`` is an
    address that Arrow's file systems know and all executors can reach.
    """

    def __init__(self, root: str, schema: T.StructType) -> None:
        from pyarrow import fs
        from pyspark import TaskContext

        self._fs, self._root = fs.FileSystem.from_uri(root)
        self._fs.create_dir(self._root, recursive=True)
        self._schema, self._part, self._n = schema, TaskContext.get().partitionId(), 0

    def put(self, rows: list[Row]) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        columns = {f.name: [row[f.name] for row in rows] for f in self._schema.fields}
        pq.write_table(pa.table(columns), f"{self._root}/part-{self._part:05d}-{self._n:06d}.parquet", filesystem=self._fs)
        self._n += 1


def write_files(df: DataFrame, root: str, size: int = 1000) -> None:
    """Rows as Parquet files of at most ``size`` rows each, through ``write_batches``. Nothing is shuffled."""
    schema, at = df.schema, qualified(df.sparkSession, root)
    write_batches(df, lambda: FileClient(at, schema), lambda client, rows: client.put(rows), size)
