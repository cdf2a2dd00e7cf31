"""JDBC result tables.

Rows go from the executors straight to the database. Replacing a slice and
upserting use one statement each, run by the driver before or after the load.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import MISSING


def jdbc_options(url: str, table: str, batch_rows: int = 1000, connections: int = 16, **extra: str) -> dict[str, str]:
    """Writer options. ``connections`` bounds the number of parallel tasks that
    hold a database connection, whatever the size of the result."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        **extra,
    }


def append_rows(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()


def sink_defaults(df: DataFrame) -> DataFrame:
    """Null becomes -1 at the database boundary, for text and numbers."""
    text = [n for n, t in df.dtypes if t == "string"]
    numbers = [n for n, t in df.dtypes if t in ("int", "bigint", "float", "double") or t.startswith("decimal")]
    return df.fillna(MISSING, subset=text).fillna(-1, subset=numbers)


def delete_statement(table: str, conditions: Mapping[str, str]) -> str:
    """``DELETE`` with a placeholder per condition column."""
    return f"DELETE FROM {table} WHERE " + " AND ".join(f"{c} = ?" for c in conditions)


def expire_statement(table: str, column: str) -> str:
    """Retention: remove rows older than a bound."""
    return f"DELETE FROM {table} WHERE {column} < ?"


def merge_statement(table: str, stage: str, keys: Sequence[str], values: Sequence[str]) -> str:
    """Upsert ``stage`` into ``table`` in one standard ``MERGE``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    update = ", ".join(f"t.{v} = s.{v}" for v in values)
    columns = [*keys, *values]
    return (
        f"MERGE INTO {table} t USING {stage} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {update} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
        f"VALUES ({', '.join('s.' + c for c in columns)})"
    )


def duplicate_key_statement(table: str, stage: str, keys: Sequence[str], values: Sequence[str]) -> str:
    """The same upsert where there is no ``MERGE``: ``table`` has a unique index on ``keys``."""
    columns = ", ".join([*keys, *values])
    update = ", ".join(f"{v} = VALUES({v})" for v in values)
    return f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage} ON DUPLICATE KEY UPDATE {update}"


def upsert_statement(url: str, table: str, stage: str, keys: Sequence[str], values: Sequence[str]) -> str:
    """The upsert in the words of the database that ``url`` names."""
    dialect = url.split(":")[1] if url.startswith("jdbc:") else ""
    statement = duplicate_key_statement if dialect in ("mysql", "mariadb") else merge_statement
    return statement(table, stage, keys, values)


def execute(spark: SparkSession, url: str, sql: str, values: Sequence[str] = ()) -> int:
    """Run one statement through the JVM's JDBC driver, committed on success."""
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.prepareStatement(sql)
        for i, value in enumerate(values, 1):
            statement.setString(i, value)
        changed = statement.executeUpdate()
        connection.commit()
        return changed
    finally:
        connection.close()


def replace_rows(df: DataFrame, url: str, table: str, conditions: Mapping[str, str], **options: str) -> None:
    """Delete the rows of an earlier run, then insert: a rerun is harmless."""
    execute(df.sparkSession, url, delete_statement(table, conditions), list(conditions.values()))
    append_rows(df, url, table, **options)


def upsert_rows(
    df: DataFrame, url: str, table: str, stage: str, keys: Sequence[str], **options: str
) -> None:
    """Load a staging table from the executors, then merge it in the database.

    ``stage`` begins the staging table's name; each run has one of its own and
    drops it in the end, so runs side by side do not meet.
    """
    own = f"{stage}_{uuid.uuid4().hex[:12]}"
    values = [c for c in df.columns if c not in keys]
    try:
        df.write.format("jdbc").options(**jdbc_options(url, own, **options)).mode("error").save()
        execute(df.sparkSession, url, upsert_statement(url, table, own, keys, values))
    finally:
        execute(df.sparkSession, url, f"DROP TABLE IF EXISTS {own}")
