"""Kafka topic as a stream of text values.

The connector jar is a deployment matter (``--packages``); nothing else in the
library depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(brokers: str, topic: str, starting: str = "earliest", **extra: str) -> dict[str, str]:
    """Reader options. Offsets live in the query's checkpoint, not in the
    consumer group, so nothing is committed to the broker."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
        **extra,
    }


def read_kafka(spark: SparkSession, brokers: str, topic: str, **extra: str) -> DataFrame:
    """``key, value`` as text, and where each message comes from."""
    stream = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **extra)).load()
    return stream.selectExpr("cast(key as string) as key", "cast(value as string) as value", "topic", "partition", "offset")


def read_text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Files as a stream of lines, with the same downstream as the topic."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
