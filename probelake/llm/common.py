"""What several operators share: reading, row keys, words, per-worker memory."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts name it: ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. For pure ASCII the fast built-in does the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` runs of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN, -1))


def text_key(text: Column) -> Column:
    """64 bits of a text; with the id they name a row, or rows that are alike in both."""
    return F.xxhash64(text)


#: Whole texts that go to a Python worker together; Spark's own 10,000 take hundreds of megabytes on both sides.
TEXT_ROWS = 1000


def text_batches(rows: DataFrame) -> DataFrame:
    """``rows``, whose session sends at most ``TEXT_ROWS`` of them to a Python worker at a time from now on."""
    conf = rows.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(name, "10000"))
    if not 0 < now <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return rows


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns that both sides have."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def worker_memo(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()`` once per Python worker process, which serves many tasks."""
    name = "_probelake_worker_memo"
    memo = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in memo:
        memo[key] = make()
    return memo[key]


def tokenizer_file() -> str:
    """The vocabulary that the queries and the pipeline use; operators take its path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer_file() -> str:
    """The byte-level vocabulary of the queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
