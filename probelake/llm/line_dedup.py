"""Line deduplication: lines that many documents share are dropped everywhere.

Lines are exploded, normalised and hashed; documents are counted per hash; lines of hashes at or over the threshold go;
the rest is put together again by position. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import BLANKS, lower_ascii, same, text_key


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> list[Column]:
    """128 bits of a key, in two columns."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("line"), key).alias("_h2")]


def common_line_hashes(docs: DataFrame, min_docs: int, min_chars: int, text: str = "text") -> DataFrame:
    """Hashes of the keys with at least ``min_chars`` code points found in at least ``min_docs`` rows of ``docs``.

    A row counts once however often it holds the line; counts are combined before the shuffle.
    """
    keys = F.array_distinct(F.transform(_lines(F.col(text)), line_key))
    return (
        docs.select(F.explode(keys).alias("_key"))
        .where(F.char_length("_key") >= min_chars)
        .select(*_hashes(F.col("_key")))
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"))
        .where(F.col("_docs") >= min_docs)
        .select("_h1", "_h2")
    )


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with shared lines dropped from ``text``, plus ``n_lines`` (before) and ``n_dropped``.

    Every row is a document, also one that repeats another's id. A null text counts as one empty line and stays null.
    A text of which every line goes becomes empty. Columns of ``docs`` named like the added ones are replaced; others,
    of whatever name, are kept.

    Only (row, position, hash) travels to the shared hashes, whose table is written first so that a line in a third of
    all documents is a skewed join that adaptive execution can split. Whole texts are shuffled once and not sorted.
    """
    common = staged(common_line_hashes(docs, min_docs, min_chars, text), "shared-lines")
    at = docs.select(
        F.col(id_col).alias("_id"), text_key(F.col(text)).alias("_text"), F.posexplode(_lines(F.col(text))).alias("_pos", "_line")
    ).select("_id", "_text", "_pos", *_hashes(line_key(F.col("_line"))))
    dropped = (
        at.join(common, ["_h1", "_h2"], "left_semi")
        .groupBy("_id", "_text")
        .agg(F.collect_set("_pos").alias("_drop"))
    )
    whole = docs.select(
        F.struct(*[c for c in docs.columns if c.lower() not in (text.lower(), "n_lines", "n_dropped")]).alias("_row"),
        F.col(id_col).alias("_id"),
        text_key(F.col(text)).alias("_text"),
        F.col(text).alias("_whole"),
    )
    # Positions are few beside texts: the texts stream past a hash table of a partition's positions, unsorted.
    joined = whole.join(dropped.hint("shuffle_hash"), same(whole, dropped, "_id", "_text"), "left")
    joined = joined.select("_row", "_drop", F.col("_whole").isNull().alias("_null"), _lines(F.col("_whole")).alias("_lines"))
    n = F.size("_lines")
    kept = F.when(F.col("_drop").isNull(), F.sequence(F.lit(0), n - 1)).otherwise(
        F.array_except(F.sequence(F.lit(0), n - 1), F.col("_drop"))
    )
    out = joined.select(
        "_row.*",
        F.when(~F.col("_null"), F.array_join(F.transform(kept, lambda i: F.col("_lines")[i]), "\n")).alias(text),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.array_size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return out.select(*[c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
