"""Exact top-k search by inner product with a vector-approximation file.

Equal vectors are searched once. Every vector is stored as one byte a dimension, the cell that its component falls in;
scanning the cells gives bounds on each score, and exact vectors are read in the order of the bounds until no unread one
can be among the best k. Queries and vectors meet in blocks, as matrix products inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged

#: Scaled components must stay below this, so that a score over 64 dimensions fits 64 bits.
LARGEST = 1 << 28
DATA_BLOCK = 1024
QUERY_BLOCK = 256


def integer_vectors(rows: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` with ``v`` = floor(scale * x) of each component.

    Rows without id or vector, with an empty vector, and with a null, non-finite or (scaled) over-large component take
    no part. Of several rows with one id the one with the smallest vector does.
    """
    scaled = lambda x: F.floor(x.cast("double") * scale)
    fit = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST), F.lit(False)))
    return (
        rows.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & fit)
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, scaled).alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def _blocks(rows: DataFrame, size: int, width: int | None) -> DataFrame:
    """Rows ``cls, v`` packed to ``dim, ids, cells``: 8-byte ids and row-major vectors.

    With ``width`` a component becomes the byte of its cell, without it stays whole (8 bytes).
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby(batch["v"].map(len)):
                for at in range(0, len(own), size):
                    part = own.iloc[at : at + size]
                    whole = np.array(part["v"].tolist(), dtype=np.int64)
                    data = whole if width is None else (whole // width).astype(np.int8)
                    ids = part["cls"].to_numpy(np.int64)
                    yield pd.DataFrame({"dim": [dim], "ids": [ids.tobytes()], "cells": [data.tobytes()]})

    return rows.mapInPandas(pack, "dim int, ids binary, cells binary")


def _scan(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """Candidates ``query, cls, upper, lower`` of each pair of a query block and a data block.

    A task remembers, for each query, the k-th best lower bound it has met, and passes on only what can still beat it.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.dim != row.q_dim:
                    continue
                ids, queries = np.frombuffer(row.ids, np.int64), np.frombuffer(row.q_ids, np.int64)
                cells = np.frombuffer(row.cells, np.int8).reshape(len(ids), row.dim).astype(np.float64)
                q = np.frombuffer(row.q_cells, np.int64).reshape(len(queries), row.dim).astype(np.float64)
                corner = (q @ cells.T) * width
                low = corner + (width - 1) * np.minimum(q, 0).sum(1)[:, None]
                high = corner + (width - 1) * np.maximum(q, 0).sum(1)[:, None]
                known = best.get(row.q_ids)
                seen = low if known is None else np.concatenate([known, low], axis=1)
                if seen.shape[1] > k:
                    seen = -np.partition(-seen, k - 1, axis=1)[:, :k]
                best[row.q_ids] = seen
                needed = seen.min(1) if seen.shape[1] == k else np.full(len(queries), -np.inf)
                at_q, at = np.nonzero(high >= needed[:, None])
                yield pd.DataFrame(
                    {"query": queries[at_q], "cls": ids[at], "upper": high[at_q, at].astype(np.int64), "lower": low[at_q, at].astype(np.int64)}
                )

    return pairs.mapInPandas(scan, "query long, cls long, upper long, lower long")


def _exact(candidates: DataFrame, classes: DataFrame) -> DataFrame:
    """``query, cls, score``: whole vectors are read for the candidates."""
    left = classes.select(F.col("cls").alias("query"), F.col("v").alias("q"))
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda t, x: t + x)
    return candidates.join(left, "query").join(classes, "cls").select("query", "cls", product.alias("score"))


def top_k(
    rows: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other rows, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``. Vectors are compared with those of equal length only. A query with fewer
    than k others gets them all. Which rows take part: see ``integer_vectors``. Other columns are not looked at.

    Copies: of equal vectors the k + 1 smallest ids are kept (more cannot be in a result), found before the shuffle by
    a limited window, so a vector that a third of all rows share costs as much as any other. The k + 1 best of a vector
    are found once and serve all queries that have it. Query blocks are sent once to each of ``P`` parts of the
    approximation file, ``P`` a multiple of the cluster's cores.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows, scale, id_col, vector)
    alike = Window.partitionBy("v")
    ranked = staged(
        vectors.withColumn("_n", F.row_number().over(alike.orderBy("vec_id"))).where(F.col("_n") <= k + 1), "vector-members"
    )
    first = ranked.where(F.col("_n") == 1).select(F.col("vec_id").alias("cls"), "v")
    classes = staged(first, "vector-classes")
    members = ranked.join(classes, "v").select("cls", "vec_id")
    asked = staged(
        vectors.where(is_query).join(classes, "v").select(F.col("vec_id").alias("query_id"), F.col("cls").alias("query")),
        "vector-queries",
    )
    largest = classes.agg(F.max(F.array_max(F.transform("v", lambda x: F.greatest(x, -x - 1))))).first()[0] or 0
    width = 1
    while largest // width > 127:
        width *= 2
    parts = spark.sparkContext.defaultParallelism * 4
    file = staged(_blocks(classes, DATA_BLOCK, width), "vector-approximations").withColumn(
        "part", F.pmod(F.xxhash64("ids"), F.lit(parts))
    )
    questions = _blocks(classes.join(asked.select(F.col("query").alias("cls")).distinct(), "cls"), QUERY_BLOCK, None)
    sent = staged(questions, "vector-questions").select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
    )
    found = staged(_scan(file.join(sent, "part"), width, k + 1), "vector-candidates")
    of_query = Window.partitionBy("query")
    certain = (
        found.withColumn("_n", F.row_number().over(of_query.orderBy(F.desc("lower"), "cls")))
        .where(F.col("_n") <= k + 1).groupBy("query")
        .agg(F.when(F.count(F.lit(1)) > k, F.min("lower")).alias("_least"))
    )
    held = found.join(certain, "query").where(F.col("_least").isNull() | (F.col("upper") >= F.col("_least")))
    ordered = staged(
        held.select("query", "cls", "upper", F.row_number().over(of_query.orderBy(F.desc("upper"), "cls")).alias("_n")),
        "vector-order",
    )
    read = staged(_exact(ordered.where(F.col("_n") <= k + 1), classes), "vector-scores")
    bound = read.groupBy("query").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("_least"))
    open_still = ordered.where(F.col("_n") > k + 1).join(bound, "query").where(F.col("upper") >= F.col("_least"))
    scores = read.unionByName(_exact(open_still.select("query", "cls"), classes))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = (
        scores.join(members, "cls").select("query", "vec_id", "score")
        .withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(staged(answers, "vector-answers"), "query").where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
