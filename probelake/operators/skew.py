"""Joins in which a few keys hold much of the facts: such keys are found by a sketch and dealt to many tasks.

Adaptive execution splits a large partition of a join, but only where the files of the shuffle allow it and only in a sort
merge join; a hot key that is known beforehand can be spread whatever the join and whatever follows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with at least this share of the rows are hot; so there are at most 1 / SHARE of them.
SHARE = 0.01
#: Keys that a sketch tracks: it is off by less than a hundredth of SHARE for any number of rows.
TRACKED = 16_384
#: Parts that a hot key's rows are dealt to.
SALTS = 64


def key_sketch(facts: DataFrame, key: str) -> DataFrame:
    """One row ``sketch, n_rows``: which keys are frequent. Tasks sketch what they read; sketches merge."""
    return facts.agg(
        F.call_function("approx_top_k_accumulate", F.col(key).cast("string"), F.lit(TRACKED)).alias("sketch"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def merged_sketch(sketches: DataFrame) -> DataFrame:
    """The sketch of several days or tables from their sketches."""
    return sketches.agg(
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(TRACKED)).alias("sketch"), F.sum("n_rows").alias("n_rows")
    )


def hot_keys(sketch: DataFrame, share: float = SHARE) -> list[str]:
    """The keys, as text, that hold at least ``share`` of the rows; null is none, since it joins with nothing."""
    most = int(1 / share)
    top = sketch.select("n_rows", F.explode(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(most))).alias("top"))
    found = top.where((F.col("top.count") >= share * F.col("n_rows")) & F.col("top.item").isNotNull())
    return sorted(row["item"] for row in found.select("top.item").collect())


def split_join(
    facts: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: Sequence[str], how: str = "inner",
    hot: Sequence[str] | None = None, salts: int = SALTS,
) -> DataFrame:
    """``facts`` with ``columns`` of ``dim``, as a plain join of ``key = dim_key`` gives them (``inner`` or ``left``).

    Rows of the ``hot`` keys (found by a sketch in a pass over the key column if not given) go to ``salts`` parts by their
    content, the few rows of ``dim`` with such a key to each of them. All other rows are joined plainly. Rows of a hot key
    that are alike in every column stay together; fold them first if most are.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    side = dim.select(F.col(dim_key).alias("_dim_key"), *columns)
    on = F.col(key) == F.col("_dim_key")
    known = hot_keys(key_sketch(facts, key)) if hot is None else list(hot)
    if not known:
        return facts.join(side, on, how).drop("_dim_key")
    is_hot = F.coalesce(F.col(key).cast("string").isin(known), F.lit(False))
    plain = facts.where(~is_hot).join(side.where(~F.coalesce(F.col("_dim_key").cast("string").isin(known), F.lit(False))), on, how)
    dealt = facts.where(is_hot).withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    copies = side.where(F.col("_dim_key").cast("string").isin(known)).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = dealt.join(copies, on & (F.col("_salt") == F.col("_part")), how).drop("_salt", "_part")
    return plain.unionByName(spread).drop("_dim_key")
