"""How far each feed is complete: the time up to which every slice of it has landed.

Slices land out of order and some late; an audit of a day may begin when no feed can still bring records of it. Slice ids
are start times, ``yyyyMMddHH`` (an hour) or ``yyyyMMddHHmm``; minutes since 1970 stand for times inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import merge_ranges

HOUR, DAY = 60, 24 * 60


def minute_of(text: Column) -> Column:
    """Minutes since 1970 of ``yyyyMMdd[HH[mm]]``, whatever the session's time zone; null for other text."""
    whole = F.rpad(text, 12, "0")
    day = F.unix_date(F.try_to_timestamp(F.substring(whole, 1, 8), F.lit("yyyyMMdd")).cast("date")).cast("long")
    hour, minute = (F.substring(whole, at, 2).try_cast("int") for at in (9, 11))
    known = text.rlike(r"^[0-9]{8}([0-9]{2}){0,2}$") & (hour < 24) & (minute < 60)
    return F.when(known, day * DAY + hour * HOUR + minute)


def text_of(minute: Column) -> Column:
    """``yyyyMMddHHmm`` of minutes since 1970."""
    day = F.date_format(F.date_from_unix_date(F.floor(minute / DAY).cast("int")), "yyyyMMdd")
    left = F.pmod(minute, F.lit(DAY))
    return F.concat(day, F.lpad(F.floor(left / HOUR).cast("string"), 2, "0"), F.lpad((left % HOUR).cast("string"), 2, "0"))


def slice_ranges(done: DataFrame, step: int) -> DataFrame:
    """``feed, lo, hi``: the minutes that each landed slice covers; ids of ten digits an hour, longer ones ``step``."""
    lo = minute_of(F.col("slice"))
    width = F.when(F.length("slice") == 10, F.lit(HOUR)).otherwise(F.lit(step))
    return done.select("feed", lo.alias("lo"), (lo + width).alias("hi")).where(F.col("lo").isNotNull())


def frontiers(done: DataFrame, feeds: Sequence[str], start: str, step: int = 5) -> DataFrame:
    """``feed, complete_until, newest_until, missing_minutes`` (times as text) for each of ``feeds`` from ``start`` on.

    ``done`` has a row ``feed, slice`` for each landed slice, repeated ones too. ``complete_until`` is the first minute
    that no slice covers; behind it may be more, up to ``newest_until``, with ``missing_minutes`` in between. A feed
    without slices is complete until ``start``. The ledger is merged to ranges, so its length does not matter.
    """
    spark = done.sparkSession
    at = minute_of(F.lit(start))
    named = spark.createDataFrame([(feed,) for feed in feeds], "feed string").withColumn("_start", at)
    landed = slice_ranges(done, step).join(named.select("feed", "_start"), "feed").where(F.col("hi") > F.col("_start"))
    begin = named.select("feed", (F.col("_start") - 1).alias("lo"), F.col("_start").alias("hi"))
    clipped = landed.select("feed", F.greatest("lo", F.col("_start") - 1).alias("lo"), "hi").unionByName(begin)
    merged = merge_ranges(clipped, ["feed"], bucket=30 * DAY)
    ends = merged.groupBy("feed").agg(
        F.min(F.struct("lo", "hi")).alias("_first"), F.max("hi").alias("_last"), F.sum(F.col("hi") - F.col("lo")).alias("_held")
    )
    span = F.col("_last") - F.col("_first.lo")
    return ends.select(
        "feed", text_of(F.col("_first.hi")).alias("complete_until"), text_of(F.col("_last")).alias("newest_until"),
        (span - F.col("_held")).cast("long").alias("missing_minutes"),
    )


def open_days(frontier: DataFrame, feeds: Sequence[str], days: DataFrame, late_hours: int = 1) -> DataFrame:
    """``day, is_open, lagging`` for each of ``days`` (column ``day``).

    A day opens for its audit when all ``feeds`` are complete until ``late_hours`` after its end, since records of the day
    land in those as well. ``lagging`` lists the feeds that are not, in order.
    """
    needed = minute_of(F.col("day")) + DAY + late_hours * HOUR
    asked = days.select("day", needed.alias("_needed"), F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed"))
    behind = F.coalesce(minute_of(F.col("complete_until")) < F.col("_needed"), F.lit(True))
    judged = asked.join(frontier.select("feed", "complete_until"), "feed", "left").groupBy("day").agg(
        F.sort_array(F.collect_set(F.when(behind, F.col("feed")))).alias("_behind")
    )
    return judged.select("day", (F.size("_behind") == 0).alias("is_open"), F.array_join("_behind", ",").alias("lagging"))


def is_open(done: DataFrame, feeds: Sequence[str], day: str, late_hours: int = 1, step: int = 5) -> tuple[bool, str]:
    """Whether the audit of ``day`` may begin, and the feeds that it waits for. Only the day and what follows count."""
    spark = done.sparkSession
    asked = spark.createDataFrame([(day,)], "day string")
    row = open_days(frontiers(done, feeds, day, step), feeds, asked, late_hours).first()
    return row["is_open"], row["lagging"]
