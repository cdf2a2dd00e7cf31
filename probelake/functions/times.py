"""Slice ids, five-minute partitions and epoch bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def m5_columns(ts: Column) -> dict[str, Column]:
    """Partition values of a timestamp: day, hour, minute floored to 5."""
    minute = F.floor(F.minute(ts) / 5) * 5
    return {
        "d": F.date_format(ts, "yyyyMMdd"),
        "h": F.date_format(ts, "HH"),
        "m5": F.lpad(minute.cast("string"), 2, "0"),
    }


def m5_of_text(text: Column) -> dict[str, Column]:
    """Partition values of ``yyyy-MM-dd HH:mm:ss`` text.

    Only the last minute digit is interpreted; null parts mean the text is too
    short or that digit is not one.
    """
    unit = F.substring(text, 16, 1)
    ok = (F.length(text) >= 16) & unit.rlike("^[0-9]$")
    floored = F.when(unit < "5", "0").otherwise("5")
    return {
        "d": F.when(ok, F.replace(F.substring(text, 1, 10), F.lit("-"), F.lit(""))),
        "h": F.when(ok, F.substring(text, 12, 2)),
        "m5": F.when(ok, F.concat(F.substring(text, 15, 1), floored)),
    }


def slice_day(slice_id: Column) -> Column:
    """``yyyyMMdd`` of a ``yyyyMMddHHmm`` slice id."""
    return F.substring(slice_id, 1, 8)


def slice_ten_minutes(slice_id: Column) -> Column:
    """Prefix shared by the slices of one 10-minute bucket."""
    return F.substring(slice_id, 1, 11)


def slice_display(slice_id: Column) -> Column:
    """Start of the 10-minute bucket as ``yyyy-MM-dd HH:mm:00`` text."""
    s = F.rpad(slice_ten_minutes(slice_id), 12, "0")
    return F.date_format(F.try_to_timestamp(s, F.lit("yyyyMMddHHmm")), "yyyy-MM-dd HH:mm:ss")


def day_start_millis(day: Column) -> Column:
    """``yyyyMMdd`` to epoch milliseconds in the session time zone."""
    return F.unix_millis(F.try_to_timestamp(day, F.lit("yyyyMMdd")))
