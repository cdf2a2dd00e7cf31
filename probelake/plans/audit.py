"""Reconciliation, file inventory, probe audit and status extract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import MISSING, above_zero, contains_any, equals_number, number, starts_with_any
from ..operators.kpi import Measure, count_by, distinct_with_null
from ..sources.feeds import (
    HTTP_STATUS_FIELDS,
    PROBE_AUDIT_FIELDS,
    PROBE_AUDIT_HOST,
    PROBE_AUDIT_URL,
    pick_fields,
)

AUDIT_COLUMNS = ("STA_TIME", "CHECKTYPE", "PGW", "USERNUM", "UPFLOW", "DOWNFLOW", "TOTALFLOW")


def _in_sets(df: DataFrame, address: str, sets: Mapping[str, str]) -> DataFrame:
    """Rows once per gateway set (label -> address prefix) they belong to."""
    c = F.col(address)
    labels = F.array_compact(F.array(*[F.when(c.startswith(p), F.lit(name)) for name, p in sets.items()]))
    return df.where(starts_with_any(c, list(sets.values()))).withColumn("PGW", F.explode(labels))


def _every_set(df: DataFrame, sets: Mapping[str, str]) -> DataFrame:
    """A row for each set, also for one without traffic."""
    names = df.sparkSession.createDataFrame([(name,) for name in sets], "PGW string")
    return names.join(df, "PGW", "left")


def recon_traffic(
    feeds: Sequence[DataFrame], sets: Mapping[str, str], apn_prefix: str, day: str, next_day: str, kind: str = "COAP"
) -> DataFrame:
    """Users and octets per gateway set over one day of several feeds.

    The feeds should cover the day's slices and the first hour of the next
    one: records land late, the record time decides. Both bounds are open.
    """
    wanted = ["PGWIP", "MSISDN", "APN", "StartTime", "OutputOctets", "InputOctets"]
    rows = feeds[0].select(wanted)
    for feed in feeds[1:]:
        rows = rows.unionByName(feed.select(wanted))
    rows = rows.where(
        F.col("APN").startswith(apn_prefix)
        & (F.col("StartTime") > day)
        & (F.col("StartTime") < next_day)
        & (above_zero("OutputOctets") | above_zero("InputOctets"))
    )
    out, into = F.sum(number("OutputOctets")), F.sum(number("InputOctets"))
    sums = (
        _in_sets(rows, "PGWIP", sets)
        .groupBy("PGW")
        .agg(
            F.count_distinct("MSISDN").alias("USERNUM"),
            out.alias("UPFLOW"),
            into.alias("DOWNFLOW"),
            (out + into).alias("TOTALFLOW"),
        )
    )
    full = _every_set(sums, sets).fillna(0, subset=["USERNUM", "UPFLOW", "DOWNFLOW", "TOTALFLOW"])
    return full.select(
        F.lit(day).alias("STA_TIME"), F.lit(kind).alias("CHECKTYPE"), "PGW", "USERNUM", "UPFLOW", "DOWNFLOW", "TOTALFLOW"
    )


def recon_bearers(
    s5s8: DataFrame, sets: Mapping[str, str], apn_prefix: str, from_millis: Column, until_millis: Column,
    result_codes: Sequence[str], day: str, kind: str = "S5C",
) -> DataFrame:
    """Created bearers (UPFLOW) and their distinct numbers (USERNUM) per gateway set."""
    start = F.col("Procedure_Start_Time")
    rows = s5s8.where(
        F.col("APN").startswith(apn_prefix)
        & (start > from_millis.cast("string"))
        & (start < until_millis.cast("string"))
        & F.col("Result_Code").isin(list(result_codes))
        & equals_number("Procedure_Type", 3)
        & equals_number("Procedure_Status", 0)
    )
    sums = (
        _in_sets(rows, "PGW_IP_Add", sets)
        .groupBy("PGW")
        .agg(
            distinct_with_null(F.col("MSISDN")).cast("bigint").alias("USERNUM"),
            F.count(F.lit(1)).cast("double").alias("UPFLOW"),
        )
    )
    full = _every_set(sums, sets).fillna(0, subset=["USERNUM", "UPFLOW"])
    return full.select(
        F.lit(day).alias("STA_TIME"), F.lit(kind).alias("CHECKTYPE"), "PGW", "USERNUM", "UPFLOW",
        F.lit(-1.0).alias("DOWNFLOW"), F.lit(-1.0).alias("TOTALFLOW"),
    )


def expected_files(checklist: DataFrame, prefixes: Mapping[str, str], day: str) -> DataFrame:
    """Checklist entries per feed (tag -> file-name prefix), as audit rows."""
    measures = [Measure(tag, F.col("filename").startswith(p)) for tag, p in prefixes.items()]
    return inventory_rows(count_by(checklist, [], measures), list(prefixes), day)


def received_files(listing: DataFrame, folders: Mapping[str, str], day: str) -> DataFrame:
    """Delivered files per feed (tag -> path part) that carry the day in their name."""
    named = listing.where(F.regexp_extract("path", r"([^/]*)$", 1).contains(day))
    measures = [Measure(tag, F.col("path").contains(part)) for tag, part in folders.items()]
    return inventory_rows(count_by(named, [], measures), list(folders), day)


def inventory_rows(counts: DataFrame, tags: Sequence[str], day: str) -> DataFrame:
    """One audit row per counter column."""
    rows = counts.unpivot([], list(tags), "CHECKTYPE", "USERNUM")
    unused = float(MISSING)
    return rows.select(
        F.lit(day).alias("STA_TIME"), "CHECKTYPE", F.lit("ALL").alias("PGW"), "USERNUM",
        F.lit(unused).alias("UPFLOW"), F.lit(unused).alias("DOWNFLOW"), F.lit(unused).alias("TOTALFLOW"),
    )


def reconciliation(traffic: DataFrame, bearers: DataFrame, *inventories: DataFrame) -> DataFrame:
    """All audit rows of a day in one table."""
    table = traffic.select(*AUDIT_COLUMNS).unionByName(bearers.select(*AUDIT_COLUMNS))
    for rows in inventories:
        table = table.unionByName(rows.select(*AUDIT_COLUMNS))
    return table


def http_status_extract(lines: DataFrame, statuses: Sequence[str] = ("302", ""), value: str = "value") -> DataFrame:
    """Redirected or unanswered requests from lines of exactly 100 fields."""
    picked = pick_fields(lines, HTTP_STATUS_FIELDS, n_fields=100, value=value)
    return picked.where(F.col("HttpStatus").isin(list(statuses)))


def probe_audit(lines: DataFrame, numbers: Sequence[str], value: str = "value") -> DataFrame:
    """Requests of test numbers, each distinct record once.

    Lines are searched as text before they are split, so almost none is parsed.
    """
    hits = lines.where(contains_any(F.col(value), numbers))
    wanted = {**PROBE_AUDIT_FIELDS, "_host": PROBE_AUDIT_HOST, "_url": PROBE_AUDIT_URL}
    picked = pick_fields(hits, wanted, value=value)
    picked = picked.where(F.col("_host").isNotNull() & (F.length("MSISDN") > 0))
    url = F.concat("_host", "_url").alias("DestinationURL")
    head = ["StartTime", "EndTime", "MSISDN", "IMSI", "APN", "PGWIP"]
    return picked.select(*head, url, "UserIP", "UserPort", "SourceIP", "SourcePort").dropDuplicates()


def gateway_down_counts(coap: DataFrame, gateways: Sequence[str]) -> DataFrame:
    """Confirmable down exchanges through a set of gateways, all and completed."""
    down = (F.col("ProcedureType") == "1") & (F.col("Direction") == "2")
    done = F.col("Status").isin("0", "2")
    rows = coap.where(F.col("SGWIP").isin(list(gateways)))
    return count_by(rows, [], [Measure("down_all", down), Measure("down_ok", down & done)])


def gateway_session_counts(s5s8: DataFrame, gateways: Sequence[str], rat: str = "8") -> DataFrame:
    """Successful procedures of one radio type per listed gateway."""
    rows = s5s8.where(
        (F.col("RAT") == rat) & (F.col("Procedure_Status") == "0") & F.col("SGW_IP_Add").isin(list(gateways))
    )
    return count_by(rows, ["SGW_IP_Add"], [Measure("cnt")])
