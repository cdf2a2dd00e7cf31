"""Quality sheet: signalling and CoAP attempts and failures per number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import fold_listed
from ..operators.kpi import Measure, count_by
from ..operators.reports import Section, aligned, chained

SECTIONS = (
    Section("mdn", ("alls", "fails"), "n_s3"),
    Section("mdn1", ("all_cnt", "fail_cnt"), "n_s2"),
    Section("mdn2", ("upcnt", "up_fail_cnt", "down_cnt", "down_fail_cnt"), "n_c1"),
    Section("mdn3", ("up1_cnt", "up1_fail_cnt", "down1_cnt", "down1_fail_cnt"), "n_c2"),
)


def quality_counts(s5s8: DataFrame, coap: DataFrame, ids: DataFrame) -> DataFrame:
    """All counters of all listed numbers from one aggregate over both feeds.

    ``ids``: mdn. Failure means a status other than 0 (CoAP: other than 0 and
    2); a null status is no failure.
    """
    common = ["MSISDN", "feed", "kind", "direction", "status"]
    signalling = s5s8.where(F.col("Procedure_Type").isin("2", "3")).select(
        "MSISDN",
        F.lit("s").alias("feed"),
        F.col("Procedure_Type").alias("kind"),
        F.lit("").alias("direction"),
        F.col("Procedure_Status").alias("status"),
    )
    exchanges = coap.where(F.col("ProcedureType").isin("1", "2")).select(
        "MSISDN",
        F.lit("c").alias("feed"),
        F.col("ProcedureType").alias("kind"),
        F.col("Direction").alias("direction"),
        F.col("Status").alias("status"),
    )
    rows = signalling.select(common).unionByName(exchanges.select(common))

    def of(feed: str, kind: str):
        return (F.col("feed") == feed) & (F.col("kind") == kind)

    measures = [
        Measure("n_s3", of("s", "3")),
        Measure("alls", of("s", "3")),
        Measure("fails", of("s", "3") & (F.col("status") != "0")),
        Measure("n_s2", of("s", "2")),
        Measure("all_cnt", of("s", "2")),
        Measure("fail_cnt", of("s", "2") & (F.col("status") != "0")),
    ]
    for kind, tag in (("1", ""), ("2", "1")):
        measures.append(Measure(f"n_c{kind}", of("c", kind)))
        for direction, name in (("1", "up"), ("2", "down")):
            there = of("c", kind) & (F.col("direction") == direction)
            total = f"{name}{tag}_cnt" if (tag or name == "down") else "upcnt"
            measures.append(Measure(total, there))
            measures.append(Measure(f"{name}{tag}_fail_cnt", there & ~F.col("status").isin("0", "2")))
    return fold_listed(rows, ids, "MSISDN", "mdn", lambda some: count_by(some, ["MSISDN"], measures))


def quality_sheet(
    s5s8: DataFrame, coap: DataFrame, ids: DataFrame, cust_id: str, day: str, align: bool = False
) -> DataFrame:
    """``align`` gives one row per number; otherwise numbers without session
    setups have one row per section, as full outer joins on the first section
    leave them."""
    counts = quality_counts(s5s8, coap, ids)
    sheet = aligned(counts, "MSISDN", SECTIONS) if align else chained(counts, "MSISDN", SECTIONS)
    return sheet.select(F.lit(day).alias("datatime"), F.lit(cust_id).alias("cust_id"), *sheet.columns)
