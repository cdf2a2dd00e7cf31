"""New gateways and per-subscriber CoAP reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import NB_MARKER, Lookup, count_enriched, fold_listed, unknown_keys
from ..operators.kpi import Measure, all_present
from ..operators.lists import value_lists

COUNTERS = ("upcons", "upnons", "downcons", "downconSucc", "downnons")


def new_gateways(s5s8: DataFrame, known: DataFrame, day: str) -> DataFrame:
    """Gateway addresses seen today and never before. ``known``: SGW_IP_Add."""
    fresh = unknown_keys(s5s8, known, "SGW_IP_Add")
    return fresh.select(F.lit(day).alias("sta_time"), F.col("SGW_IP_Add").alias("sgw_add_ip"))


def subscriber_counters(
    coap: DataFrame, ids: DataFrame, gateways: DataFrame, server: str, day: str, prefold: bool | None = None
) -> DataFrame:
    """Five counters per listed number and province, where all are above zero.

    ``ids``: MDN. ``gateways``: SGSNIPAddress, PROVNAME. Only traffic with
    ``server`` counts.
    """

    def is_(procedure: str, direction: str):
        return (F.col("ProcedureType") == procedure) & (F.col("Direction") == direction)

    facts = coap.where(F.col("AppServerIP") == server)
    measures = [
        Measure("upcons", is_("1", "1")),
        Measure("upnons", is_("2", "1")),
        Measure("downcons", is_("1", "2")),
        Measure("downconSucc", is_("1", "2") & F.col("Status").isin("0", "2")),
        Measure("downnons", is_("2", "2")),
    ]
    lookup = Lookup(gateways, "SGWIP", "SGSNIPAddress", ("PROVNAME",), "left")

    def fold(some: DataFrame) -> DataFrame:
        return count_enriched(some, [lookup], ["MSISDN", "PROVNAME"], measures, prefold=prefold)

    counts = fold_listed(facts, ids, "MSISDN", "MDN", fold)
    complete = all_present(counts, COUNTERS, ["MSISDN", "PROVNAME"])
    return complete.select(F.lit(day).alias("whichDay"), "MSISDN", "PROVNAME", *COUNTERS)


def outside_addresses(coap: DataFrame, ids: DataFrame, allowed: str, marker: str = NB_MARKER) -> DataFrame:
    """Addresses other than the allowed one that listed numbers talked to.

    ``coap`` covers the days asked for; ``marker`` is part of the access point
    names looked at. A row ``mdn, DestinationIP, times`` per number and address;
    ``joined_lists`` makes one text per number of them.
    """
    outside = coap.where(F.col("APN").contains(marker) & (F.col("DestinationIP") != allowed))
    wanted = ids.select(F.col("mdn").alias("MSISDN"))
    lists = value_lists(outside, "MSISDN", "DestinationIP", only=wanted)
    named = ids.select("mdn").join(lists, F.col("mdn") == F.col("MSISDN"))
    return named.select("mdn", "DestinationIP", "times")
