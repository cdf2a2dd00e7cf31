"""Ended RADIUS sessions and their subscribers, per five-minute partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import NB_MARKER, Lookup, count_enriched
from ..operators.kpi import Measure, labelled

#: Key of the site table per network.
SITE_KEYS = {"3g": ("sid", "sid"), "4g": ("bsid", "enbid"), "nb": ("bsid", "enbid")}


def ended_sessions(radius: DataFrame, network: str, marker: str = NB_MARKER) -> DataFrame:
    """Stop records of a network; 4G and NB share a feed and differ by access point, of which ``marker`` is a part for NB."""
    stopped = radius.where(F.col("status") == "Stop")
    if network == "4g":
        return stopped.where(~F.col("apn").contains(marker))
    if network == "nb":
        return stopped.where(F.col("apn").contains(marker))
    return stopped


def offline_stats(
    radius: DataFrame, crm: DataFrame, sites: DataFrame, network: str, time: str, prefold: bool | None = None,
    marker: str = NB_MARKER,
) -> DataFrame:
    """Sessions and distinct numbers per customer, province, city and cause.

    ``crm``: mdn, cust_id. ``sites``: sid or enbid, provName, cityName.
    """
    fact_key, site_key = SITE_KEYS[network]
    facts = ended_sessions(radius, network, marker).select("mdn", fact_key, F.col("terminatecause").alias("TerminateCause"))
    lookups = [
        Lookup(sites, fact_key, site_key, ("provName", "cityName")),
        Lookup(crm, "mdn", "mdn", ("cust_id",)),
    ]
    by = ["cust_id", "provName", "cityName", "TerminateCause"]
    counts = count_enriched(facts, lookups, by, [Measure("session_cnt")], {"mdn_cnt": "mdn"}, prefold)
    named = labelled(counts, ["provName", "cityName"])
    return named.select(F.lit(time).alias("datatime"), *by, "session_cnt", "mdn_cnt")


def all_offline_stats(
    ha: DataFrame, pgw: DataFrame, crm: DataFrame, sites_3g: DataFrame, sites_4g: DataFrame, time: str
) -> dict[str, DataFrame]:
    """The three statistics by network."""
    return {
        "3g": offline_stats(ha, crm, sites_3g, "3g", time),
        "4g": offline_stats(pgw, crm, sites_4g, "4g", time),
        "nb": offline_stats(pgw, crm, sites_4g, "nb", time),
    }
