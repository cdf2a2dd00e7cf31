"""Success rates and delays of user-plane and signalling procedures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import equals_number, number, percent, quotient, whole
from ..operators.enrich import NB_MARKER, Lookup, count_enriched, tag_network
from ..operators.kpi import Measure, count_by, long_form, with_total
from . import labels

# Codes in the CoAP feed.
CON, NON = 1, 2
UP, DOWN = 1, 2


def coap_facts(coap: DataFrame, *columns: Column | str) -> DataFrame:
    """The given columns and the exchange as ``kind``, ``way`` (whole numbers),
    ``done`` (status 0 or 2) and ``delay``, converted from text once per row."""
    return coap.select(
        *columns,
        whole("ProcedureType").alias("kind"),
        whole("Direction").alias("way"),
        whole("Status").isin(0, 2).alias("done"),
        (number("AckTime") - number("FirstRequestTime")).alias("delay"),
    )


def exchange(kind: int, way: int) -> Column:
    return (F.col("kind") == kind) & (F.col("way") == way)


def con_non_daily(coap: DataFrame, sites: DataFrame, crm: DataFrame, day: str, prefold: bool | None = None) -> DataFrame:
    """Confirmable and non-confirmable exchanges per customer, province, city
    and network, with success rates; unmatched sites and numbers stay as null.

    ``sites``: enbid, provName, cityName. ``crm``: mdn, custid.
    """
    tagged = coap_facts(coap, "MSISDN", "eNB_ID", tag_network(F.col("APN")).alias("networktype"))
    facts = tagged.where(F.col("networktype").isNotNull())
    measures = [
        Measure("upConcnt", exchange(CON, UP)),
        Measure("upConSucccnt", exchange(CON, UP) & F.col("done")),
        Measure("upNoncnt", exchange(NON, UP)),
        Measure("downConcnt", exchange(CON, DOWN)),
        Measure("downConSucccnt", exchange(CON, DOWN) & F.col("done")),
        Measure("downNoncnt", exchange(NON, DOWN)),
    ]
    lookups = [
        Lookup(sites, "eNB_ID", "enbid", ("provName", "cityName"), "left"),
        Lookup(crm, "MSISDN", "mdn", ("custid",), "left"),
    ]
    counts = count_enriched(
        facts, lookups, ["custid", "provName", "cityName", "networktype"], measures, prefold=prefold
    )
    return counts.select(
        F.lit(day).alias("datatime"), "custid", "provName", "cityName", "networktype",
        "upConcnt", "upConSucccnt", "upNoncnt",
        percent(F.col("upConSucccnt"), F.col("upConcnt"), 2).alias("upConRate"),
        "downConcnt", "downConSucccnt", "downNoncnt",
        percent(F.col("downConSucccnt"), F.col("downConcnt"), 2).alias("downConRate"),
    )


def coap_measures() -> list[Measure]:
    return [
        Measure("up_all", exchange(CON, UP)),
        Measure("up_ok", exchange(CON, UP) & F.col("done")),
        Measure("down_all", exchange(CON, DOWN)),
        Measure("down_ok", exchange(CON, DOWN) & F.col("done")),
        Measure("delay_sum", exchange(CON, DOWN), F.col("delay")),
        Measure("delay_n", exchange(CON, DOWN) & F.col("delay").isNotNull()),
    ]


def customer_rates(
    coap: DataFrame, crm: DataFrame, customers: Sequence[str], day: str, prefold: bool | None = None,
    marker: str = NB_MARKER,
) -> DataFrame:
    """NB up rate, down rate and mean down delay per listed customer, long form.

    ``crm``: mdn, cust_id.
    """
    listed = crm.where(F.col("cust_id").isin(list(customers)))
    facts = coap_facts(coap.where(F.col("APN").contains(marker)), "MSISDN").where(F.col("kind") == CON)
    counts = count_enriched(
        facts, [Lookup(listed, "MSISDN", "mdn", ("cust_id",))], ["cust_id"], coap_measures(), prefold=prefold
    )
    wide = counts.select(
        F.lit(day).alias("gather_date"),
        "cust_id",
        percent(F.col("up_ok"), F.col("up_all"), 2).alias("up"),
        percent(F.col("down_ok"), F.col("down_all"), 2).alias("down"),
        quotient(F.col("delay_sum"), F.col("delay_n"), 2).alias("delay"),
        F.col("down_all"),
        F.col("up_all"),
    )
    kinds = {"up": labels.COAP_UP_RATE, "down": labels.COAP_DOWN_RATE, "delay": labels.COAP_DOWN_DELAY}
    rows = long_form(wide, ["gather_date", "cust_id", "up_all", "down_all"], kinds, "gather_type", "gather_value")
    # A customer has a row per metric only where it was attempted.
    tried = F.when(F.col("gather_type") == labels.COAP_UP_RATE, F.col("up_all")).otherwise(F.col("down_all"))
    return rows.where(tried > 0).select("gather_date", "cust_id", "gather_type", "gather_value")


def _published(
    groups: DataFrame, key: str, names: DataFrame, measures: list[Measure], metrics: dict[str, tuple[str, Column, str]],
    time: str,
) -> DataFrame:
    """Rates per named province plus the national row, in long form.

    ``metrics``: column -> (label, value, counter that must be above zero for a
    province to appear). ``names``: ``key``, PROVNAME. The total is taken ahead
    of the name lookup, so it includes groups the lookup does not know.
    """
    rows = with_total(groups, key, measures, labels.NATIONAL)
    side = names.select(F.col(key).alias("_key"), F.col("PROVNAME").alias("_name"), F.lit(True).alias("_known"))
    both = (
        rows.join(side, (F.col(key) == F.col("_key")) & ~F.col("is_total"), "left")
        .where(F.col("is_total") | F.col("_known"))
        .withColumn("PROVNAME", F.when(F.col("is_total"), F.col(key)).otherwise(F.col("_name")))
    )
    wide = both.select(
        "PROVNAME", "is_total", *[v.alias(c) for c, (_, v, _) in metrics.items()],
        *[F.col(needs).alias(f"_needs_{c}") for c, (_, _, needs) in metrics.items()],
    )
    # Each metric keeps the groups where its counter is above zero.
    entries = [
        F.when(
            F.col("is_total") | (F.col(f"_needs_{c}") > 0),
            F.struct(F.lit(label).alias("DATATYPE"), F.col(c).alias("USERNUM")),
        )
        for c, (label, _, _) in metrics.items()
    ]
    listed = wide.select("PROVNAME", F.explode(F.array_compact(F.array(*entries))).alias("_m"))
    return listed.select(
        F.col("_m.DATATYPE"), F.lit(time).alias("STA_TIME"), F.col("PROVNAME").alias("PRODTYPE"), F.col("_m.USERNUM")
    )


def bearer_setup_rate(s5s8: DataFrame, provinces: DataFrame, time: str) -> DataFrame:
    """Bearer setup success per roaming province. ``provinces``: Roma_Province, PROVNAME."""
    tried = s5s8.where(equals_number("Procedure_Type", 3))
    measures = [Measure("alls"), Measure("succ", equals_number("Procedure_Status", 0))]
    groups = count_by(tried, ["Roma_Province"], measures)
    metrics = {"rate": (labels.BEARER_SETUP_RATE, percent(F.col("succ"), F.col("alls")), "succ")}
    return _published(groups, "Roma_Province", provinces, measures, metrics, time)


def location_update_rate(s6a: DataFrame, hosts: DataFrame, time: str) -> DataFrame:
    """Location update success per host code, the 13th and 14th character of an
    ``mme`` host name. ``hosts``: origin, PROVNAME."""
    tried = s6a.where(F.col("Origin_Host").startswith("mme")).where(equals_number("Procedure_Type", 1))
    coded = tried.withColumn("origin", F.substring("Origin_Host", 13, 2))
    measures = [Measure("alls"), Measure("succ", equals_number("Procedure_Status", 0))]
    groups = count_by(coded, ["origin"], measures)
    metrics = {"rate": (labels.LOCATION_UPDATE_RATE, percent(F.col("succ"), F.col("alls")), "succ")}
    return _published(groups, "origin", hosts, measures, metrics, time)


def coap_province_rates(coap: DataFrame, provinces: DataFrame, time: str) -> DataFrame:
    """CoAP up rate, down rate and mean down delay per province and national,
    all from one pass over the feed."""
    measures = coap_measures()
    facts = coap_facts(coap, "Roma_Province").where(F.col("kind") == CON)
    groups = count_by(facts, ["Roma_Province"], measures)
    metrics = {
        "up": (labels.COAP_UP_RATE, percent(F.col("up_ok"), F.col("up_all")), "up_ok"),
        "down": (labels.COAP_DOWN_RATE, percent(F.col("down_ok"), F.col("down_all")), "down_ok"),
        "delay": (labels.COAP_DOWN_DELAY, quotient(F.col("delay_sum"), F.col("down_all")), "down_all"),
    }
    return _published(groups, "Roma_Province", provinces, measures, metrics, time)


def create_session_counts(
    s5s8: DataFrame, gateways: DataFrame, time: str, prefold: bool | None = None, marker: str = NB_MARKER
) -> DataFrame:
    """Successful NB session creations per province of the gateway; gateways
    without a province count as unknown. ``gateways``: SGSNIPAddress, PROVNAME.
    ``marker`` is part of the access points looked at."""
    created = s5s8.where(
        F.col("APN").contains(marker) & (F.col("Procedure_Status") == "0") & (F.col("Procedure_Type") == "3")
    )
    lookup = Lookup(gateways, "SGW_IP_Add", "SGSNIPAddress", ("PROVNAME",), "left")
    counts = count_enriched(created, [lookup], ["PROVNAME"], [Measure("USERNUM")], prefold=prefold)
    return counts.select(
        F.lit(labels.CREATE_SESSION_COUNT).alias("DATATYPE"),
        F.lit(time).alias("STA_TIME"),
        F.coalesce("PROVNAME", F.lit(labels.UNKNOWN)).alias("PRODTYPE"),
        "USERNUM",
    )
