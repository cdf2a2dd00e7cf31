"""Jobs from the command line: ``spark-submit probelake/run.py <job> ...``.

Feed tables are partitioned by ``slice`` as the slice job lands them; results
go to a table partitioned by ``slice`` as well, so a rerun replaces its own.
``--progress`` names the ledger that records the finished cycle.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable, Sequence

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from probelake.functions import times  # noqa: E402
from probelake.functions.radius import HA, PGW, parse_messages  # noqa: E402
from probelake.operators import day_filters, frontier  # noqa: E402
from probelake.operators.lists import joined_lists  # noqa: E402
from probelake.plans import audit, devices, quality, rates, sessions  # noqa: E402
from probelake.plans.slice_job import SliceJob, keyed_publisher  # noqa: E402
from probelake.session import build_session, staged  # noqa: E402
from probelake.sinks import files, ledger  # noqa: E402
from probelake.sources import listing, lookups, slices  # noqa: E402
from probelake.sources.feeds import FEEDS  # noqa: E402
from probelake.sources.kafka import read_kafka, read_text_stream  # noqa: E402
from probelake.streaming.landing import compact_landed, read_landed, start_landing  # noqa: E402
from probelake.streaming.progress import OffsetLedger  # noqa: E402
from probelake.streaming.statistics import start_statistics  # noqa: E402

Args = argparse.Namespace
JOBS: dict[str, tuple[Callable[[SparkSession, Args], None], tuple[str, ...], tuple[str, ...]]] = {}


def job(name: str, needs: str, may: str = ""):
    def register(fn):
        JOBS[name] = (fn, tuple(needs.split()), tuple(may.split()))
        return fn

    return register


def feed_table(spark: SparkSession, feed: str, root: str, prefixes: Sequence[str]) -> DataFrame:
    """Slices of a landed feed; empty when none is there yet."""
    layout = FEEDS[feed]
    fields = [T.StructField(c, T.IntegerType() if c in layout.ints else T.StringType()) for c in layout.output_columns]
    return slices.read_slices(spark, root, T.StructType(fields), list(prefixes))


def day_and_after(args: Args) -> list[str]:
    """The slices of a day and of the first hour after it, where late records land."""
    return [args.day, f"{args.next_day}00"]


def finish(spark: SparkSession, args: Args, result: DataFrame, cycle: str) -> None:
    files.replace_slice(result.hint("rebalance"), args.out, cycle)
    if args.progress:
        ledger.send_cycle(spark, args.progress, args.out.rstrip("/").rsplit("/", 1)[-1], cycle)


def dimension(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    return lookups.read_dimension(spark, path, columns, fmt="orc" if path.rstrip("/").endswith("orc") else "parquet")


@job("slice", "feed lines slice out", "profile keyed rejects done max_bytes")
def run_slice(spark: SparkSession, args: Args) -> None:
    publish = keyed_publisher(args.keyed) if args.keyed else None
    limit = int(args.max_bytes) if args.max_bytes else None
    SliceJob(
        FEEDS[args.feed], args.lines, args.out, args.profile or "full", publish, args.rejects, args.done, limit
    ).run(spark, args.slice)


@job("con-non-daily", "coap sites crm day out", "progress")
def run_con_non(spark: SparkSession, args: Args) -> None:
    coap = feed_table(spark, "coap", args.coap, [args.day])
    sites = dimension(spark, args.sites, "enbid", "provName", "cityName")
    finish(spark, args, rates.con_non_daily(coap, sites, dimension(spark, args.crm, "mdn", "custid"), args.day), args.day)


@job("customer-rates", "coap crm customers day out", "progress")
def run_customer_rates(spark: SparkSession, args: Args) -> None:
    coap = feed_table(spark, "coap", args.coap, [args.day])
    crm = dimension(spark, args.crm, "mdn", "custid as cust_id")
    finish(spark, args, rates.customer_rates(coap, crm, args.customers.split(","), args.day), args.day)


@job("province-kpis", "s5s8 s6a coap provinces hosts slice out", "progress")
def run_province_kpis(spark: SparkSession, args: Args) -> None:
    """All KPIs of one 10-minute bucket. A feed without slices gives no rows."""
    bucket = args.slice[:11]
    row = spark.range(1).select(times.slice_display(F.lit(args.slice)).alias("t")).first()
    provinces = lookups.read_codes(spark, args.provinces, ("Roma_Province", "PROVNAME"))
    hosts = lookups.read_codes(spark, args.hosts, ("PROVNAME", "origin"))
    groups = {
        "s5s8": lambda: rates.bearer_setup_rate(feed_table(spark, "s5s8", args.s5s8, [bucket]), provinces, row["t"]),
        "s6a": lambda: rates.location_update_rate(feed_table(spark, "s6a", args.s6a, [bucket]), hosts, row["t"]),
        "coap": lambda: rates.coap_province_rates(feed_table(spark, "coap", args.coap, [bucket]), provinces, row["t"]),
    }
    # A feed that fails must not take the others' KPIs with it; the job still fails in the end.
    done, failed = [], {}
    for name, group in groups.items():
        try:
            done.append(staged(group(), f"province-kpis-{name}"))
        except Exception as error:  # noqa: BLE001
            failed[name] = error
    if done:
        result = done[0]
        for more in done[1:]:
            result = result.unionByName(more)
        finish(spark, args, result, args.slice)
    if failed:
        raise RuntimeError(f"no KPIs from {', '.join(failed)}") from next(iter(failed.values()))


@job("create-sessions", "s5s8 gateways day out", "progress")
def run_create_sessions(spark: SparkSession, args: Args) -> None:
    gateways = lookups.read_codes(spark, args.gateways, ("SGSNIPAddress", "PROVNAME"))
    finish(spark, args, rates.create_session_counts(feed_table(spark, "s5s8", args.s5s8, [args.day]), gateways, args.day), args.day)


@job("offline-stats", "network crm sites slice out", "radius json progress")
def run_offline(spark: SparkSession, args: Args) -> None:
    """From the landed table (``radius``) or from JSON-lines files (``json``, a glob)."""
    layout = HA if args.network == "3g" else PGW
    if args.json:
        schema = T.StructType([T.StructField(k, T.StringType()) for k in layout.keys])
        radius = slices.read_json_lines(spark, args.json, schema)
    else:
        radius = read_landed(spark, args.radius, layout, [(args.slice[:8], args.slice[8:10], args.slice[10:12])])
    crm = dimension(spark, args.crm, "mdn", "custid as cust_id")
    sites = (
        lookups.read_sites_3g(spark, args.sites)
        if args.network == "3g"
        else dimension(spark, args.sites, "enbid", "provName", "cityName")
    )
    finish(spark, args, sessions.offline_stats(radius, crm, sites, args.network, args.slice), f"{args.slice}00")


@job("reconcile", "coap s1u mqtt s5s8 sets apn bearer_apn inbox checklist prefixes day next_day out", "progress done")
def run_reconcile(spark: SparkSession, args: Args) -> None:
    """``sets`` and ``prefixes`` are ``name=prefix`` pairs separated by commas.

    With ``done``, the ledger of landed slices, the audit waits until all feeds have the day and the hour after it.
    """
    if args.done:
        ready, lagging = frontier.is_open(ledger.read_done(spark, args.done), ["coap", "s1u", "mqtt", "s5s8"], args.day)
        if not ready:
            raise RuntimeError(f"{args.day} is not complete yet: {lagging}")
    sets = dict(p.split("=") for p in args.sets.split(","))
    prefixes = dict(p.split("=") for p in args.prefixes.split(","))
    feeds = [feed_table(spark, f, getattr(args, f), day_and_after(args)) for f in ("coap", "s1u", "mqtt")]
    traffic = audit.recon_traffic(feeds, sets, args.apn, args.day, args.next_day)
    bearers = audit.recon_bearers(
        feed_table(spark, "s5s8", args.s5s8, day_and_after(args)), sets, args.bearer_apn,
        times.day_start_millis(F.lit(args.day)), times.day_start_millis(F.lit(args.next_day)),
        ("16", "17", "18", "19"), args.day,  # fixed values: result codes of a completed bearer setup
    )
    checklist = lookups.read_codes(spark, args.checklist, ("filename", "filedir"))
    expected = audit.expected_files(checklist, {f"DPI_{k}": v for k, v in prefixes.items()}, args.day)
    received = audit.received_files(listing.list_files(spark, args.inbox), {k: f"/{v}" for k, v in prefixes.items()}, args.day)
    finish(spark, args, audit.reconciliation(traffic, bearers, expected, received), args.day)


@job("new-gateways", "s5s8 known day out", "progress filters")
def run_new_gateways(spark: SparkSession, args: Args) -> None:
    """``known`` is a table of addresses partitioned by the day of discovery; with ``filters`` only the days of it that
    the addresses' filters name are read."""
    seen = feed_table(spark, "s5s8", args.s5s8, [args.day])
    if args.filters:
        found = day_filters.find_new(spark, seen, "SGW_IP_Add", args.known, args.filters, args.day)
        finish(spark, args, found.select(F.lit(args.day).alias("sta_time"), F.col("SGW_IP_Add").alias("sgw_add_ip")), args.day)
        return
    schema = T.StructType([T.StructField("SGW_IP_Add", T.StringType())])
    known = slices.read_table(spark, args.known, schema).where(F.col("slice") < args.day)
    fresh = devices.new_gateways(seen, known, args.day)
    finish(spark, args, fresh, args.day)
    found = slices.read_table(spark, args.out, fresh.schema).where(F.col("slice") == args.day)
    files.replace_slice(found.select(F.col("sgw_add_ip").alias("SGW_IP_Add")), args.known, args.day)


@job("subscriber-counters", "coap ids gateways server day out", "progress")
def run_subscriber_counters(spark: SparkSession, args: Args) -> None:
    gateways = lookups.read_codes(spark, args.gateways, ("SGSNIPAddress", "PROVNAME"))
    coap = feed_table(spark, "coap", args.coap, [args.day])
    finish(spark, args, devices.subscriber_counters(coap, lookups.read_ids(spark, args.ids), gateways, args.server, args.day), args.day)


@job("outside-addresses", "coap ids allowed day next_day out", "progress")
def run_outside(spark: SparkSession, args: Args) -> None:
    """From ``day`` up to, not including, ``next_day``."""
    table = feed_table(spark, "coap", args.coap, [""])
    days = table.where((F.col("slice") >= args.day) & (F.col("slice") < args.next_day))
    ids = lookups.read_ids(spark, args.ids, "mdn", first_field=False)
    contacts = devices.outside_addresses(days, ids, args.allowed)
    finish(spark, args, joined_lists(contacts, "mdn", "DestinationIP", "DestinationIP_value"), args.day)


@job("quality-sheet", "s5s8 coap crm customers day out", "progress")
def run_quality(spark: SparkSession, args: Args) -> None:
    ids = dimension(spark, args.crm, "mdn", "custid").where(F.col("custid") == args.customers).select("mdn")
    sheet = quality.quality_sheet(
        feed_table(spark, "s5s8", args.s5s8, [args.day]), feed_table(spark, "coap", args.coap, [args.day]), ids,
        args.customers, args.day,
    )
    finish(spark, args, sheet, args.day)


@job("http-status", "lines slice out", "progress")
def run_http_status(spark: SparkSession, args: Args) -> None:
    finish(spark, args, audit.http_status_extract(slices.read_lines(spark, args.lines, args.slice)), args.slice)


@job("probe-audit", "lines slice numbers out", "csv progress")
def run_probe_audit(spark: SparkSession, args: Args) -> None:
    lines = slices.read_lines(spark, args.lines, f"{args.slice}*")
    result = audit.probe_audit(lines, args.numbers.split(","))
    finish(spark, args, result, args.slice)
    if args.csv:
        landed = slices.read_table(spark, args.out, result.schema).where(F.col("slice") == args.slice)
        files.write_csv(landed.drop("slice"), args.csv, header=True, sep="|")


@job("land-radius", "network out checkpoint", "lines brokers topic seconds offsets")
def run_land_radius(spark: SparkSession, args: Args) -> None:
    stream = read_kafka(spark, args.brokers, args.topic) if args.brokers else read_text_stream(spark, args.lines)
    if args.offsets:
        spark.streams.addListener(OffsetLedger(spark, args.offsets, args.network))
    layout = HA if args.network == "3g" else PGW
    seconds = int(args.seconds) if args.seconds else None
    start_landing(stream, layout, args.out, args.checkpoint, seconds).awaitTermination()


@job("session-stats", "lines network out checkpoint", "seconds")
def run_session_stats(spark: SparkSession, args: Args) -> None:
    """Exact five-minute session statistics of a message stream, late records included."""
    layout = HA if args.network == "3g" else PGW
    parsed = parse_messages(read_text_stream(spark, args.lines), layout)
    events = parsed.select("mdn", "terminatecause", "d", "h", "m5")
    seconds = int(args.seconds) if args.seconds else None
    start_statistics(events, args.out, args.checkpoint, ["terminatecause"], "mdn", seconds).awaitTermination()


@job("compact", "network radius slice", "size_mb")
def run_compact(spark: SparkSession, args: Args) -> None:
    """Merges the small files of a landed table that lie within a day, an hour or five minutes (``slice``)."""
    layout = HA if args.network == "3g" else PGW
    gone, come = compact_landed(spark, args.radius, layout, args.slice, int(args.size_mb or 128))
    print(f"{gone} files became {come}")


def parse(argv: Sequence[str]) -> Args:
    parser = argparse.ArgumentParser(prog="probelake")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (fn, needs, may) in JOBS.items():
        command = commands.add_parser(name, help=fn.__doc__)
        for option in needs:
            command.add_argument(f"--{option.replace('_', '-')}", required=True)
        for option in may:
            command.add_argument(f"--{option.replace('_', '-')}")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(sys.argv[1:] if argv is None else argv)
    JOBS[args.job][0](spark or build_session(f"probelake {args.job}"), args)


if __name__ == "__main__":
    main()
