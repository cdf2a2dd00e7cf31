"""Every column of feeds that no other query reads, and the smaller sinks and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.frontier import frontiers, open_days
from ..plans import audit
from ..plans.slice_job import SliceJob
from ..session import staged, work_dir
from ..sinks.files import replace_partitions, write_csv
from ..sinks.jdbc import sink_defaults
from ..sinks.ledger import read_progress
from ..sources.feeds import FEEDS, publication
from ..sources.lookups import lookup_from_lines
from ..sources.slices import read_slices
from . import sql as S
from . import tables as T
from .kpis import recon_bearer, recon_expected_files, recon_gateway
from .landing import received
from .layouts import LAYOUTS, Layout
from .registry import ORACLES, query

#: Groups that lines of a feed with a folded tail end with.
TAIL_GROUPS = 2


def _n_fields(layout: Layout) -> int:
    """The folded tail begins with the count itself."""
    return layout.names.index(layout.bearers) + TAIL_GROUPS * layout.group if layout.folded else len(layout.names)


def _value(layout: Layout, i: int, key: str) -> str:
    """The content of field ``i`` in words that Spark and the SQL side share."""
    name = layout.names[i] if i < len(layout.names) else ""
    if name.upper() == "MSISDN":
        return f"case when o_orderkey % 7 = 0 then '' else {key} end"
    if name.upper() == "APN":
        return "case when o_orderkey % 3 = 0 then 'net' else 'a.ctnb.x' end"
    if name and name == layout.bearers:
        return "cast(o_orderkey % 10 as {text})"
    return f"concat('f{i}x', {key})"


def _lines(spark: SparkSession, sf: str, layout: Layout) -> DataFrame:
    """A line per order; some are too short, some end where the optional fields begin."""
    fields = [_value(layout, i, "cast(o_orderkey as string)").format(text="string") for i in range(_n_fields(layout))]
    least = f"concat_ws('|', {', '.join(fields[: layout.required])})"
    short = f"concat_ws('|', {', '.join(fields[: layout.required - 1])})"
    whole = f"concat_ws('|', {', '.join(fields)})"
    ends = f"when o_orderkey % 5 = 0 then {least}" if not layout.folded else ""
    return T.table(spark, sf, "orders").selectExpr(f"case when o_orderkey % 11 = 0 then {short} {ends} else {whole} end as value")


def _sql(layout: Layout) -> str:
    """What the published columns hold, from the layout alone."""
    key = "cast(o_orderkey as varchar)"
    values = [_value(layout, i, key).format(text="varchar") for i in range(_n_fields(layout))]
    of: dict[str, str] = {}
    for i, name in enumerate(layout.names):
        of[name] = values[i]
        if name == layout.bearers:
            of[name] = "cast(o_orderkey % 10 as integer)"
        elif i >= layout.required and not layout.folded:
            of[name] = f"case when o_orderkey % 5 = 0 then '-1' else {values[i]} end"
    if layout.reversed_number:
        of["mdnReverse"] = f"reverse({of['msisdn']})"
    if layout.folded:
        start = layout.names.index(layout.bearers)
        groups = [values[start + g * layout.group :][: layout.group] for g in range(TAIL_GROUPS)]
        of[layout.folded] = f"concat_ws('-', {', '.join(f"concat_ws(',', {', '.join(group)})" for group in groups)})"
    kept = ["o_orderkey % 11 <> 0"]
    kept += ["o_orderkey % 7 <> 0"] if layout.number else []
    kept += ["o_orderkey % 3 <> 0"] if layout.access_point else []
    columns = ", ".join(f'{value} as "{name}"' for name, value in of.items() if name not in layout.unpublished.split())
    return f"select {columns} from orders where {' and '.join(kept)}"


def _register(name: str) -> None:
    layout = LAYOUTS[name]

    def rows(spark: SparkSession, sf: str) -> DataFrame:
        landed = SliceJob(FEEDS[name], "", "").clean(_lines(spark, sf, layout))
        return publication(landed, FEEDS[name], "full")

    rows.__doc__ = f"Every published column of the {name} feed."
    query(f"feed_{name}", _sql(layout))(rows)


for _name in LAYOUTS:
    _register(_name)


_RECONCILED = ("recon_gateway", "recon_bearer", "recon_expected_files", "received_files")


@query(
    "reconciliation",
    " union all by name ".join(
        f'select "STA_TIME", "CHECKTYPE", "PGW", "USERNUM", "UPFLOW"::double as "UPFLOW", '
        f'"DOWNFLOW"::double as "DOWNFLOW", "TOTALFLOW"::double as "TOTALFLOW" from ({ORACLES[name]})'
        for name in _RECONCILED
    ),
)
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic, bearers, expected and received files of a day in one table."""
    table = audit.reconciliation(
        recon_gateway(spark, sf), recon_bearer(spark, sf), recon_expected_files(spark, sf), received(spark, sf)
    )
    return table.withColumns({c: F.col(c).cast("double") for c in ("UPFLOW", "DOWNFLOW", "TOTALFLOW")})


#: The audited "day" is a year here, so that all scales have records of it.
AUDITED, AFTER = "1996", "1997"
_TAGS = {"S5S8": "S5s8", "S1U": "S1u", "MQTT": "S1umqtt", "COAP": "S1ucoap"}


def _audited_feeds(spark: SparkSession, sf: str) -> list[DataFrame]:
    """CoAP, S1U and MQTT records in monthly slices of their own; some land in the first hour of the next year, some later."""
    rows = T.coap(spark, sf)
    number = F.col("MSISDN").cast("long")
    month, december = F.substring("StartTime", 1, 6), F.col("StartTime").substr(5, 2) == "12"
    next_year = (F.substring("StartTime", 1, 4).cast("int") + 1).cast("string")
    at = F.when(december & (number % 11 == 0), F.concat(next_year, F.lit("010103")))
    at = at.when(december & (number % 5 == 0), F.concat(next_year, F.lit("010100")))
    at = at.when(F.endswith(month, F.lit("01")) & (number % 7 == 0), F.concat(month, F.lit("0100"))).otherwise(F.concat(month, F.lit("0112")))
    feeds = []
    for i, name in enumerate(("coap", "s1u", "mqtt")):
        root = work_dir(spark, f"audited-{name}")
        own = rows.where(number % 3 == i).withColumn("slice", at)
        replace_partitions(own, root, ["slice"])
        feeds.append(read_slices(spark, root, rows.schema, [AUDITED, f"{AFTER}010100"]))
    return feeds


@query(
    "audit_day",
    S.with_views(S.COAP, S.S5S8)
    + """
    , seen as (
      select * from coap
      where not (substr(StartTime, 1, 6) = '199612' and cast(MSISDN as bigint) % 11 = 0)
        and APN like 'meter.apn.ctnb%' and StartTime > '1996' and StartTime < '1997' and (out_octets > 0 or in_octets > 0)),
    traffic as (
      select 'COAP' as kind, n.PGW, count(distinct MSISDN) as users, coalesce(sum(out_octets), 0)::double as up,
        coalesce(sum(in_octets), 0)::double as down, coalesce(sum(out_octets) + sum(in_octets), 0)::double as total
      from (values ('PGW1', '10.14.'), ('PGW2', '10.15.')) n(PGW, prefix) left join seen on starts_with(SGWIP, n.prefix) group by n.PGW),
    bearers as (
      select 'S5C' as kind, n.PGW, count(distinct MSISDN) as users, count(MSISDN)::double as up, -1::double as down, -1::double as total
      from (values ('PGW1', '10.14.'), ('PGW2', '10.15.')) n(PGW, prefix)
        left join (
          select * from s5s8 where APN like 'ctnb%' and Procedure_Type = '3' and Procedure_Status = '0'
            and Result_Code in ('16', '17', '18', '19') and o_orderdate > timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01') b
        on starts_with(SGW_IP_Add, n.prefix)
      group by n.PGW),
    files as (
      select o_orderkey, ['S5S8', 'S1U', 'MQTT', 'COAP'][o_orderkey % 4 + 1] as feed,
        'r' || (o_orderkey % 10) || '-' || strftime(o_orderdate, '%Y%m%d') as name, o_orderpriority <> '5-LOW' as listed from orders),
    received as (
      select t.feed || '_NUM_DAY' as kind, count(name) as users
      from (values ('S5S8'), ('S1U'), ('MQTT'), ('COAP')) t(feed) left join files f on f.feed = t.feed and contains(name, '1996') group by t.feed),
    expected as (
      select 'DPI_' || t.feed || '_NUM_DAY' as kind, count(name) as users
      from (values ('S5S8'), ('S1U'), ('MQTT'), ('COAP')) t(feed) left join files f on f.feed = t.feed and listed group by t.feed)
    select '1996' as "STA_TIME", kind as "CHECKTYPE", PGW as "PGW", users as "USERNUM", up as "UPFLOW", down as "DOWNFLOW", total as "TOTALFLOW"
    from (
      select * from traffic union all select * from bearers
      union all select kind, 'ALL', users, -1, -1, -1 from received union all select kind, 'ALL', users, -1, -1, -1 from expected)""",
)
def audit_day(spark: SparkSession, sf: str) -> DataFrame:
    """All twelve rows of a day's audit: three feeds with late records, bearers, four feeds in both inventories."""
    sets = {"PGW1": "10.14.", "PGW2": "10.15."}
    traffic = audit.recon_traffic(_audited_feeds(spark, sf), sets, "meter.apn.ctnb", AUDITED, AFTER)
    start, end = (F.unix_millis(F.to_timestamp(F.lit(f"{year}-01-01"))) for year in (AUDITED, AFTER))
    bearers = audit.recon_bearers(T.s5s8(spark, sf), sets, "ctnb", start, end, ("16", "17", "18", "19"), AUDITED)
    folder = F.element_at(F.array(*[F.lit(f) for f in _TAGS.values()]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    name = F.concat(F.lit("r"), (F.col("o_orderkey") % 10).cast("string"), F.lit("-"), F.date_format("o_orderdate", "yyyyMMdd"))
    files = T.table(spark, sf, "orders").select("o_orderpriority", folder.alias("folder"), name.alias("name"))
    listing = files.select(F.concat(F.lit("/in/"), "folder", F.lit("/x_done/"), "name").alias("path"))
    received_rows = audit.received_files(listing, {f"{tag}_NUM_DAY": f"/{f}/" for tag, f in _TAGS.items()}, AUDITED)
    directory = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(",/in")
    checklist = lookup_from_lines(files.select(F.concat("folder", F.lit("-"), "name", directory).alias("value")), ("filename", "filedir"))
    expected_rows = audit.expected_files(checklist, {f"DPI_{tag}_NUM_DAY": f"{f}-" for tag, f in _TAGS.items()}, AUDITED)
    table = audit.reconciliation(traffic, bearers, received_rows, expected_rows)
    return table.withColumns({c: F.col(c).cast("double") for c in ("UPFLOW", "DOWNFLOW", "TOTALFLOW")})


@query(
    "audit_frontier",
    """
    with slices as (
      select distinct event_type as feed, date_diff('day', timestamp '2024-01-01', ts) * 4 + hour(ts) // 6 as n from events
      where (event_type <> 'error' or ts < timestamp '2024-01-20') and (event_type <> 'click' or cast(ts as date) <> date '2024-01-10')),
    feeds as (select unnest(['click', 'error', 'purchase', 'signup', 'view']) as feed),
    gaps as (select feed, min(n) as n from feeds, range(0, 200) r(n) where not exists (from slices s where s.feed = feeds.feed and s.n = r.n) group by feed),
    frontiers as (
      select g.feed, g.n, coalesce(max(s.n) + 1, 0) as newest, coalesce(count(s.n), 0) as held
      from gaps g left join slices s using (feed) group by g.feed, g.n),
    days as (select n as d from range(0, 30) r(n)),
    late as (select d, string_agg(feed, ',' order by feed) filter (n * 6 < d * 24 + 25) as lagging from days, frontiers group by d)
    select 'feed' as what, feed as name, strftime(timestamp '2024-01-01' + to_hours(cast(n * 6 as bigint)), '%Y%m%d%H%M') as complete_until,
      strftime(timestamp '2024-01-01' + to_hours(cast(newest * 6 as bigint)), '%Y%m%d%H%M') as newest_until,
      cast((newest - held) * 360 as bigint) as missing_minutes, false as is_open, '' as lagging
    from frontiers
    union all
    select 'day', strftime(timestamp '2024-01-01' + to_days(cast(d as integer)), '%Y%m%d'), '', '', cast(0 as bigint), lagging is null, coalesce(lagging, '') from late""",
)
def audit_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """How far each feed has landed, one of them with a hole and one lagging behind, and which days may be audited."""
    feeds = ["click", "error", "purchase", "signup", "view"]
    ts = F.col("ts").cast("timestamp")
    slot = F.lpad((F.floor(F.hour(ts) / 6) * 6).cast("string"), 2, "0")
    done = T.table(spark, sf, "events").where("event_type <> 'error' or ts < timestamp '2024-01-20'").where(
        "event_type <> 'click' or cast(ts as date) <> date '2024-01-10'"
    ).select(F.col("event_type").alias("feed"), F.concat(F.date_format(ts, "yyyyMMdd"), slot, F.lit("00")).alias("slice"))
    front = staged(frontiers(done, feeds, "20240101", step=360), "frontiers")
    days = spark.range(30).select(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")), "yyyyMMdd").alias("day"))
    nothing = F.lit("")
    by_feed = front.select(
        F.lit("feed").alias("what"), F.col("feed").alias("name"), "complete_until", "newest_until", "missing_minutes",
        F.lit(False).alias("is_open"), nothing.alias("lagging"),
    )
    return by_feed.unionByName(
        open_days(front, feeds, days).select(
            F.lit("day").alias("what"), F.col("day").alias("name"), nothing.alias("complete_until"), nothing.alias("newest_until"),
            F.lit(0).cast("long").alias("missing_minutes"), "is_open", "lagging",
        )
    )


@query(
    "csv_no_header",
    "select c_custkey as id, c_mktsegment as segment from customer",
)
def csv_no_header(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "csv-plain")
    rows = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    write_csv(rows, path)
    return spark.read.schema(rows.schema).csv(path)


@query(
    "progress_of_a_table",
    """
    with c as (select distinct strftime(ts, '%Y%m%d%H') as cycle from events where event_type = 'click'),
    r as (select cycle, row_number() over (order by cycle desc) as rn from c)
    select 'click' as tab_name, max(cycle) as curr_cycle, coalesce(max(cycle) filter (where rn = 2), '') as last_cycle
    from r having count(*) > 0""",
)
def progress_of_a_table(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles of all tables are in one ledger; the breakpoint of one of them is read."""
    root = work_dir(spark, "cycles")
    cycles = T.table(spark, sf, "events").select(
        F.col("event_type").alias("tab_name"), F.date_format("ts", "yyyyMMddHH").alias("cycle")
    )
    cycles.distinct().write.mode("append").parquet(root)
    return read_progress(spark, root, "click")


@query(
    "sink_defaults",
    """
    select o_orderkey, coalesce(case when o_orderstatus <> 'F' then o_orderstatus end, '-1') as status,
      coalesce(case when o_orderkey % 3 > 0 then o_custkey end, -1) as cust,
      coalesce(case when o_orderkey % 2 = 0 then cast(o_orderkey as double) / 4 end, -1) as price from orders""",
)
def defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "case when o_orderstatus <> 'F' then o_orderstatus end as status",
        "case when o_orderkey % 3 > 0 then o_custkey end as cust",
        "case when o_orderkey % 2 = 0 then cast(o_orderkey as double) / 4 end as price",
    )
    return sink_defaults(rows)
