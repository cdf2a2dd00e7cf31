"""Line and message parsing over lines made from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..functions.radius import HA, PGW, RadiusLayout, bad_rows, parse_messages
from ..functions.scalars import fill_blank, lenient_int, spread_key
from ..plans.audit import http_status_extract, probe_audit
from ..plans.slice_job import SliceJob
from ..sources.feeds import FEEDS, parse_lines, publication, rejected_lines
from . import sql as S
from . import tables as T
from .registry import query


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _line(fields: list[Column | str]) -> Column:
    return F.concat_ws("|", *[F.lit(f) if isinstance(f, str) else f for f in fields])


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "orders").withColumn("p", F.substring("o_orderpriority", 1, 1))


# -- Positional lines ------------------------------------------------------

def gx_lines(spark: SparkSession, sf: str) -> DataFrame:
    """GX lines with empty fields at the end; priority 4 lacks a field,
    priority 5 has no number."""
    number = F.when(F.col("p") == "5", "").otherwise(_text("o_custkey"))
    head = ["11", _text("o_orderkey"), "", "", number, "6", "", _text("p")]
    body = [_text("o_orderstatus"), F.date_format("o_orderdate", "yyyyMMddHHmmss"), "", "0", "2001", "", "", "1"]
    full = [*head, *body, F.when(F.col("p") == "1", "10.0.0.1").otherwise(""), ""]
    short = [*head, *body, ""]
    return _orders(spark, sf).select(F.when(F.col("p") == "4", _line(short)).otherwise(_line(full)).alias("value"))


@query(
    "parse_keep_trailing",
    """
    select cast(o_orderkey as varchar) as XDR_ID, cast(o_custkey as varchar) as MSISDN,
      substr(o_orderpriority, 1, 1) as Roma_Province, o_orderstatus as Procedure_Type,
      strftime(o_orderdate, '%Y%m%d') || '000000' as Procedure_Start_Time,
      case when o_orderpriority like '1%' then '10.0.0.1' else '' end as PCEF_IP_Add, '' as PCRF_IP_Add
    from orders where substr(o_orderpriority, 1, 1) not in ('4', '5')""",
)
def parse_keep_trailing(spark: SparkSession, sf: str) -> DataFrame:
    rows = SliceJob(FEEDS["gx"], "", "").clean(gx_lines(spark, sf))
    return rows.select(
        "XDR_ID", "MSISDN", "Roma_Province", "Procedure_Type", "Procedure_Start_Time", "PCEF_IP_Add", "PCRF_IP_Add"
    )


@query(
    "parse_rejects",
    """
    select 'gx' as feed, cast(17 as integer) as n_fields, count(*) as n_lines
    from orders where o_orderpriority like '4%' having count(*) > 0""",
)
def parse_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejects = rejected_lines(gx_lines(spark, sf), FEEDS["gx"])
    return rejects.groupBy("feed", "n_fields").agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    "parse_drop_trailing",
    """
    select cast(o_orderkey as varchar) as imsi, 't' as behaviortarget,
      case when p = '2' then '-1' else 's40' end as syntime,
      case p when '2' then '-1' when '4' then '' else 's41' end as synacktime,
      case p when '4' then 's42' when '5' then 's42' else '-1' end as acktime,
      case p when '5' then 's43' else '-1' end as actiontime,
      case p when '5' then 's48' else '-1' end as pagevolume
    from (select *, substr(o_orderpriority, 1, 1) as p from orders) where p <> '1'""",
)
def parse_drop_trailing(spark: SparkSession, sf: str) -> DataFrame:
    required = [_text("o_orderkey"), *[f"f{i}" for i in range(1, 39)]]
    tails = {
        "1": ["", ""],  # field 39 empty: it vanishes, and with it the line
        "2": ["t"],
        "3": ["t", "s40", "s41", ""],
        "4": ["t", "s40", "", "s42", ""],
        "5": ["t", *[f"s{i}" for i in range(40, 49)]],
    }
    value = F.coalesce(*[F.when(F.col("p") == p, _line([*required, *tail])) for p, tail in tails.items()])
    rows = parse_lines(_orders(spark, sf).select(value.alias("value")), FEEDS["http_early"])
    return rows.select("imsi", "behaviortarget", "syntime", "synacktime", "acktime", "actiontime", "pagevolume")


@query(
    "parse_fill_default",
    """
    select o_orderkey, case when o_orderstatus = 'F' then '-1' else o_orderstatus end as status,
      cast(case substr(o_orderpriority, 1, 1) when '1' then 1 when '2' then 0 when '3' then -3 else 0 end
        as integer) as n,
      reverse(cast(o_custkey as varchar)) || '_' || strftime(o_orderdate, '%Y%m%d') as spread
    from orders""",
)
def parse_fill_default(spark: SparkSession, sf: str) -> DataFrame:
    texts = {"1": "1", "2": "2.5", "3": "-3", "4": " 4", "5": ""}
    text = F.coalesce(*[F.when(F.col("p") == p, F.lit(t)) for p, t in texts.items()])
    return _orders(spark, sf).select(
        "o_orderkey",
        fill_blank(F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))).alias("status"),
        lenient_int(text).alias("n"),
        spread_key(_text("o_custkey"), F.date_format("o_orderdate", "yyyyMMdd")).alias("spread"),
    )


_WORDS = r"string_split(replace(replace(replace(text, '|', ' '), chr(10), ' '), ' ', '|'), '|')"


def _document_words() -> Column:
    """The document as fields: every space and line break separates two."""
    flat = F.replace(F.replace(F.col("text"), F.lit("|"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return F.replace(flat, F.lit(" "), F.lit("|"))


@query(
    "bearer_groups",
    f"""
    with w as (select doc_id, n_chars, list_concat([cast(n_chars as varchar)], {_WORDS}) as f from documents)
    select cast(doc_id as varchar) as "XDR_ID", cast(n_chars as integer) as "EPS_Bearer_Number",
      md5(array_to_string(list_transform(range(0, (len(f) + 7) // 8),
        lambda i: array_to_string(f[i * 8 + 1 : i * 8 + 8], ',')), '-')) as context_md5
    from w""",
)
def bearer_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as variable tails, folded into groups of eight."""
    head = ["11", _text("doc_id"), "", "", "n", *[""] * 24]
    lines = T.table(spark, sf, "documents").select(
        F.concat(_line([*head, _text("n_chars")]), F.lit("|"), _document_words()).alias("value")
    )
    rows = parse_lines(lines, FEEDS["s5s8"])
    return rows.select("XDR_ID", "EPS_Bearer_Number", F.md5("Bearer_Context").alias("context_md5"))


@query(
    "length_prefixed_groups",
    f"""
    with w as (
      select doc_id, list_concat({_WORDS}, ['HOME', 'PROBE']) as x,
        case lang when 'en' then len({_WORDS}) // 6 when 'fr' then 1000000 when 'de' then 0 else 2 end as n
      from documents)
    , m as (select *, least(n, len(x) // 6) as g from w)
    select cast(doc_id as varchar) as xdr_id, cast(n as integer) as ulilength,
      md5(array_to_string(list_transform(range(0, g),
        lambda i: array_to_string(x[i * 6 + 1 : i * 6 + 6], '-')), ',')) as info_md5,
      x[6 * g + 1] as home_province, x[6 * g + 2] as probeid
    from m where len(x) - 6 * g >= 2""",
)
def length_prefixed_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of six announced by a count that may be short, zero, text or too large."""
    text = T.table(spark, sf, "documents").withColumn("words", _document_words())
    words = F.length("words") - F.length(F.replace("words", F.lit("|"), F.lit(""))) + 1
    n = (
        F.when(F.col("lang") == "en", F.floor(words / 6).cast("string"))
        .when(F.col("lang") == "fr", "1000000").when(F.col("lang") == "de", "zero").otherwise("2")
    )
    head = ["11", _text("doc_id"), *["-"] * 17, n, *["-"] * 22]
    lines = text.select(F.concat(_line(head), F.lit("|"), "words", F.lit("|HOME|PROBE")).alias("value"))
    rows = parse_lines(lines, FEEDS["s5s8_early"])
    return rows.select("xdr_id", "ulilength", F.md5("bearerinfo").alias("info_md5"), "home_province", "probeid")


# -- Publication -----------------------------------------------------------

_CUT = FEEDS["s1u"].profiles["cut"]


def _cut_sql() -> str:
    columns = []
    for item in _CUT:
        name, _, alias = item.partition(" as ")
        at = FEEDS["s1u"].columns.index(name)
        source = {"MSISDN": "cast(o_custkey as varchar)", "APN": "'x.ctnb.y'"}.get(name, f"'f{at}-' || o_orderkey")
        columns.append(f'{source} as "{alias or name}"')
    return f"select {', '.join(columns)} from orders where o_totalprice > 150000"


@query("publish_cut_profile", _cut_sql())
def publish_cut_profile(spark: SparkSession, sf: str) -> DataFrame:
    feed = FEEDS["s1u"]
    apn = F.when(F.col("o_totalprice") > 150000, "x.ctnb.y").otherwise("x.net.y")
    special = {"MSISDN": _text("o_custkey"), "APN": apn}
    fields = [
        special.get(c, F.concat(F.lit(f"f{i}-"), _text("o_orderkey"))) for i, c in enumerate(feed.columns)
    ]
    lines = T.table(spark, sf, "orders").select(_line(fields).alias("value"))
    return publication(SliceJob(feed, "", "").clean(lines), feed, "cut")


@query(
    "coap_two_layouts",
    """
    select cast(o_custkey as varchar) as "MSISDN", case when o_orderstatus = 'F' then 'up' end as "UP_TTL",
      o_orderstatus as "Status", cast(o_orderkey as varchar) as "MSGID" from orders""",
)
def coap_two_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """The older 82-field and the newer 84-field CoAP lines end up in one table."""
    orders = T.table(spark, sf, "orders")

    def lines(feed, rows: DataFrame) -> DataFrame:
        special = {
            "MSISDN": _text("o_custkey"), "Status": F.col("o_orderstatus"), "MSGID": _text("o_orderkey"), "UP_TTL": F.lit("up"),
        }
        return rows.select(_line([special.get(c, "") for c in feed.columns]).alias("value"))

    new, old = FEEDS["coap"], FEEDS["coap_82"]
    newer = parse_lines(lines(new, orders.where("o_orderstatus = 'F'")), new)
    older = parse_lines(lines(old, orders.where("o_orderstatus <> 'F'")), old)
    both = newer.unionByName(older, allowMissingColumns=True)
    return both.select("MSISDN", "UP_TTL", "Status", "MSGID")


# -- HTTP lines ------------------------------------------------------------

def http_lines(spark: SparkSession, sf: str) -> DataFrame:
    """100-field lines, one per event; signups have a field too many."""
    special = {
        1: _text("event_id"),
        2: F.concat(F.lit("86"), F.lpad(_text("user_id"), 11, "0")),
        4: F.col("event_type"),
        5: F.concat(F.lit("10.0.0."), _text("user_id")),
        20: F.date_format("ts", "yyyyMMddHHmmss"),
        66: F.lit("agent"),
        67: F.concat(F.lit("/p/"), F.regexp_extract("props", "([0-9]+)", 1)),
        69: F.lit("h.example"),
        75: F.when(F.col("event_type") == "error", "302").when(F.col("event_type") == "view", "").otherwise("200"),
    }
    line = _line([special.get(i, "") for i in range(100)])
    return T.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "signup", F.concat(line, F.lit("|"))).otherwise(line).alias("value")
    )


@query(
    "http_status_extract",
    """
    select '86' || lpad(cast(user_id as varchar), 11, '0') as "MSISDN", event_type as "APN",
      strftime(ts, '%Y%m%d%H%M%S') as "StartTime", '' as "EndTime", '10.0.0.' || user_id as "DestinationIP",
      'h.example' as "Host", 'agent' as "UserAgent", case event_type when 'error' then '302' else '' end as "HttpStatus"
    from events where event_type in ('error', 'view')""",
)
def http_status(spark: SparkSession, sf: str) -> DataFrame:
    return http_status_extract(http_lines(spark, sf))


@query(
    "probe_audit",
    """
    select distinct strftime(ts, '%Y%m%d%H%M%S') as "StartTime", '' as "EndTime",
      '86' || lpad(cast(user_id as varchar), 11, '0') as "MSISDN", cast(event_id as varchar) as "IMSI",
      event_type as "APN", '' as "PGWIP", 'h.example/p/' || regexp_extract(props, '([0-9]+)', 1) as "DestinationURL",
      '' as "UserIP", '' as "UserPort", '10.0.0.' || user_id as "SourceIP", '' as "SourcePort"
    from events where user_id in (7, 8)""",
)
def probe_numbers(spark: SparkSession, sf: str) -> DataFrame:
    # Delivered twice, as happens with HTTP files; each record is kept once.
    lines = http_lines(spark, sf)
    return probe_audit(lines.unionByName(lines), ["8600000000007", "8600000000008"])


# -- RADIUS messages -------------------------------------------------------

_KIND = """
  e as (
    select *, cast(user_id as varchar) as u,
      case when event_type = 'error' and (props like '%3%' or props like '%7%') then '1'
        when event_type = 'signup' and props like '%5%' then '0'
        when event_type <> 'view' and value >= 80 then '0' else 'ok' end as kind,
      case when event_type = 'view' then 'Start' else 'Stop' end as st
    from events)
"""


def _radius_sql(first: str, extra: str) -> str:
    def ok(value: str) -> str:
        return f"case when kind = 'ok' then {value} else '-1' end"

    return f"""
    with {_KIND}
    select case when kind = 'ok' then '{first}-' || u else kind end as {first}, {ok('u')} as mdn, {ok('st')} as status,
      {ok("'duration-' || u")} as duration, {ok('event_type')} as terminatecause,
      {ok("strftime(ts, '%Y-%m-%d %H:%M:%S')")} as good_time, {ok("strftime(ts, '%Y%m%d')")} as d,
      {ok("strftime(ts, '%H')")} as h, {ok("lpad(cast(minute(ts) // 5 * 5 as varchar), 2, '0')")} as m5{extra}
    from e"""


def _radius(spark: SparkSession, sf: str, layout: RadiusLayout, *more: str) -> DataFrame:
    rows = parse_messages(T.radius_messages(spark, sf, layout), layout)
    good_time = F.when(F.col("m5") == "-1", "-1").otherwise(F.col("radiustime"))
    return rows.select(
        layout.columns[0], "mdn", "status", "duration", "terminatecause", good_time.alias("good_time"), "d", "h", "m5", *more
    )


@query("radius_parse", _radius_sql("apn", ""))
def radius_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _radius(spark, sf, PGW)


@query(
    "radius_parse_ha",
    _radius_sql(
        "bsid",
        """, case when kind <> 'ok' then '-1' when st = 'Start' then 'true' else '' end as "beginSession",
        case when kind <> 'ok' then '-1' when st = 'Start' then '' else '0' end as sessioncontinue""",
    ),
)
def radius_parse_ha(spark: SparkSession, sf: str) -> DataFrame:
    return _radius(spark, sf, HA, "beginSession", "sessioncontinue")


@query(
    "radius_bad_rows",
    f"with {_KIND} select kind as apn, count(*) as n from e where kind <> 'ok' group by 1",
)
def radius_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse_messages(T.radius_messages(spark, sf, PGW), PGW)
    return bad_rows(rows, PGW).groupBy("apn").agg(F.count(F.lit(1)).alias("n"))


# -- Time ------------------------------------------------------------------

@query(
    "m5_partition",
    """
    select strftime(ts, '%Y%m%d') as d, strftime(ts, '%H') as h,
      lpad(cast(minute(ts) // 5 * 5 as varchar), 2, '0') as m5, count(*) as n,
      strftime(time_bucket(interval 5 minutes, ts), '%H:%M') as window_start
    from events group by all""",
)
def m5_partition(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    rows = T.table(spark, sf, "events").select(
        *[c.alias(n) for n, c in times.m5_columns(ts).items()],
        F.date_format(F.window(ts, "5 minutes")["start"], "HH:mm").alias("window_start"),
    )
    return rows.groupBy("d", "h", "m5", "window_start").agg(F.count(F.lit(1)).alias("n"))


@query(
    "slice_time",
    """
    select distinct strftime(ts, '%Y%m%d%H%M') as slice, strftime(ts, '%Y%m%d') as day,
      substr(strftime(ts, '%Y%m%d%H%M'), 1, 11) as ten,
      strftime(time_bucket(interval 10 minutes, ts), '%Y-%m-%d %H:%M:%S') as shown,
      epoch_ms(date_trunc('day', ts)) as day_ms, cast(ts as date) as on_date
    from events""",
)
def slice_time(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("slice")
    slices = T.table(spark, sf, "events").select(F.date_format("ts", "yyyyMMddHHmm").alias("slice")).distinct()
    day = times.slice_day(s)
    return slices.select(
        "slice", day.alias("day"), times.slice_ten_minutes(s).alias("ten"), times.slice_display(s).alias("shown"),
        times.day_start_millis(day).alias("day_ms"), F.to_date(day, "yyyyMMdd").alias("on_date"),
    )
