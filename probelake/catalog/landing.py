"""Landing: slices, partitions, text formats, streams. All write to the shared
folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions.radius import HA, PGW, parse_messages
from ..functions.times import m5_columns
from ..operators.compaction import replace_m5
from ..operators.enrich import Lookup
from ..operators.ranges import resume_at
from ..plans.audit import received_files
from ..plans.slice_job import SliceJob, keyed_publisher
from ..session import fits_broadcast, work_dir
from ..sinks import manifest
from ..sinks.files import append_partitions, replace_partitions, write_csv, write_orc, write_text
from ..sinks.ledger import read_done
from ..sources.feeds import FEEDS
from ..sources.keyed import read_keyed
from ..sources.listing import list_files
from ..sources.lookups import read_codes, read_dimension, read_ids, read_sites_3g
from ..sources.manifest import landed_batches, read_manifest
from ..sources.slices import read_days, read_json_lines, read_m5, read_slice_dirs, read_slices, read_table
from ..streaming.landing import PLACE, land_batch, read_landed, read_offsets, run_id, start_landing
from ..streaming.statistics import compact_statistics, landed_sessions, read_statistics, start_statistics
from . import tables as T
from .parsing import gx_lines
from .registry import query

# -- Slices ----------------------------------------------------------------


def _monthly(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Orders landed in one slice per month."""
    root = work_dir(spark, "monthly")
    rows = T.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("slice")
    )
    append_partitions(rows, root, ["slice"])
    return root, rows.drop("slice")


@query(
    "orc_slices_prefix",
    """
    select strftime(o_orderdate, '%Y%m') as slice, count(*) as n from orders
    where year(o_orderdate) in (1996, 1998) group by 1""",
)
def orc_slices_prefix(spark: SparkSession, sf: str) -> DataFrame:
    root, rows = _monthly(spark, sf)
    table = read_slices(spark, root, rows.schema, ["1996", "1998"])
    return table.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dated_tables",
    """
    select strftime(ts, '%Y%m%d') as day, count(*) as n, count(distinct user_id) as users from events
    where strftime(ts, '%Y%m%d') between '20240110' and '20240116' group by 1""",
)
def dated_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Seven days out of one day-partitioned table."""
    root = work_dir(spark, "daily")
    rows = T.table(spark, sf, "events").select("user_id", F.date_format("ts", "yyyyMMdd").alias("day"))
    append_partitions(rows, root, ["day"])
    table = read_table(spark, root, rows.drop("day").schema, ["day"])
    days = read_days(table, "20240110", "20240116")
    return days.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query(
    "multi_glob",
    """
    select count(*) as n, count(UP_TTL) as n_ttl, cast(sum(o_orderkey) as bigint) as key_sum from (
      select o_orderkey, case when o_orderstatus = 'F' then 'x' end as UP_TTL from orders)""",
)
def multi_glob(spark: SparkSession, sf: str) -> DataFrame:
    """Plain slice directories of two layouts, several globs and levels, one table."""
    root = work_dir(spark, "globs")
    rows = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    write_orc(rows.where("o_orderstatus = 'F'").withColumn("UP_TTL", F.lit("x")), f"{root}/2019010100/a")
    write_orc(rows.where("o_orderstatus = 'O'"), f"{root}/2019010101/a")
    write_orc(rows.where("o_orderstatus = 'P'"), f"{root}/2019020100/a")
    table = read_slice_dirs(spark, root, ["20190101", "20190201"], below="/*")
    return table.agg(
        F.count(F.lit(1)).alias("n"), F.count("UP_TTL").alias("n_ttl"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "slice_etl",
    """
    select '11' as "Interface", cast(o_orderkey as varchar) as "XDR_ID", '' as "IMSI", '' as "IMEI",
      cast(o_custkey as varchar) as "MSISDN", '6' as "RAT", '' as "Home_Province",
      substr(o_orderpriority, 1, 1) as "Roma_Province", o_orderstatus as "Procedure_Type",
      strftime(o_orderdate, '%Y%m%d') || '000000' as "Procedure_Start_Time", '' as "Procedure_End_Time",
      '0' as "Procedure_Status", '2001' as "Result_Code", '' as "G3PPUserLocationInfo", '' as "G3PP2BSID",
      '1' as "Machine_IP_Add_type", case when o_orderpriority like '1%' then '10.0.0.1' else '' end as "PCEF_IP_Add",
      '' as "PCRF_IP_Add"
    from orders where substr(o_orderpriority, 1, 1) not in ('4', '5')""",
)
def slice_etl(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in two slices, each parsed, landed, published and marked; the
    second one is run twice."""
    root = work_dir(spark, "etl")
    lines = gx_lines(spark, sf)
    early = F.split("value", r"\|")[8] == "F"
    lines.where(early).write.option("compression", "gzip").text(f"{root}/in/2024010100")
    lines.where(~early).write.text(f"{root}/in/202401010030")
    feed = FEEDS["gx"]
    job = SliceJob(
        feed, f"{root}/in", f"{root}/table", publish=keyed_publisher(f"{root}/keyed"),
        rejects_root=f"{root}/rejects", done_root=f"{root}/done", max_bytes=1 << 40,
    )
    # The id of one slice begins with the other's.
    for slice_id in ("202401010030", "202401010030", "2024010100"):
        job.run(spark, slice_id)
    schema = ST.StructType([ST.StructField(c, ST.StringType()) for c in feed.profiles["full"]])
    published = read_keyed(spark, f"{root}/keyed", schema, ["XDR_ID"])
    done = read_done(spark, f"{root}/done").where("feed = 'gx'").select("slice").distinct()
    slices = {"2024010100", "202401010030"}
    finished = {row["slice"] for row in done.collect()} == slices
    written = {row["run"] for row in landed_batches(spark, f"{root}/keyed").collect()}
    return published.where(F.lit(finished and written == slices)).select(*schema.names)


@query(
    "received_files",
    """
    select '19960101' as "STA_TIME", t.tag as "CHECKTYPE", 'ALL' as "PGW",
      (select count(*) from (select distinct o_orderstatus, o_orderpriority from orders) where o_orderstatus = t.st)
        as "USERNUM",
      cast(-1 as double) as "UPFLOW", cast(-1 as double) as "DOWNFLOW", cast(-1 as double) as "TOTALFLOW"
    from (values ('S5S8_NUM_DAY', 'F'), ('S1U_NUM_DAY', 'O'), ('COAP_NUM_DAY', 'P')) t(tag, st)""",
)
def received(spark: SparkSession, sf: str) -> DataFrame:
    """Slices delivered per feed, from a file listing of landed orders."""
    root = work_dir(spark, "inbox")
    rows = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    append_partitions(rows, root, ["o_orderstatus", "o_orderpriority"])
    listing = list_files(spark, root).select(F.regexp_replace("path", "/[^/]*$", "/19960101").alias("path")).distinct()
    folders = {"S5S8_NUM_DAY": "status=F/", "S1U_NUM_DAY": "status=O/", "COAP_NUM_DAY": "status=P/"}
    return received_files(listing, folders, "19960101")


# -- Text formats ----------------------------------------------------------

_BY_SEGMENT = """
    select c_mktsegment as segment, count(*) as n, cast(sum(c_custkey) as bigint) as key_sum from customer group by 1"""


def _by_segment(rows: DataFrame) -> DataFrame:
    return rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("key_sum"))


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))


@query("csv_roundtrip", _BY_SEGMENT)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = work_dir(spark, "csv"), _customers(spark, sf)
    write_csv(rows.where("segment < 'C'"), path, header=True, sep="|")
    write_csv(rows.where("segment >= 'C'"), path, header=True, sep="|", append=True)
    return _by_segment(spark.read.schema(rows.schema).option("header", True).option("sep", "|").csv(path))


@query("json_glob", _BY_SEGMENT)
def json_glob(spark: SparkSession, sf: str) -> DataFrame:
    root, rows = work_dir(spark, "json"), _customers(spark, sf)
    for host, part in (("h1", "id % 2 = 0"), ("h2", "id % 2 = 1")):
        rows.where(part).write.json(f"{root}/{host}/radius_2024010100.json")
    return _by_segment(read_json_lines(spark, f"{root}/*/radius_2024010100.json", rows.schema))


@query("parquet_dim", _BY_SEGMENT)
def parquet_dim(spark: SparkSession, sf: str) -> DataFrame:
    return _by_segment(read_dimension(spark, f"{sf}/customer.parquet", ["c_custkey as id", "c_mktsegment as segment"]))


@query("orc_dim_rename", _BY_SEGMENT)
def orc_dim_rename(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "dim")
    rows = _customers(spark, sf)
    write_orc(rows.where("id % 2 = 0"), path)
    write_orc(rows.where("id % 2 = 1"), path, append=True)
    return _by_segment(read_dimension(spark, path, ["id", "segment as segment"], fmt="orc"))


@query("text_out", "select cast(c_custkey as varchar) as \"MDN\" from customer")
def text_out(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "text")
    write_text(_customers(spark, sf), path)
    return read_ids(spark, path)


@query(
    "lookup_files",
    """
    select c_custkey, cast(n_nationkey as varchar) as sid, n_name as "provName", r_name as "cityName", n_name as "PROVNAME"
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    case_sensitive=True,
)
def lookup_files(spark: SparkSession, sf: str) -> DataFrame:
    """A tab table and a comma table, written as text and read as lookups for all customers."""
    tabs, commas = work_dir(spark, "tabs"), work_dir(spark, "commas")
    n, r = T.table(spark, sf, "nation"), T.table(spark, sf, "region")
    rows = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    write_text(rows, tabs, sep="\t")
    write_text(rows.select("n_nationkey", "n_name"), commas)
    customers = T.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("sid"))
    sites, codes = read_sites_3g(spark, tabs), read_codes(spark, commas, ("code", "PROVNAME"))
    for dim, key, columns in ((sites, "sid", ("provName", "cityName")), (codes, "code", ("PROVNAME",))):
        lookup = Lookup(dim.withColumnRenamed(key, "_dim"), "sid", "_dim", columns)
        customers = lookup.attach(customers, small=fits_broadcast(lookup.side))
    return customers


# -- Five-minute partitions ------------------------------------------------

def _tasks(spark: SparkSession) -> int:
    """Events fill thousands of partitions with a few rows each, so files, not bytes, are what landing costs."""
    return spark.sparkContext.defaultParallelism


def _five_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their partition values."""
    ts = F.col("ts").cast("timestamp")
    return T.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("mdn"), F.col("event_type").alias("cause"),
        *[c.alias(n) for n, c in m5_columns(ts).items()],
    )


_BY_M5 = """
    select strftime(ts, '%Y%m%d') as d, strftime(ts, '%H') as h,
      lpad(cast(minute(ts) // 5 * 5 as varchar), 2, '0') as m5, event_type as cause from events"""

#: The partition with most events, the first of them in time.
_FULLEST = f"""
    with e as ({_BY_M5}), fullest as (select d, h, m5 from e group by 1, 2, 3 order by count(*) desc, 1, 2, 3 limit 1)"""


def _fullest(rows: DataFrame) -> tuple[str, str, str]:
    counts = rows.groupBy("d", "h", "m5").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "d", "h", "m5").first()
    return top["d"], top["h"], top["m5"]


@query(
    "m5_read",
    _FULLEST + """
    select d, h, m5, cause, count(*) as n, false as exact from e group by all
    union all
    select d, h, m5, cause, count(*), true from e semi join fullest using (d, h, m5) group by all""",
)
def m5_read(spark: SparkSession, sf: str) -> DataFrame:
    """All partitions of all days, and one of them read exactly; text values (05) survive the round trip."""
    root, rows = work_dir(spark, "m5"), _five_minutes(spark, sf)
    replace_partitions(rows, root, ["d", "h", "m5"], tasks=_tasks(spark))
    table = read_table(spark, root, rows.schema, ["d", "h", "m5"])
    part = read_m5(spark, root, rows.schema, *_fullest(rows))
    marked = table.withColumn("exact", F.lit(False)).unionByName(part.withColumn("exact", F.lit(True)))
    return marked.groupBy("d", "h", "m5", "cause", "exact").agg(F.count(F.lit(1)).alias("n"))


@query(
    "landed_sessions",
    """
    select strftime(ts, '%Y%m%d') as d, strftime(ts, '%H') as h,
      lpad(cast(minute(ts) // 5 * 5 as varchar), 2, '0') as m5, event_type as cause,
      count(*) as session_cnt, count(distinct user_id) as mdn_cnt from events group by 1, 2, 3, 4""",
)
def landed(spark: SparkSession, sf: str) -> DataFrame:
    return landed_sessions(_five_minutes(spark, sf), ["cause"], "mdn")


@query(
    "compact_m5",
    _FULLEST + """
    select cause, count(*) as n, cast(1 as bigint) as n_files, (select count(*) from e) as n_all
    from e semi join fullest using (d, h, m5) group by 1""",
)
def compact(spark: SparkSession, sf: str) -> DataFrame:
    """Small files of one partition replaced, for all readers of the table, by as many as its size calls for."""
    root, aside = work_dir(spark, "small"), work_dir(spark, "merged")
    rows, tasks = _five_minutes(spark, sf), _tasks(spark)
    for part in (F.col("cause") < "p", F.col("cause") >= "p"):
        append_partitions(rows.where(part), root, ["d", "h", "m5"], tasks=tasks)
    d, h, m5 = _fullest(rows)
    replace_m5(spark, root, aside, rows.schema, d, h, m5)
    table = read_table(spark, root, rows.schema, ["d", "h", "m5"])
    n_files = list_files(spark, f"{root}/d={d}/h={h}/m5={m5}").count()
    mine = (F.col("d") == d) & (F.col("h") == h) & (F.col("m5") == m5)
    return table.where(mine).groupBy("cause").agg(
        F.count(F.lit(1)).alias("n"), F.lit(n_files).cast("bigint").alias("n_files"), F.lit(table.count()).alias("n_all")
    )


# -- Streams ---------------------------------------------------------------

_LANDED = """
    with m as (
      select ts, event_type = 'error' and (props like '%3%' or props like '%7%')
        or event_type = 'signup' and props like '%5%' or event_type <> 'view' and value >= 80 as unusable from events)
    select case when unusable then '-1' else strftime(ts, '%Y%m%d') end as d,
      case when unusable then '-1' else strftime(ts, '%H') end as h,
      case when unusable then '-1' else lpad(cast(minute(ts) // 5 * 5 as varchar), 2, '0') end as m5,
      count(*) as n from m group by 1, 2, 3"""


def _message_files(spark: SparkSession, sf: str, layout) -> tuple[str, str]:
    """Messages of all days in two folders; the second one also has events of times that the first has."""
    early, late = work_dir(spark, "messages"), work_dir(spark, "messages-late")
    messages = T.radius_messages(spark, sf, layout)
    second = F.pmod(F.xxhash64("value"), F.lit(4)) == 0
    messages.where(~second).write.text(early)
    messages.where(second).write.text(late)
    return early, late


def _land(spark: SparkSession, sf: str, layout, replay: bool) -> DataFrame:
    early, late = _message_files(spark, sf, layout)
    root = work_dir(spark, "landed")

    def drain(source: str, checkpoint: str) -> None:
        stream = spark.readStream.text(source)
        start_landing(stream, layout, root, checkpoint, seconds=None).awaitTermination()

    first = work_dir(spark, "checkpoint")
    drain(early, first)
    if replay:
        # The same batch again, as after a crash between landing and commit.
        land_batch(parse_messages(spark.read.text(early), layout), 0, root, run_id(spark, first))
        # A restart finds nothing new.
        drain(early, first)
    # Late records, and a run whose checkpoint was lost: its batch ids start at 0 again.
    drain(late, work_dir(spark, "checkpoint"))
    return read_landed(spark, root, layout).groupBy("d", "h", "m5").agg(F.count(F.lit(1)).alias("n"))


@query("stream_land", _LANDED)
def stream_land(spark: SparkSession, sf: str) -> DataFrame:
    return _land(spark, sf, PGW, replay=False)


@query("stream_replay", _LANDED)
def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    return _land(spark, sf, HA, replay=True)


@query(
    "landed_offsets",
    """
    with read as (select cast(event_id % 5 as integer) as part, event_id // 5 as n from events where event_id // 5 not between 100 and 149),
    numbered as (select *, n - row_number() over (partition by part order by n) as island from read),
    ranges as (select part, min(n) as lo, max(n) + 1 as hi, count(*) as covered from numbered group by part, island),
    firsts as (select part, min(lo) as lo, arg_min(hi, lo) as safe, max(hi) as last from ranges group by part)
    select 'radius' as topic, part, 'range' as what, lo, hi, covered from ranges
    union all select 'radius', part, 'resume', last, safe, cast(0 as bigint) from firsts
    union all select 'radius', part, 'landed', cast(0 as bigint), cast(0 as bigint), count(*) from read group by part""",
)
def landed_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with their topic, partition and offset land in four batches, one comes twice, one stretch never; what was
    read follows from the offsets that each batch's version brought."""
    source, root, checkpoint = work_dir(spark, "topic"), work_dir(spark, "landed"), work_dir(spark, "checkpoint")
    number = F.floor(F.col("event_id") / 5)
    messages = T.radius_messages(spark, sf, PGW, "event_id").select(
        "value", F.lit("radius").alias("topic"), (F.col("event_id") % 5).cast("int").alias("partition"), number.alias("offset")
    )
    at = F.col("offset")
    stretches = (at < 60, (at >= 150) & (at < 1000), (at >= 60) & (at < 100), at >= 1000)
    for part in stretches:
        messages.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(messages.schema).parquet(source)
        start_landing(stream, PGW, root, checkpoint, seconds=None).awaitTermination()
    again = parse_messages(messages.where(stretches[1]), PGW, kept=PLACE)
    land_batch(again, 1, root, run_id(spark, checkpoint))
    read = read_offsets(spark, root)
    parts = read.select("topic", "part").distinct()
    ends = resume_at(parts, read, ["topic", "part"])
    none = F.lit(0).cast("long")
    rows = read_manifest(spark, root, ST.StructType([ST.StructField("partition", ST.IntegerType())]))
    return (
        read.select("topic", "part", F.lit("range").alias("what"), "lo", "hi", "covered")
        .unionByName(ends.select("topic", "part", F.lit("resume").alias("what"), F.col("start_offset").alias("lo"), F.col("safe_offset").alias("hi"), none.alias("covered")))
        .unionByName(
            rows.groupBy(F.col("partition").alias("part")).agg(F.count(F.lit(1)).alias("covered"))
            .select(F.lit("radius").alias("topic"), "part", F.lit("landed").alias("what"), none.alias("lo"), none.alias("hi"), "covered")
        )
    )


_THREE_BATCHES = ("user_id % 3 <> 0 and event_type <> 'click'", "user_id % 3 <> 0 and event_type = 'click'", "user_id % 3 = 0")


@query(
    "land_compact_replay",
    f"""
    with m as (
      select *, case when user_id % 3 = 0 then 2 when event_type = 'click' then 1 else 0 end as batch from events)
    select batch as run_batch, strftime(ts, '%Y%m%d') as d, strftime(ts, '%H') as h, count(*) as n,
      cast(sum(event_id) as bigint) as ids, true as replay_left_out, true as fewer_files
    from m group by 1, 2, 3""",
)
def land_compact_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches land, their files are merged, the first comes again, a third lands, all files are merged again."""
    root = work_dir(spark, "manifest")
    keys = ("d", "h", "m5")
    ts = F.col("ts").cast("timestamp")
    events = T.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", *[c.alias(n) for n, c in m5_columns(ts).items()]
    )
    batches = [events.where(part).withColumn("run_batch", F.lit(i)) for i, part in enumerate(_THREE_BATCHES)]
    schema = batches[0].schema
    for i in (0, 1):
        manifest.land(spark, root, "run", i, batches[i].repartition(6), keys)
    gone, come = manifest.cluster(spark, root, schema, keys)
    left_out = manifest.land(spark, root, "run", 0, batches[0], keys) is None
    manifest.land(spark, root, "run", 2, batches[2].repartition(5), keys)
    manifest.cluster(spark, root, schema, keys)
    left_out = left_out and manifest.land(spark, root, "run", 2, batches[2], keys) is None
    table = read_manifest(spark, root, schema)
    return table.groupBy("run_batch", "d", "h").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")).select(
        "*", F.lit(left_out).alias("replay_left_out"), F.lit(come < gone).alias("fewer_files")
    )


_M5_STAT = """
    select strftime(ts, '%Y%m%d') as d, strftime(ts, '%H') as h,
      lpad(cast(minute(ts) // 5 * 5 as varchar), 2, '0') as m5, event_type as cause,
      count(*) as session_cnt, count(distinct user_id) as mdn_cnt from events group by 1, 2, 3, 4"""


@query("stream_m5_stat", _M5_STAT)
def stream_m5_stat(spark: SparkSession, sf: str) -> DataFrame:
    """Exact five-minute statistics kept by a stream over three batches.

    The second batch brings late records of times that the first one had, and numbers that it had brought; the files are
    merged before the third.
    """
    source, root, checkpoint = work_dir(spark, "events"), work_dir(spark, "statistics"), work_dir(spark, "checkpoint")
    events = T.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("mdn"), F.col("event_type").alias("cause"),
        *[c.alias(n) for n, c in m5_columns(F.col("ts").cast("timestamp")).items()],
    )
    by = ST.StructType([ST.StructField("cause", ST.StringType())])
    day = F.substring("d", 7, 2)
    batches = ((day < "20") & (F.col("m5") != "00"), F.col("m5") == "00", (day >= "20") & (F.col("m5") != "00"))
    for i, part in enumerate(batches):
        events.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        start_statistics(stream, root, checkpoint, ["cause"], "mdn", seconds=None).awaitTermination()
        if i == 1:
            compact_statistics(spark, root, events.schema, ["cause"], "mdn")
    return read_statistics(spark, root, by)
