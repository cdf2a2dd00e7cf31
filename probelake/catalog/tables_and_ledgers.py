"""Keyed tables, cells, ledgers and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions.scalars import spread_key
from ..operators.cells import in_total_order, read_keys, to_cells, write_cells, write_regions
from ..operators.compaction import MIB, files_by_size, group_small_files, within_gate
from ..operators.day_filters import find_new
from ..operators.offsets import last_batch, offset_gaps, resume_points
from ..operators.ranges import gaps as range_gaps
from ..operators.ranges import merge_ranges, resume_at
from ..operators.ranges import repeated as range_repeats
from ..operators.rollup import DAY, HOUR, RollUp, group_fields, text_field
from ..operators.skew import hot_keys, key_sketch, merged_sketch, split_join
from ..session import work_dir
from ..sinks.batches import write_files
from ..sinks.files import expire_slices, keep_slices_from, replace_partitions, replace_slice
from ..sinks.keyed import fold, upsert
from ..sinks.ledger import pending_slices, progress_state
from ..sources.keyed import read_keyed
from ..sources.slices import read_table
from . import tables as T
from .registry import query

# -- Cells -----------------------------------------------------------------

_CELLS = {
    "status": "o_orderstatus", "priority": "o_orderpriority", "clerk": "case when o_totalprice > 250000 then '' else 'c' end",
    "day": "date_format(o_orderdate, 'yyyyMMdd')",
}


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "orders").selectExpr(
        "cast(o_custkey as string) as msisdn", "cast(o_orderkey as string) as start",
        *[f"{e} as {c}" for c, e in _CELLS.items()],
    )
    return to_cells(rows, spread_key(F.col("msisdn"), F.col("start"), F.col("day")), list(_CELLS))


@query(
    "rowkey_cells",
    """
    with k as (
      select reverse(cast(o_custkey as varchar)) || '_' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d') as rowkey, *
      from orders)
    select rowkey, 'cf1' as cf, 'status' as qualifier, o_orderstatus as value from k
    union all select rowkey, 'cf1', 'priority', o_orderpriority from k
    union all select rowkey, 'cf1', 'clerk', case when o_totalprice > 250000 then '-1' else 'c' end from k
    union all select rowkey, 'cf1', 'day', strftime(o_orderdate, '%Y%m%d') from k""",
)
def rowkey_cells(spark: SparkSession, sf: str) -> DataFrame:
    return order_cells(spark, sf)


@query("cells_total_order", "select count(*) * 4 as n_cells, cast(0 as bigint) as n_overlaps from orders")
def cells_total_order(spark: SparkSession, sf: str) -> DataFrame:
    """Cells written in total order: key ranges of consecutive partitions do not overlap."""
    ordered = in_total_order(order_cells(spark, sf), partitions=8)
    key = F.struct("rowkey", "cf", "qualifier")
    ranges = ordered.groupBy(F.spark_partition_id().alias("pid")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")
    )
    # One row per output partition.
    before = F.lag("high").over(Window.orderBy("pid"))
    checked = ranges.withColumn("overlaps", F.when(before > F.col("low"), 1).otherwise(0))
    return checked.agg(
        F.sum("n").cast("bigint").alias("n_cells"), F.sum("overlaps").cast("bigint").alias("n_overlaps")
    )


@query(
    "cells_written",
    """
    select qualifier, count(*) as n, min(rowkey) as first_key, max(rowkey) as last_key from (
      select reverse(cast(o_custkey as varchar)) || '_' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d') as rowkey,
        unnest(['status', 'priority', 'clerk', 'day']) as qualifier
      from orders) group by 1""",
)
def cells_written(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "cells")
    write_cells(order_cells(spark, sf), path, partitions=8, codec="gzip")
    return spark.read.parquet(path).groupBy("qualifier").agg(
        F.count(F.lit(1)).alias("n"), F.min("rowkey").alias("first_key"), F.max("rowkey").alias("last_key")
    )


@query(
    "cells_by_region",
    """
    with k as (
      select reverse(cast(o_custkey as varchar)) || '_' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d') as rowkey, o_orderstatus, o_orderpriority
      from orders),
    c as (
      select rowkey, 'status' as qualifier, o_orderstatus as value from k
      union all select rowkey, 'priority', o_orderpriority from k)
    select 'point' as what, rowkey, qualifier, value, cast(1 as bigint) as n, 1 as n_files from c where rowkey = (select max(rowkey) from k)
    union all
    select 'range', substr(rowkey, 1, 2), qualifier, '', count(*), 1 from c where rowkey >= '31' and rowkey < '34' group by 2, 3
    union all
    select 'all', '', qualifier, '', count(*), 10 from c group by 3""",
)
def cells_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Cells in regions with given borders; a point and a range are looked up through the index, files opened counted."""
    root = work_dir(spark, "regions")
    cells = order_cells(spark, sf).where("qualifier in ('status', 'priority')")
    write_regions(cells, root, [str(i) for i in range(1, 10)], block=500)
    last = cells.agg(F.max("rowkey")).first()[0]
    point = read_keys(spark, root, cells.schema, last)
    some = read_keys(spark, root, cells.schema, "31", "34")
    whole = read_keys(spark, root, cells.schema, "", "~")
    counted = lambda rows, name, key: rows.groupBy(key.alias("rowkey"), "qualifier").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("what"), "rowkey", "qualifier", F.lit("").alias("value"), "n", F.lit(len(rows.inputFiles())).alias("n_files")
    )
    found = point.select(
        F.lit("point").alias("what"), "rowkey", "qualifier", "value", F.lit(1).cast("long").alias("n"),
        F.lit(len(point.inputFiles())).alias("n_files"),
    )
    return found.unionByName(counted(some, "range", F.substring("rowkey", 1, 2))).unionByName(counted(whole, "all", F.lit("")))


@query(
    "client_batches",
    """
    select o_orderpriority, count(*) as n, cast(sum(o_orderkey) as bigint) as keys, true as small_files from orders group by 1""",
)
def client_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows handed in lists to a client that writes a file for each."""
    root = work_dir(spark, "client")
    rows = T.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    write_files(rows.repartition(5), root, size=400)
    written = spark.read.schema(rows.schema).parquet(root)
    most = written.groupBy(F.col("_metadata.file_path").alias("f")).count().agg(F.max("count")).first()[0]
    return written.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).withColumn(
        "small_files", F.lit(most <= 400)
    )


# -- Figures kept as partials ------------------------------------------------

@query(
    "rollup_daily",
    """
    with e as (select *, strftime(ts, '%Y%m%d') as day, strftime(ts, '%Y%m%d%H') as hour from events)
    select day as slot, event_type, count(*) as records, cast(sum(event_id) as double) as ids, count(distinct user_id) as numbers, true as estimated
    from e group by 1, 2
    union all
    select hour, event_type, count(*), cast(sum(event_id) as double), count(distinct user_id), true from e where day >= '20240116' group by 1, 2""",
)
def rollup_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily and hourly figures from partials of ten minutes, landed in three batches, with folds in between."""
    ts = F.col("ts").cast("timestamp")
    rows = T.table(spark, sf, "events").select(
        "event_type", "event_id", F.col("user_id").cast("string").alias("mdn"), F.date_format(ts, "yyyyMMddHHmm").alias("time")
    )
    table = RollUp(spark, work_dir(spark, "rollup"), group_fields(["event_type"]), text_field("mdn"), {"ids": "event_id"})
    late = F.col("event_id") % 10 == 0
    early = F.col("time") < "20240116"
    for i, part in enumerate((early & ~late, ~early & ~late, late)):
        table.add(rows.where(part), "run", i, "time")
        if i == 0:
            table.fold(DAY, "20240110")
    table.add(rows.where(late), "run", 2, "time")
    table.fold(HOUR, "2024012000")
    table.fold(DAY, "20240116")
    whole = table.read(DAY).unionByName(table.read(HOUR).where("slot >= '2024011600'"))
    near = F.abs(F.col("numbers") - F.col("numbers_estimate")) <= F.greatest(F.lit(2.0), 0.1 * F.col("numbers"))
    return whole.select("slot", "event_type", "records", "ids", "numbers", near.alias("estimated"))


@query(
    "hot_key_join",
    """
    with l as (
      select *, case when l_orderkey % 3 = 0 then 1 when l_orderkey % 50 = 1 then null else l_partkey end as number from lineitem)
    select p_brand, count(*) as n, count(distinct l_orderkey) as orders, cast(sum(floor(l_extendedprice)) as double) as price, true as found
    from l left join part on number = p_partkey group by 1""",
)
def hot_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """A third of all rows on one key: found by a sketch, dealt to many tasks, counted with distinct values."""
    number = F.when(F.col("l_orderkey") % 3 == 0, 1).when(F.col("l_orderkey") % 50 == 1, None).otherwise(F.col("l_partkey"))
    facts = T.table(spark, sf, "lineitem").select(number.alias("number"), "l_orderkey", "l_extendedprice", "l_linenumber")
    halves = [key_sketch(facts.where(F.col("l_linenumber") % 2 == i), "number") for i in (0, 1)]
    hot = hot_keys(merged_sketch(halves[0].unionByName(halves[1])), share=0.05)
    joined = split_join(facts, T.table(spark, sf, "part").hint("merge"), "number", "p_partkey", ["p_brand"], "left", hot)
    return joined.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"),
        F.sum(F.floor("l_extendedprice").cast("double")).alias("price"),
    ).withColumn("found", F.lit(hot == ["1"]))


@query(
    "new_keys_by_day",
    """
    select strftime(min(l_shipdate), '%Y') as day, cast(l_partkey as varchar) as address from lineitem
    where year(l_shipdate) <> 1995 group by l_partkey""",
)
def new_keys_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses by the day (a year here) that they were first seen on, with filters of the days before."""
    known, filters = work_dir(spark, "known"), work_dir(spark, "filters")
    seen = T.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("address"), F.date_format("l_shipdate", "yyyy").alias("year")
    )
    years = [r["year"] for r in seen.select("year").distinct().orderBy("year").collect()]
    for year in years:
        if year != "1995":
            find_new(spark, seen.where(F.col("year") == year), "address", known, filters, year, bits=1 << 20)
    return read_table(spark, known, ST.StructType([ST.StructField("address", ST.StringType())]), ("day",), fmt="parquet").select("day", "address")


# -- Keyed tables ----------------------------------------------------------

def _keyed_orders(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Orders put into a table keyed by customer and priority, in two batches."""
    root = work_dir(spark, "keyed")
    rows = T.table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    first, second = rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P'")
    upsert(second, root, "9")
    upsert(first, root, "10")
    upsert(second, root, "9")  # run again late: now the last write
    upsert(second, root, "9")  # a replay changes nothing
    return root, rows


_LATEST = """
    select o_custkey, o_orderpriority, o_orderkey, o_totalprice, o_orderstatus from (
      select *, row_number() over (partition by o_custkey, o_orderpriority
        order by case when o_orderstatus = 'P' then 1 else 0 end desc, o_orderkey desc) as rn from orders)
    where rn = 1"""


@query("keyed_upsert", _LATEST)
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    root, rows = _keyed_orders(spark, sf)
    return read_keyed(spark, root, rows.schema, ["o_custkey", "o_orderpriority"], ["o_orderkey"])


@query("keyed_snapshot", _LATEST)
def keyed_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A base in sorted buckets, writes beside it that are new, newer or too old for it, and a second fold."""
    root, keys, order = work_dir(spark, "keyed"), ["o_custkey", "o_orderpriority"], ["o_orderkey"]
    rows = T.table(spark, sf, "orders").select(*keys, *order, "o_totalprice", "o_orderstatus")
    finished, pending = rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P'")
    even = F.col("o_custkey") % 2 == 0
    upsert(finished.where(even).withColumn("o_totalprice", F.lit(-1.0)), root, "wrong", 10)
    upsert(finished.where(even), root, "right", 20)
    fold(spark, root, rows.schema, keys, order, buckets=8)
    upsert(pending, root, "pending", 40)
    upsert(finished.where(~even), root, "rest", 30)
    upsert(finished.withColumn("o_totalprice", F.lit(-1.0)), root, "late", 5)
    fold(spark, root, rows.schema, keys, order, buckets=4, share=0.1)
    upsert(pending, root, "again", 50)
    return read_keyed(spark, root, rows.schema, keys, order)


def _after_expiry(spark: SparkSession, root: str, rows: DataFrame, table: DataFrame) -> DataFrame:
    """The table once its slices before 1998 are deleted, copied so that the reader above keeps its own."""
    copy = work_dir(spark, "slices-copy")
    replace_partitions(table, copy, ["slice"])
    expire_slices(spark, copy, "1998")
    return read_table(spark, copy, rows.drop("year").schema)


@query(
    "replace_slice",
    """
    select cast(year(o_orderdate) as varchar) as slice, count(*) as n, cast(sum(o_orderkey) as bigint) as key_sum
    from (select * from orders where year(o_orderdate) >= 1997
      union all select * from orders where year(o_orderdate) >= 1998)
    where not (year(o_orderdate) = 1998 and o_orderstatus = 'P') group by 1""",
)
def replace_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Land slices, run one again with corrected content, drop the old ones."""
    root = work_dir(spark, "slices")
    rows = T.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("string").alias("year")
    )
    replace_partitions(rows.withColumnRenamed("year", "slice"), root, ["slice"])
    replace_slice(rows.where("year = '1998' and o_orderstatus <> 'P'").drop("year"), root, "1998")
    table = read_table(spark, root, rows.drop("year").schema)
    kept = keep_slices_from(table, "1997").unionByName(_after_expiry(spark, root, rows, table))
    return kept.groupBy("slice").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


# -- Ledgers ---------------------------------------------------------------

@query(
    "breakpoint_advance",
    """
    with c as (
      select event_type as tab_name, strftime(ts, '%Y%m%d%H') as cycle,
        row_number() over (partition by event_type order by strftime(ts, '%Y%m%d%H') desc) as rn from events)
    select tab_name, max(cycle) as curr_cycle, coalesce(max(cycle) filter (where rn = 2), '') as last_cycle
    from c where rn <= 2 group by 1""",
)
def breakpoint_advance(spark: SparkSession, sf: str) -> DataFrame:
    cycles = T.table(spark, sf, "events").select(
        F.col("event_type").alias("tab_name"), F.date_format("ts", "yyyyMMddHH").alias("cycle")
    )
    return progress_state(cycles)


@query(
    "pending_slices",
    """
    select distinct event_type as feed, strftime(ts, '%Y%m%d%H') as slice from events
    except select event_type, strftime(ts, '%Y%m%d%H') from events where value > 40""",
)
def pending(spark: SparkSession, sf: str) -> DataFrame:
    slices = T.table(spark, sf, "events").select(
        F.col("event_type").alias("feed"), F.date_format("ts", "yyyyMMddHH").alias("slice"), "value"
    )
    return pending_slices(slices, slices.where("value > 40"))


def event_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """An offset ledger with gaps: every event is a batch of its type and user."""
    return T.table(spark, sf, "events").selectExpr(
        "event_type as topic", "'g' as grp", "cast(user_id % 8 as int) as part", "event_id as batch",
        "event_id * 10 as p_from", "event_id * 10 + cast(floor(value) as bigint) as p_until",
        "cast(0 as bigint) as cost_ms",
    )


@query(
    "offset_gaps",
    """
    select topic, grp, part, batch, p_from, p_until, cost_ms,
      coalesce(p_from - lag(p_until) over (partition by topic, grp, part order by batch), 0) as p_delta
    from (select event_type as topic, case when user_id % 8 < 6 then 'g' end as grp,
        cast(user_id % 8 as integer) as part, event_id as batch,
      event_id * 10 as p_from, event_id * 10 + cast(floor(value) as bigint) as p_until, cast(0 as bigint) as cost_ms
      from events)""",
)
def gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Groups may be null."""
    ledger = event_offsets(spark, sf).withColumn("grp", F.when(F.col("part") < 6, F.col("grp")))
    return offset_gaps(ledger, bucket_size=1000)


@query(
    "resume_points",
    """
    with l as (
      select event_type as topic, cast(user_id % 8 as integer) as part,
        arg_max(event_id * 10 + cast(floor(value) as bigint), event_id) as until
      from events group by 1, 2)
    , p as (
      select t.topic, cast(r as integer) as part
      from (select distinct event_type as topic from events) t, range(0, 10) x(r))
    select p.topic, 'g' as grp, p.part, coalesce(l.until, 0) as start_offset
    from p left join l on p.topic = l.topic and p.part = l.part""",
)
def resume(spark: SparkSession, sf: str) -> DataFrame:
    ledger = event_offsets(spark, sf)
    # Ten partitions per topic now, eight when the ledger was written.
    parts = ledger.select("topic", "grp").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(9))))
    return resume_points(parts, ledger)


@query(
    "offset_ranges",
    """
    with l as (
      select event_type as topic, cast(user_id % 8 as integer) as part, event_id // 10 as lo, event_id // 10 + 3 as hi
      from events where event_id % 7 > 0),
    marked as (
      select *, case when lo <= max(hi) over (partition by topic, part order by lo, hi rows between unbounded preceding and 1 preceding)
        then 0 else 1 end as starts from l),
    numbered as (select *, sum(starts) over (partition by topic, part order by lo, hi) as island from marked),
    islands as (select topic, part, min(lo) as lo, max(hi) as hi, cast(sum(hi - lo) as bigint) as covered from numbered group by topic, part, island),
    after as (select *, lead(lo) over (partition by topic, part order by lo) as next from islands)
    select topic, part, lo, hi, covered, 'range' as what from islands
    union all select topic, part, hi, next, cast(0 as bigint), 'gap' from after where next is not null
    union all select topic, part, min(lo), max(hi), cast(sum(covered - (hi - lo)) as bigint), 'repeated' from islands group by topic, part
      having sum(covered - (hi - lo)) > 0""",
)
def offset_sets(spark: SparkSession, sf: str) -> DataFrame:
    """A ledger with overlapping, repeated and missing batches as merged ranges, the gaps between them, and how much of
    each partition was read again. The ranges of two halves of the ledger are merged to those of the whole."""
    keys = ["topic", "part"]
    number = F.floor(F.col("event_id") / 10)
    ledger = T.table(spark, sf, "events").where("event_id % 7 > 0").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 8).cast("int").alias("part"),
        number.alias("lo"), (number + 3).alias("hi"), "event_id",
    )
    halves = [merge_ranges(ledger.where(F.col("event_id") % 2 == i), keys, bucket=100) for i in (0, 1)]
    merged = merge_ranges(halves[0].unionByName(halves[1]), keys, bucket=1000)
    none = F.lit(0).cast("long")
    ends = merged.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    again = range_repeats(merged, keys).withColumnRenamed("repeated", "covered").join(ends, keys)
    return (
        merged.withColumn("what", F.lit("range"))
        .unionByName(range_gaps(merged, keys).withColumn("covered", none).withColumn("what", F.lit("gap")))
        .unionByName(again.withColumn("what", F.lit("repeated")))
    )


@query(
    "resume_from_ranges",
    """
    with n as (select distinct event_type as topic, user_id % 8 as part, event_id // 2000 as number from events where event_id // 2000 <> 3),
    p as (select topic, r as part from (select distinct event_type as topic from events) t, range(0, 10) x(r)),
    runs as (
      select *, min(number) over (partition by topic, part) + row_number() over (partition by topic, part order by number) - 1 as dense
      from n)
    select p.topic, cast(p.part as integer) as part, cast(coalesce(max(number) + 1, 0) as bigint) as start_offset,
      cast(coalesce(min(number), 0) as bigint) + cast(count(number) filter (number = dense) as bigint) as safe_offset
    from p left join runs using (topic, part) group by p.topic, p.part""",
)
def resume_from_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Where each partition goes on after its last number, and where it has to begin so that a missing batch is read."""
    events = T.table(spark, sf, "events")
    number = F.floor(F.col("event_id") / 2000)
    read = events.where(number != 3).select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 8).alias("part"), number.alias("lo"), (number + 1).alias("hi")
    )
    parts = events.select(F.col("event_type").alias("topic")).distinct().withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long")))
    )
    ends = resume_at(parts, merge_ranges(read, ["topic", "part"]), ["topic", "part"])
    return ends.withColumn("part", F.col("part").cast("int"))


@query(
    "last_batch",
    "select max(event_id) as batch from events where event_type = 'error' union all select cast(-1 as bigint)",
)
def newest_batch(spark: SparkSession, sf: str) -> DataFrame:
    ledger = event_offsets(spark, sf)
    return last_batch(ledger, "error", "g").unionByName(last_batch(ledger, "absent", "g"))


# -- Files -----------------------------------------------------------------

def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """A listing in which every document is a file of its source and language."""
    return T.table(spark, sf, "documents").select(
        F.concat_ws("/", "source", "lang").alias("dir"),
        F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        (F.col("n_chars") * 1024).alias("length"),
    )


@query(
    "compact_plan",
    """
    select source || '/' || lang as dir, count(*) as n_files, cast(sum(n_chars) * 1024 as bigint) as total_bytes,
      0 as n_too_large, 0 as n_elsewhere, true as few_groups
    from documents group by 1""",
)
def compact_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Grouping of small files: every file is placed, no group of several exceeds the limit, and the same files come
    together whether the listing is in 1 partition or in 211."""
    limit, listing = 16 * MIB, document_files(spark, sf)
    one, many = (group_small_files(listing.repartition(n), limit) for n in (1, 211))
    both = one.join(many.select("path", F.col("grp").alias("other")), "path")
    groups = both.groupBy("dir", "grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.count_if(F.col("grp") != F.col("other")).alias("elsewhere")
    )
    too_large = (F.col("n") > 1) & (F.col("bytes") >= limit)
    # Best fit by size classes leaves at most one group well under half of the limit.
    few = F.count_if(F.col("bytes") < 0.49 * limit) <= 1
    return groups.groupBy("dir").agg(
        F.sum("n").alias("n_files"),
        F.sum("bytes").alias("total_bytes"),
        F.count(F.when(too_large, 1)).cast("int").alias("n_too_large"),
        F.sum("elsewhere").cast("int").alias("n_elsewhere"),
        few.alias("few_groups"),
    )


@query(
    "size_gate",
    """
    select dir, total_bytes, cast(floor(total_bytes / 1048576.0 / 4) as bigint) + 1 as n_files,
      cast(ceil(total_bytes / 1048576.0 / 4) as bigint) as n_files_up
    from (select source || '/' || lang as dir, cast(sum(n_chars) * 1024 as bigint) as total_bytes
      from documents group by 1)
    where total_bytes < 2147483648""",
)
def size_gate(spark: SparkSession, sf: str) -> DataFrame:
    small = within_gate(document_files(spark, sf), "dir", 2 * 1024 * MIB)
    total = F.col("total_bytes")
    return small.select(
        "dir", "total_bytes", files_by_size(total, 4).alias("n_files"),
        files_by_size(total, 4, round_up=True).alias("n_files_up"),
    )
