"""Cells in given regions, filters by day, partial figures, hot keys, files of a client, layouts of feeds."""

import bisect
from collections import defaultdict
from dataclasses import replace

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from probelake.catalog import feed_rows
from probelake.catalog.layouts import LAYOUTS
from probelake.operators import cells, day_filters, skew
from probelake.operators.rollup import DAY, HOUR, SLOT, RollUp, group_fields, text_field
from probelake.plans.slice_job import SliceJob
from probelake.sinks import batches
from probelake.sources.feeds import FEEDS, publication
from probelake.sources.manifest import live_files


# -- Regions -----------------------------------------------------------------

@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abc", min_size=1, max_size=3), max_size=30), st.lists(st.text("abcd", max_size=4), min_size=1, max_size=20))
def test_a_key_belongs_to_the_region_that_it_falls_in(spark, splits, keys):
    points = sorted(set(splits))
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", cells.region_of(F.col("k"), splits).alias("r"))
    assert [tuple(r) for r in got.collect()] == [(k, bisect.bisect_right(points, k)) for k in keys]


def test_regions_are_sorted_files_and_lookups_open_few(spark, tmp_path):
    keys = [f"{i:04d}" for i in range(900)] + ["hot"] * 600
    data = [(k, "cf1", f"q{i % 3}", str(i)) for i, k in enumerate(keys)]
    table = spark.createDataFrame(data, "rowkey string, cf string, qualifier string, value string").repartition(7)
    splits = ["0100", "0500", "09", "zz"]
    cells.write_regions(table, f"{tmp_path}/r", splits, block=100)
    read = lambda *ends: cells.read_keys(spark, f"{tmp_path}/r", table.schema, *ends)
    assert rows(read("", "~")) == rows(table)
    assert rows(read("0123").select("value")) == [("123",)] and len(read("0123").inputFiles()) == 1
    assert read("0450", "0550").count() == 100 and len(read("0450", "0550").inputFiles()) == 2
    assert read("hot").count() == 600 and read("nothing").collect() == [] and read("zzz").collect() == []
    where = spark.read.parquet(f"{tmp_path}/r/cells").select("rowkey", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    by_file = defaultdict(list)
    for r in sorted(where.collect(), key=lambda r: r["i"]):
        by_file[r["f"]].append(r["rowkey"])
    assert len(by_file) == 4 and all(own == sorted(own) for own in by_file.values())
    assert {bisect.bisect_right(splits, own[0]) for own in by_file.values()} == {0, 1, 2, 3}
    index = spark.read.parquet(f"{tmp_path}/r/index")
    assert index.count() == 1 + 4 + 4 + 6 and index.agg(F.sum("n_cells")).first()[0] == 1500
    # A crowded region gets several files; a lookup opens those of its region only.
    cells.write_regions(table, f"{tmp_path}/r", splits, most_cells=250)
    assert rows(read("", "~")) == rows(table)
    assert read("hot").count() == 600 and len(read("hot").inputFiles()) == 3 and len(read("0001").inputFiles()) == 1
    cells.write_regions(table.limit(0), f"{tmp_path}/none", [])
    assert cells.read_keys(spark, f"{tmp_path}/none", table.schema, "", "~").collect() == []


# -- Filters by day ----------------------------------------------------------

def test_filters_have_their_keys_and_few_others(spark):
    keys = spark.range(1000).selectExpr("concat('k', id) as k")
    others = spark.range(1000, 21_000).selectExpr("concat('k', id) as k")
    bits = 1 << 17
    one = day_filters.key_filter(keys, "k", bits)
    assert day_filters.passing(keys, "k", one, [], bits).count() == 1000
    assert day_filters.passing(others, "k", one, [], bits).count() < 20
    halves = [day_filters.key_filter(keys.where(F.xxhash64("k") % 2 == i), "k", bits) for i in (0, 1, -1)]
    merged = day_filters.merged_filter(halves[0].unionByName(halves[1]).unionByName(halves[2]))
    assert rows(merged) == rows(one)


@pytest.mark.parametrize("bits", [1 << 8, 1 << 20])
def test_new_keys_are_exact_whatever_the_filters_let_pass(spark, tmp_path, bits):
    known, kept = f"{tmp_path}/known", f"{tmp_path}/filters"
    days = {"01": ["a", "b", "b", None], "02": ["b", "c", *[f"n{i}" for i in range(200)]], "03": ["a", "c", "d", None, "n5"], "04": []}
    seen, want = set(), {}
    for day, own in days.items():
        frame = spark.createDataFrame([(k,) for k in own], "address string")
        want[day] = {k for k in own if k not in seen or k is None}
        for _ in range(2):  # a day that runs again finds the same
            got = {r["address"] for r in day_filters.find_new(spark, frame, "address", known, kept, day, bits).collect()}
            assert got == want[day]
        seen |= {k for k in own if k is not None}
    listed = {(r["address"], f"{int(r['day']):02d}") for r in spark.read.parquet(known).collect()}
    assert listed == {(k, day) for day, own in want.items() for k in own if k is not None}


def test_only_the_days_that_a_filter_names_are_read(spark, tmp_path):
    known, kept = f"{tmp_path}/known", f"{tmp_path}/filters"
    for i in range(5):
        frame = spark.createDataFrame([(f"d{i}k{j}",) for j in range(20)], "address string")
        day_filters.find_new(spark, frame, "address", known, kept, f"0{i}")
    asked = spark.createDataFrame([("d3k1",), ("new",)], "address string")
    found = day_filters.known_keys(spark, asked, "address", known, kept, "09")
    assert rows(found) == [("d3k1",)]
    filters = [part.partition("]")[0] for part in plan(found).split("PartitionFilters: [")[1:]]
    assert any("= 03" in f for f in filters) and not any(f"= 0{i}" in f for f in filters for i in (0, 1, 2, 4))


# -- Partial figures ---------------------------------------------------------

def test_partials_merge_to_the_direct_figures(spark, tmp_path):
    data = [
        (None if i % 13 == 0 else "xy"[i % 2], None if i % 11 == 0 else f"m{i * 7 % 40}", float(i), f"202401{1 + i % 3:02d}{i % 24:02d}{i % 6}{i % 10}")
        for i in range(600)
    ]
    schema = "cause string, mdn string, price double, time string"
    by = group_fields(["cause"])
    table = RollUp(spark, f"{tmp_path}/r", by, text_field("mdn"), {"total": "price"})

    def direct(own, digits):
        groups = defaultdict(list)
        for cause, mdn, price, time in own:
            groups[time[:digits], cause].append((mdn, price))
        return sorted(
            ((*k, len(v), sum(p for _, p in v), len({m for m, _ in v if m is not None})) for k, v in groups.items()), key=repr
        )

    def kept(digits):
        return rows(table.read(digits).drop("numbers_estimate"))

    parts = [data[0::3], data[1::3], data[2::3]]
    for i, part in enumerate(parts):
        assert table.add(spark.createDataFrame(part, schema), "r", i, "time") is not None
        assert table.add(spark.createDataFrame(part, schema), "r", i, "time") is None
        if i == 0:
            assert table.fold(HOUR, "2024010212") > 0
        if i == 1:
            table.fold(DAY, "20240102")
        so_far = [row for own in parts[: i + 1] for row in own]
        assert kept(DAY) == direct(so_far, DAY)
    late = [row for row in data if row[3] >= "20240103"]
    assert [r for r in kept(SLOT) if r[0] >= "20240103"] == direct(late, SLOT)
    table.fold(DAY, "20240104")
    assert kept(DAY) == direct(data, DAY)
    assert {r["label"] for r in live_files(spark, f"{tmp_path}/r").collect()} == {f"figures-{DAY}", f"numbers-{DAY}"}
    estimates = table.read(DAY).select("numbers", "numbers_estimate").collect()
    assert all(abs(r[0] - r[1]) <= 2 for r in estimates)


# -- Hot keys ----------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(20_000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 41 = 0 then null else id % 4000 end as k", "id as v", "cast(id % 5 as string) as w"
    )


def test_a_sketch_finds_the_hot_keys(spark, skewed):
    halves = [skew.key_sketch(skewed.where(F.col("v") % 2 == i), "k") for i in (0, 1)]
    assert skew.hot_keys(skew.merged_sketch(halves[0].unionByName(halves[1]))) == skew.hot_keys(skew.key_sketch(skewed, "k")) == ["7"]
    assert skew.hot_keys(skew.key_sketch(skewed.limit(0), "k")) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_split_join_gives_the_rows_of_a_plain_one(spark, skewed, how):
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 4000, 2)] + [(7, "a"), (7, "b"), (None, "none"), (8, "twice")], "d long, name string")
    want = skewed.join(dim, F.col("k") == F.col("d"), how).drop("d")
    for hot in (None, [], ["7", "8", "absent"]):
        assert rows(skew.split_join(skewed, dim, "k", "d", ["name"], how, hot, salts=5)) == rows(want)
    with pytest.raises(ValueError):
        skew.split_join(skewed, dim, "k", "d", ["name"], "full")


def test_a_hot_key_is_dealt_to_many_tasks(spark, skewed):
    dim = spark.createDataFrame([(i, "n") for i in range(4000)], "d long, name string").hint("merge")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = skew.split_join(skewed, dim, "k", "d", ["name"]).where("k = 7")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == skewed.where("k = 7").count() and max(sizes) < sum(sizes) / 4


# -- Clients -----------------------------------------------------------------

def test_a_client_s_files_are_the_same_after_another_run(spark, tmp_path):
    table = spark.range(1000).selectExpr("id", "cast(id as string) as s", "if(id % 3 = 0, null, id / 2) as x").repartition(3)
    for _ in range(2):
        batches.write_files(table, f"{tmp_path}/out", size=150)
        written = spark.read.parquet(f"{tmp_path}/out")
        assert rows(written.select(*table.columns)) == rows(table)
        sizes = [r["count"] for r in written.groupBy(F.col("_metadata.file_path")).count().collect()]
        assert max(sizes) <= 150 and len(sizes) <= 9


# -- Feeds -------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_feeds_read_the_fields_that_their_layout_states(name):
    assert list(FEEDS[name].columns)[: len(LAYOUTS[name].names)] == LAYOUTS[name].names or LAYOUTS[name].folded
    assert FEEDS[name].required == LAYOUTS[name].required


def test_two_swapped_columns_do_not_pass(spark, tmp_path):
    layout, feed = LAYOUTS["s6a"], FEEDS["s6a"]
    spark.createDataFrame([(i, 5, "F", 1.0, None, "1") for i in range(1, 12)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    lines = feed_rows._lines(spark, str(tmp_path), layout)
    columns = list(feed.columns)
    columns[9], columns[10] = columns[10], columns[9]
    swapped = replace(feed, columns=tuple(columns))
    published = [publication(SliceJob(f, "", "").clean(lines), f, "full").select(*sorted(layout.names)) for f in (feed, swapped)]
    assert rows(published[0]) != rows(published[1])
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    result = con.execute(feed_rows._sql(layout))
    at = sorted(range(len(layout.names)), key=lambda i: [d[0] for d in result.description][i])
    want = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    assert want == rows(published[0]) != rows(published[1])
