import itertools
import os

import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probelake import session
from probelake.functions.scalars import spread_key
from probelake.operators import cells, compaction, offsets, ranges
from probelake.plans.slice_job import SliceJob, keyed_publisher
from probelake.sinks import batches, files, jdbc, keyed, ledger, manifest
from probelake.sources import kafka, keyed as keyed_source, listing, lookups, manifest as manifest_source, slices
from probelake.sources.feeds import FEEDS


# -- Ledgers ---------------------------------------------------------------

def fold(cycles):
    """The two-slot rule, one cycle at a time."""
    state = None
    for c in cycles:
        if state is None:
            state = (c, "")
            continue
        curr, last = state
        if c < last:
            continue
        state = (curr, c) if c < curr else (c, curr)
    return state


def test_progress_is_the_fold_of_all_cycles(spark):
    sequences = [s for n in range(1, 5) for s in itertools.product(["1", "2", "3"], repeat=n)]
    data = [("".join(s) + f"#{i}", c) for i, s in enumerate(sequences) for c in s]
    got = {r["tab_name"]: (r["curr_cycle"], r["last_cycle"]) for r in ledger.progress_state(spark.createDataFrame(data, ledger.CYCLES)).collect()}
    assert got == {"".join(s) + f"#{i}": fold(s) for i, s in enumerate(sequences)}


def test_sent_cycles_are_read_back(spark, tmp_path):
    root = f"{tmp_path}/cycles"
    assert ledger.read_progress(spark, root).count() == 0
    for cycle in ("20200101", "20200103", "20200102"):
        ledger.send_cycle(spark, root, "t", cycle)
    assert rows(ledger.read_progress(spark, root, "t")) == [("t", "20200103", "20200102")]


def test_pending_slices(spark, frame, tmp_path):
    available = frame("feed string, slice string", ("gx", "1"), ("gx", "2"), ("s1u", "1"), ("gx", "2"))
    assert ledger.pending_slices(available, ledger.read_done(spark, f"{tmp_path}/done")).count() == 3
    ledger.mark_done(spark, f"{tmp_path}/done", "gx", "1")
    ledger.mark_done(spark, f"{tmp_path}/done", "gx", "1")
    assert rows(ledger.pending_slices(available, ledger.read_done(spark, f"{tmp_path}/done"))) == [("gx", "2"), ("s1u", "1")]


def test_previous_value_across_buckets_is_the_plain_lag(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        (F.col("id") * F.col("id") % 1009).alias("o"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"),
    ).dropDuplicates(["k", "o"])
    for size in (1, 10, 333, 5000):
        got = offsets.previous_value(df, ["k"], "o", "v", "p", size)
        want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("o")))
        assert rows(got) == rows(want)


def test_gaps_resume_and_last_batch(spark):
    data = [("t", "g", 0, 1, 0, 10, 5), ("t", "g", 0, 2, 10, 20, 5), ("t", "g", 0, 3, 25, 30, 5), ("t", "g", 1, 3, 0, 4, 5)]
    history = spark.createDataFrame(data, offsets.LEDGER)
    assert [r["p_delta"] for r in offsets.offset_gaps(history, 2).orderBy("part", "batch").collect()] == [0, 0, 5, 0]
    parts = spark.createDataFrame([("t", "g", p) for p in range(3)], "topic string, grp string, part int")
    assert rows(offsets.resume_points(parts, history)) == [("t", "g", 0, 30), ("t", "g", 1, 4), ("t", "g", 2, 0)]
    assert rows(offsets.resume_points(parts, history.limit(0))) == [("t", "g", p, 0) for p in range(3)]
    assert offsets.last_batch(history, "t", "g").first()[0] == 3
    assert offsets.last_batch(history, "other", "g").first()[0] == -1


# -- Slices and keyed tables -----------------------------------------------

def test_slice_rerun_retention_and_text_partitions(spark, frame, tmp_path):
    root = f"{tmp_path}/t"
    df = frame("a string", "x", "y")
    assert slices.read_slices(spark, root, df.schema, ["0"]).count() == 0
    for slice_id in ("0105", "0110", "0205"):
        files.replace_slice(df, root, slice_id)
    files.replace_slice(df.limit(1), root, "0110")
    table = slices.read_slices(spark, root, df.schema, ["01"])
    assert sorted(r["slice"] for r in table.collect()) == ["0105", "0105", "0110"]
    assert "PartitionFilters: [" in table._jdf.queryExecution().executedPlan().toString()
    every = slices.read_table(spark, root, df.schema)
    assert files.keep_slices_from(every, "0110").count() == 3
    assert slices.read_days(every, "0105", "0110", column="slice").count() == 3


def test_five_minute_partition_keeps_its_zero(spark, frame, tmp_path):
    df = frame("a string, d string, h string, m5 string", ("x", "20200101", "05", "05"), ("y", "20200101", "05", "10"))
    files.replace_partitions(df, f"{tmp_path}/p", ["d", "h", "m5"])
    part = slices.read_m5(spark, f"{tmp_path}/p", df.schema, "20200101", "05", "05")
    assert rows(part) == [("x", "20200101", "05", "05")]


def test_globs_of_two_layouts(spark, frame, tmp_path):
    files.write_orc(frame("a string", "x"), f"{tmp_path}/2019010100")
    files.write_orc(frame("a string, b string", ("y", "z")), f"{tmp_path}/2019010200")
    both = slices.read_slice_dirs(spark, str(tmp_path), ["20190101", "20190102", "2020"])
    assert rows(both.select("a", "b")) == [("x", None), ("y", "z")]
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert slices.read_slice_dirs(spark, str(tmp_path), ["1999"], schema=schema).count() == 0
    with pytest.raises(FileNotFoundError):
        slices.read_slice_dirs(spark, str(tmp_path), ["1999"])


def test_keyed_table_last_batch_wins_and_replay_is_harmless(spark, frame, tmp_path):
    root, schema = f"{tmp_path}/k", "k string, v int, at int"
    first = frame(schema, ("a", 1, 1), ("a", 2, 9), ("b", 1, 1))
    second = frame(schema, ("b", 5, 0), ("c", 5, 0))
    keyed.upsert(first, root, "1")
    keyed.upsert(second, root, "2")
    want = [("a", 2, 9), ("b", 5, 0), ("c", 5, 0)]
    read = lambda: rows(keyed_source.read_keyed(spark, root, first.schema, ["k"], ["at"]))
    assert read() == want
    keyed.upsert(second, root, "2")
    assert read() == want
    keyed.upsert(first, root, "1")  # run again late: the last write wins
    assert read() == [("a", 2, 9), ("b", 1, 1), ("c", 5, 0)]
    for batch in ("9", "10"):
        keyed.upsert(frame(schema, ("c", int(batch), 0)), root, batch)
    assert read()[2] == ("c", 10, 0)
    want = read()
    assert keyed.fold(spark, root, first.schema, ["k"], ["at"], buckets=3) and read() == want
    assert not keyed.fold(spark, root, first.schema, ["k"], ["at"]), "nothing to fold"
    keyed.upsert(frame(schema, ("a", 7, 0), ("new", 1, 1)), root, "3")
    assert read() == [("a", 7, 0), ("b", 1, 1), ("c", 10, 0), ("new", 1, 1)]
    assert not keyed.fold(spark, root, first.schema, ["k"], ["at"], share=1e9)


@pytest.mark.parametrize("keys", [["k"], ["k", "l"]])
def test_a_folded_table_is_what_its_writes_say(spark, frame, tmp_path, keys):
    root, schema = f"{tmp_path}/k", "k string, l int, v int, at int"
    every = [(k, n, i, at) for i in range(6) for k in ("a", "b", None, "c" * i) for n in (i % 3, None) for at in (i % 2, 1 - i % 2)]
    whole, newest = f"{tmp_path}/w", {}
    for i in range(6):
        batch = frame(schema, *[r for r in every if r[2] == i])
        # Numbers of writes that come out of order.
        number = [30, 10, 40, 5, 60, 20][i]
        for at in (root, whole):
            keyed.upsert(batch, at, str(i), number)
        if i in (1, 3):
            keyed.fold(spark, root, batch.schema, keys, ["at"], buckets=4)
        for r in (r for r in every if r[2] == i):
            key = tuple(r[j] for j in range(len(keys)))
            newest[key] = max(newest.get(key, (-1,)), (number, r[3], -1 if r[1] is None else r[1], r))
    folded, plain = (rows(keyed_source.read_keyed(spark, at, batch.schema, keys, ["at"])) for at in (root, whole))
    assert folded == plain == sorted((x[-1] for x in newest.values()), key=repr)


def test_the_base_is_read_without_a_shuffle(spark, frame, tmp_path):
    root, schema = f"{tmp_path}/k", "k string, v int"
    keyed.upsert(frame(schema, *[(str(i), i) for i in range(100)]), root, "1")
    keyed.fold(spark, root, frame(schema).schema, ["k"], buckets=3)
    keyed.upsert(frame(schema, ("5", 50), ("x", 1)), root, "2")
    table = keyed_source.read_keyed(spark, root, frame(schema).schema, ["k"])
    table.count()
    text = plan(table)
    joined = text[text.index("SortMergeJoin") : text.index("Bucketed: true")]
    assert "Exchange" not in joined and "FullOuter" in joined
    assert sorted(r["v"] for r in table.where("k in ('5', '6', 'x')").collect()) == [1, 6, 50]


def test_writes_during_a_fold_stay(spark, frame, tmp_path, monkeypatch):
    root, schema = f"{tmp_path}/k", "k string, v int"
    keyed.upsert(frame(schema, ("a", 1)), root, "1", 1)
    record = manifest.Change.record

    def late(self, label, *rest):
        if label == keyed_source.BASE:
            monkeypatch.setattr(manifest.Change, "record", record)
            keyed.upsert(frame(schema, ("a", 2), ("b", 2)), root, "2", 2)
        return record(self, label, *rest)

    monkeypatch.setattr(manifest.Change, "record", late)
    assert keyed.fold(spark, root, frame(schema).schema, ["k"], buckets=2)
    assert rows(keyed_source.read_keyed(spark, root, frame(schema).schema, ["k"])) == [("a", 2), ("b", 2)]


# -- Tables that are lists of files ------------------------------------------


def numbers(frame, *values):
    return frame("d string, n int", *[(f"2024010{1 + v % 3}", v) for v in values])


def test_versions_replays_and_merged_files(spark, frame, tmp_path):
    root, schema = f"{tmp_path}/t", numbers(frame).schema
    read = lambda **at: sorted(r["n"] for r in manifest_source.read_manifest(spark, root, schema, **at).collect())
    assert read() == [] and manifest_source.newest(spark, root) == 0
    assert manifest.land(spark, root, "r", 0, numbers(frame, 1, 2, 3), ["d"]) == 1
    assert manifest.land(spark, root, "r", 1, numbers(frame, 4, 5), ["d"]) == 2
    assert manifest.land(spark, root, "r", 0, numbers(frame, 9), ["d"]) is None
    assert manifest.land(spark, root, "other", 0, numbers(frame, 6), ["d"]) == 3
    assert read() == [1, 2, 3, 4, 5, 6] and read(version=1) == [1, 2, 3]
    assert read(keys=["d"], wanted=[("20240101",)]) == [3, 6]
    gone, come = manifest.cluster(spark, root, schema, ["d"])
    assert gone > come == 1 and read() == [1, 2, 3, 4, 5, 6] and read(version=2) == [1, 2, 3, 4, 5]
    assert manifest.cluster(spark, root, schema, ["d"]) == (0, 0)
    assert manifest.land(spark, root, "r", 1, numbers(frame, 4, 5), ["d"]) is None
    assert manifest.expire(spark, root) == gone and manifest.expire(spark, root) == 0
    assert read() == [1, 2, 3, 4, 5, 6] and manifest_source.versions(spark, root) == [4]
    with pytest.raises(ValueError, match="not kept"):
        read(version=2)
    assert manifest.land(spark, root, "r", 1, numbers(frame, 4, 5), ["d"]) is None
    assert manifest.land(spark, root, "r", 2, numbers(frame, 7).limit(0), ["d"]) == 5 and read() == [1, 2, 3, 4, 5, 6]


def test_the_log_is_folded_and_batches_stay_known(spark, frame, tmp_path, monkeypatch):
    root, schema = f"{tmp_path}/t", numbers(frame).schema
    monkeypatch.setattr(manifest, "FOLD_EVERY", 3)
    for i in range(7):
        manifest.land(spark, root, "r", i, numbers(frame, i).coalesce(1), ["d"])
    assert manifest_source.folded(spark, root) == [3, 6]
    held = manifest_source.entries(spark, root).where("action = 'batch'")
    assert sorted((r["lo"], r["hi"]) for r in held.collect()) == [(0, 6), (6, 7)]
    assert all(manifest_source.holds_batch(spark, root, "r", i) for i in range(7))
    assert sorted(r["n"] for r in manifest_source.read_manifest(spark, root, schema, version=4).collect()) == [0, 1, 2, 3]


def test_two_writers_of_one_version(spark, frame, tmp_path):
    root, schema = f"{tmp_path}/t", numbers(frame).schema
    for i in range(2):
        manifest.land(spark, root, "r", i, numbers(frame, i), ["d"])
    first, second = manifest.Change(spark, root), manifest.Change(spark, root)
    small = manifest_source.live_files(spark, root, "rows", 2)
    for change, value in ((first, 100), (second, 200)):
        change.add("rows", numbers(frame, value), ["d"])
        change.remove(small)
    third = manifest.Change(spark, root)
    third.add("rows", numbers(frame, 3), ["d"])
    assert first.commit() == 3 and third.commit("r", 2) == 4
    with pytest.raises(manifest.Conflict):
        second.commit()
    assert sorted(r["n"] for r in manifest_source.read_manifest(spark, root, schema).collect()) == [3, 100]


def test_a_hot_key_fills_several_files_that_do_not_overlap_others(spark, tmp_path):
    rows_ = spark.range(30_000).selectExpr("case when id % 3 = 0 then '05' else lpad(id % 10, 2, '0') end as k", "cast(id as string) as v")
    root = f"{tmp_path}/t"
    manifest.land(spark, root, "r", 0, rows_.repartition(8), ["k"])
    total = manifest_source.live_files(spark, root).agg(F.sum("n_bytes")).first()[0]
    gone, come = manifest.cluster(spark, root, rows_.schema, ["k"], target_bytes=total // 3)
    assert gone == 8 and come in (3, 4)
    files_ = manifest_source.live_files(spark, root).orderBy("least", "most").collect()
    assert max(f["n_rows"] for f in files_) < 15_000
    assert len(manifest_source.matching_files(manifest_source.live_files(spark, root), ["00"])) == 1
    assert manifest_source.read_manifest(spark, root, rows_.schema, keys=["k"], wanted=[("05",)]).count() == rows_.where("k = '05'").count()


def test_ranges(spark, frame):
    data = [("t", 0, 5), ("t", 5, 9), ("t", 3, 7), ("t", 20, 25), ("t", 8, 8), ("t", 30, 20), (None, 1, 2), (None, 2, 3), ("u", None, 4)]
    rows_ = frame("k string, lo long, hi long", *data)
    for bucket in (1, 4, 1 << 20):
        merged = ranges.merge_ranges(rows_, ["k"], bucket)
        assert rows(merged) == [("t", 0, 9, 13), ("t", 20, 25, 5), (None, 1, 3, 2)]
        assert rows(ranges.merge_ranges(merged, ["k"], bucket)) == rows(merged)
    assert rows(ranges.gaps(merged, ["k"])) == [("t", 9, 20)]
    assert rows(ranges.repeated(merged, ["k"])) == [("t", 4)]
    parts = frame("k string", "t", "u", (None,))
    assert rows(ranges.resume_at(parts, merged, ["k"])) == [("t", 25, 9), ("u", 0, 0), (None, 3, 3)]


def test_slice_job(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in/s1")
    good = ["|".join(f"{i}v{j}" for j in range(18)) for i in range(3)]
    no_number = "|".join("" if j == 4 else "x" for j in range(18))
    with open(f"{tmp_path}/in/s1/lines.txt", "w") as out:
        out.write("\n".join([*good, no_number, "too|short"]) + "\n")
    roots = {k: f"{tmp_path}/{k}" for k in ("table", "keyed", "rejects", "done")}
    job = SliceJob(FEEDS["gx"], f"{tmp_path}/in", roots["table"], "cut", keyed_publisher(roots["keyed"]), roots["rejects"], roots["done"])
    held = SliceJob(FEEDS["gx"], f"{tmp_path}/in", roots["table"], done_root=roots["done"], max_bytes=10)
    assert held.run(spark, "s1") is False and ledger.read_done(spark, roots["done"]).count() == 0
    assert job.run(spark, "s1") and job.run(spark, "s1")
    assert job.landed(spark, "s1").count() == 3
    schema = T.StructType([T.StructField(c, T.StringType()) for c in FEEDS["gx"].profiles["cut"]])
    published = keyed_source.read_keyed(spark, roots["keyed"], schema, ["MSISDN"])
    assert published.count() == 3 and "Interface" not in published.columns
    rejected = slices.read_slices(spark, roots["rejects"], spark.createDataFrame([], "feed string, n_fields int, line string").schema, ["s1"])
    assert [tuple(r)[:3] for r in rejected.collect()] == [("gx", 2, "too|short")]


def test_s5s8_publishes_nb_or_rat_8_only(frame):
    feed = FEEDS["s5s8"]
    at = {c: i for i, c in enumerate(feed.columns)}

    def line(apn, rat):
        fields = ["f"] * 30
        fields[at["APN"]], fields[at["RAT"]] = apn, rat
        return "|".join(fields)

    job = SliceJob(feed, "", "")
    landed = job.clean(frame("value string", line("x.ctnb", "6"), line("net", "8"), line("net", "6")))
    assert landed.count() == 3 and job.published(landed).count() == 2


# -- Lookups, reports, batches, JDBC ---------------------------------------

def test_lookups(spark, frame, tmp_path):
    lines = frame("value string", "1\tP\tC", "2\tP", "3\tP\tC\tX", "4\tP\tC\t")
    assert rows(lookups.lookup_from_lines(lines, ("sid", "p", "c"), "\t", exact=True)) == [("1", "P", "C"), ("4", "P", "C")]
    (tmp_path / "codes.txt").write_text("a,N1,more\nb\nc,N2\n")
    assert rows(lookups.read_codes(spark, f"{tmp_path}/codes.txt", ("code", "name"))) == [("a", "N1"), ("c", "N2")]
    assert rows(lookups.read_ids(spark, f"{tmp_path}/codes.txt")) == [("a",), ("b",), ("c",)]
    assert rows(lookups.read_ids(spark, f"{tmp_path}/codes.txt", first_field=False))[0] == ("a,N1,more",)


def test_small_reports_are_one_file(spark, frame, tmp_path):
    df = spark.range(1000).repartition(16).selectExpr("id", "'x' as t")
    files.write_csv(df, f"{tmp_path}/c", header=True, sep="|")
    parts = [f for f in os.listdir(f"{tmp_path}/c") if f.endswith(".csv")]
    assert len(parts) == 1
    files.write_csv(df, f"{tmp_path}/c", header=True, sep="|", append=True)
    assert spark.read.option("header", True).option("sep", "|").csv(f"{tmp_path}/c").count() == 2000
    files.write_text(df.limit(2), f"{tmp_path}/t")
    assert all(r[0].endswith(",x") for r in spark.read.text(f"{tmp_path}/t").collect())


def test_batches_reach_the_client_whole_and_bounded(spark, tmp_path):
    folder = str(tmp_path / "puts")
    os.makedirs(folder)

    class Client:
        def __init__(self):
            self.lines = []

        def close(self):
            import uuid

            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.writelines(f"{n} {ids}\n" for n, ids in self.lines)

    def put(client, chunk):
        client.lines.append((len(chunk), ",".join(str(r["id"]) for r in chunk)))

    batches.write_batches(spark.range(0, 105, 1, 4), Client, put, size=10)
    sizes, seen = [], []
    for name in os.listdir(folder):
        for text in open(f"{folder}/{name}"):
            n, ids = text.split(" ")
            sizes.append(int(n))
            seen += [int(i) for i in ids.split(",")]
    assert max(sizes) == 10 and sorted(seen) == list(range(105))


def test_jdbc_statements_and_defaults(frame):
    assert jdbc.jdbc_options("u", "t")["batchsize"] == "1000"
    assert jdbc.delete_statement("t", {"a": "1", "b": "2"}) == "DELETE FROM t WHERE a = ? AND b = ?"
    assert jdbc.expire_statement("t", "slice") == "DELETE FROM t WHERE slice < ?"
    merge = jdbc.merge_statement("t", "s", ["a", "b"], ["v"])
    assert "ON t.a = s.a AND t.b = s.b" in merge and "INSERT (a, b, v) VALUES (s.a, s.b, s.v)" in merge
    assert jdbc.upsert_statement("jdbc:oracle:thin:@h", "t", "s", ["a", "b"], ["v"]) == merge
    assert jdbc.upsert_statement("jdbc:mysql://h/d", "t", "s", ["a", "b"], ["v"]) == (
        "INSERT INTO t (a, b, v) SELECT a, b, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)"
    )
    df = frame("a string, r double, n long", (None, None, None), ("x", 1.5, 2))
    assert rows(jdbc.sink_defaults(df)) == [("-1", -1.0, -1), ("x", 1.5, 2)]


def test_kafka_options():
    options = kafka.kafka_options("b:9092", "t", maxOffsetsPerTrigger="10")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "10"


# -- Cells -----------------------------------------------------------------

def test_cells_in_total_order(spark, tmp_path):
    df = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id as string) end as m", "'s' as s", "'' as b", "cast(id as string) as a"
    )
    out = cells.to_cells(df, spread_key(F.col("m"), F.col("s")), ["b", "a"])
    assert out.count() == 6000 and out.where("qualifier = 'b' and value <> '-1'").count() == 0
    ordered = cells.in_total_order(out, 6)
    located = ordered.select(F.spark_partition_id().alias("p"), *cells.CELL_ORDER).collect()
    keys = [tuple(r)[1:] for r in located]
    assert keys == sorted(keys) and len(keys) == 6000
    hot_parts = {r["p"] for r in located if r["rowkey"] == "toh_s"}
    assert len(hot_parts) > 1  # a third of all cells share one key, not one task
    cells.write_cells(out, f"{tmp_path}/cells", 4)
    assert rows(spark.read.parquet(f"{tmp_path}/cells")) == rows(out)


def test_more_cells_make_more_partitions(spark):
    out = cells.to_cells(spark.range(500).selectExpr("cast(id as string) as m", "'x' as a", "'y' as b"), F.col("m"), ["a", "b"])
    for partitions in (None, 2):
        located = cells.in_total_order(out, partitions, most=100).select(F.spark_partition_id().alias("p"), *cells.CELL_ORDER).collect()
        keys, sizes = [tuple(r)[1:] for r in located], [sum(r["p"] == p for r in located) for p in {r["p"] for r in located}]
        assert keys == sorted(keys) and len(keys) == 1000 and len(sizes) >= 8 and max(sizes) <= 300


def test_files_of_a_version_are_summed_up_without_a_sort(spark, tmp_path):
    root, marked = f"{tmp_path}/t", manifest.MISSING
    data = [(k, "x") for k in ("b", "a", None, "\uffff", "\U00010000", marked, marked)]
    change = manifest.Change(spark, root)
    seen = []
    change._entry = lambda rows, action: seen.append(rows) or manifest.Change._entry(change, rows, action)
    change.add("rows", spark.createDataFrame(data, "k string, v string").coalesce(1), ["k"])
    assert "SortAggregate" not in plan(seen[0].select("path", "n_rows").distinct()).split("MapInArrow", 1)[1]
    change.commit()
    held = [(f["least"], f["most"], f["n_rows"], f["n_marked"]) for f in manifest_source.live_files(spark, root).collect()]
    assert held == [("", "\U00010000", 7, 2)]


def test_merged_files_hold_a_bounded_number_of_rows(spark, tmp_path):
    root, rows_ = f"{tmp_path}/t", spark.range(4000).selectExpr("lpad(cast(id as string), 5, '0') as k")
    manifest.land(spark, root, "r", 0, rows_.repartition(16), ["k"])
    gone, come = manifest.cluster(spark, root, rows_.schema, ["k"], target_rows=1000)
    held = [f["n_rows"] for f in manifest_source.live_files(spark, root).collect()]
    assert (gone, come) == (16, 4) and len(held) == 4 and max(held) <= 2000
    assert manifest.cluster(spark, root, rows_.schema, ["k"], target_rows=1000) == (0, 0)
    assert rows(manifest_source.read_manifest(spark, root, rows_.schema)) == rows(rows_)


# -- Compaction ------------------------------------------------------------

def one_by_one(sizes, limit):
    """The fullest group that still has room, for one file after the other."""
    totals = []
    for size in sizes:
        fits = [t for t in totals if t + size < limit]
        if fits:
            totals.remove(max(fits))
            totals.append(max(fits) + size)
        else:
            totals.append(size)
    return sorted(totals)


@given(st.lists(st.integers(1, 200), max_size=60), st.integers(2, 150))
@settings(deadline=None, max_examples=150)
def test_packing_by_classes_is_best_fit(sizes, limit):
    counts = sorted(((s, sizes.count(s)) for s in set(sizes)), reverse=True)
    totals = {}
    for size, ranges_ in compaction.plan_groups(counts, limit):
        placed = [(first + i, group + i // per) for first, n, group, per in ranges_ for i in range(n)]
        assert sorted(rank for rank, _ in placed) == list(range(sizes.count(size)))
        for _, group in placed:
            totals.setdefault(group, []).append(size)
    assert all(len(t) == 1 or sum(t) < limit for t in totals.values())
    assert sorted(map(sum, totals.values())) == one_by_one(sorted(sizes, reverse=True), limit)


def test_size_classes_round_up_a_little(spark):
    sizes = [0, 1, 2, 127, 128, 129, 255, 257, 10**6, 2**40 + 1]
    got = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", compaction.size_class(F.col("n"))).collect()
    assert all(max(n, 1) <= up <= max(1, n * (1 + 1 / 64)) for n, up in got)
    assert [up for n, up in got if n < 129] == [1, 1, 2, 127, 128]


def test_groups_do_not_depend_on_how_a_listing_is_dealt(spark):
    files_ = spark.range(2000).selectExpr(
        "case when id < 1500 then 'hot' else concat('d', id % 3) end as dir", "cast(id as string) as path",
        "case when id % 3 = 0 then 7 else id * id % 150 + 1 end as length"
    )
    got = compaction.group_small_files(files_, limit=100)
    assert got.count() == 2000
    groups = got.groupBy("dir", "grp").agg(F.sum("length").alias("n"), F.count("*").alias("c"))
    assert groups.where("n >= 100 and c > 1").count() == 0
    assert groups.where("n < 49").groupBy("dir").count().where("count > 1").count() == 0
    assert rows(got) == rows(compaction.group_small_files(files_.repartition(37), limit=100))
    assert compaction.group_small_files(files_.limit(0)).collect() == []


def test_files_by_size(frame):
    mib = compaction.MIB
    df = frame("n long", 0, 1, 128 * mib, 128 * mib + 1)
    got = df.select(compaction.files_by_size(F.col("n"), 128), compaction.files_by_size(F.col("n"), 128, True)).collect()
    assert [tuple(r) for r in got] == [(1, 0), (1, 1), (2, 1), (2, 2)]


def test_compaction_and_listing(spark, frame, tmp_path):
    df = frame("a string, d string, h string, m5 string", *[(str(i), "20200101", "05", "05") for i in range(20)])
    for i in range(4):
        files.append_partitions(df.where(F.col("a") % 4 == i), f"{tmp_path}/small", ["d", "h", "m5"])
    assert listing.list_files(spark, f"{tmp_path}/small").count() == 4
    assert compaction.compact_m5(spark, f"{tmp_path}/small", f"{tmp_path}/big", df.schema, "20200101", "05", "05") == 1
    assert listing.list_files(spark, f"{tmp_path}/big").count() == 1
    assert rows(slices.read_table(spark, f"{tmp_path}/big", df.schema, ["d", "h", "m5"])) == rows(df)
    total = listing.total_bytes(listing.list_files(spark, f"{tmp_path}/small"))
    assert compaction.admits(spark, f"{tmp_path}/small", total + 1) and not compaction.admits(spark, f"{tmp_path}/small", total)
    assert listing.total_bytes(listing.list_files(spark, f"{tmp_path}/none")) == 0
    assert listing.count_files(listing.list_files(spark, f"{tmp_path}/small"), "part", "t").first()["n"] == 4


# -- Session ---------------------------------------------------------------

def test_work_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.work_dir(spark, "x").startswith(root + "/x-")
    assert session.work_dir(spark, "x") != session.work_dir(spark, "x")
    df = spark.range(5)
    copy = session.staged(df, "copy")
    assert rows(copy) == rows(df) and "parquet" in copy._jdf.queryExecution().executedPlan().toString().lower()
