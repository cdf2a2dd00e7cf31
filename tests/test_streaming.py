import json
import os

from conftest import rows
from test_radius import message

from probelake.functions.radius import PGW, parse_messages
from probelake.operators import ranges
from probelake.operators.offsets import LEDGER, offset_gaps
from probelake.sources.manifest import live_files, matching_files
from probelake.streaming.landing import PLACE, compact_landed, land_batch, read_landed, read_offsets, run_id, start_landing
from probelake.streaming.progress import OffsetLedger, ledger_rows
from probelake.streaming.statistics import (
    add_statistics, compact_statistics, landed_sessions, read_statistics, start_statistics, windowed_sessions,
)


def put(folder, name, *messages):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as out:
        out.write("\n".join(messages) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def at(time, mdn="m1"):
    return message(PGW, MDN=mdn, StopTime=f"2020-01-01 {time}")


def test_landing_restart_and_replay(spark, tmp_path):
    source, root, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    put(source, "a", at("10:01:00"), at("10:04:59", "m2"), "not json")

    def drain():
        start_landing(spark.readStream.text(source), PGW, root, checkpoint, seconds=None).awaitTermination()

    def landed(*wanted):
        return rows(read_landed(spark, root, PGW, list(wanted) or None).select("m5", "mdn"))

    drain()
    first = [("-1", "-1"), ("00", "m1"), ("00", "m2")]
    assert landed() == first
    drain()  # nothing new
    assert landed() == first
    # A restart with more input, among it a late record of the old five minutes.
    put(source, "b", at("10:00:01", "late"), at("10:09:00", "m3"))
    drain()
    after = sorted([*first, ("00", "late"), ("05", "m3")])
    assert landed() == after
    # Batch 1 again, as after a crash between landing and its commit: also once its files are merged.
    run, again = run_id(spark, checkpoint), parse_messages(spark.read.text(f"{source}/b"), PGW)
    assert land_batch(again, 1, root, run) is None
    gone, come = compact_landed(spark, root, PGW, "20200101")
    assert gone > come >= 1 and landed() == after
    assert land_batch(again, 1, root, run) is None and landed() == after
    assert landed(("20200101", "10", "05")) == [("05", "m3")] and landed(("20200101", "11", "05")) == []
    assert landed(("-1", "-1", "-1")) == [("-1", "-1")]
    # The checkpoint is lost; the new run's batch 0 adds to the old five minutes.
    put(f"{tmp_path}/new", "c", at("10:02:00", "after"))
    start_landing(spark.readStream.text(f"{tmp_path}/new"), PGW, root, f"{tmp_path}/cp2", seconds=None).awaitTermination()
    assert landed() == sorted([*after, ("00", "after")])


def test_offsets_land_with_their_batch(spark, tmp_path):
    def batch(part, *numbers):
        data = [(at("10:01:00"), "t", part, n) for n in numbers]
        raw = spark.createDataFrame(data, "value string, topic string, partition int, offset long")
        return parse_messages(raw, PGW, kept=PLACE)

    root = f"{tmp_path}/out"
    land_batch(batch(0, *range(10)).unionByName(batch(1, 5, 6, 9)), 0, root, "r")
    land_batch(batch(0, *range(10, 15), 3), 1, root, "r")
    land_batch(batch(0, *range(10, 15)), 1, root, "r")  # a replay
    land_batch(batch(0, 20).unionByName(batch(1, 7)), 2, root, "r")
    assert rows(read_offsets(spark, root)) == [("t", 0, 0, 15, 16), ("t", 0, 20, 21, 1), ("t", 1, 5, 8, 3), ("t", 1, 9, 10, 1)]
    assert read_landed(spark, root, PGW).count() == 13 + 6 + 2
    ends = ranges.resume_at(
        spark.createDataFrame([("t", p) for p in (0, 1, 2)], "topic string, part int"), read_offsets(spark, root), ["topic", "part"]
    )
    assert rows(ends) == [("t", 0, 21, 15), ("t", 1, 10, 8), ("t", 2, 0, 0)]


def test_statistics_count_late_records_and_the_newest_ones(spark, tmp_path):
    schema = "mdn string, cause string, d string, h string, m5 string"
    by = spark.createDataFrame([], "cause string").schema
    root = f"{tmp_path}/stat"

    def frame_of(*data):
        rows = [(mdn, cause, "20200101", time[:2], f"{int(time[2:]) // 5 * 5:02d}") for mdn, cause, time in data]
        return spark.createDataFrame(rows, schema)

    def kept(*wanted):
        return rows(read_statistics(spark, root, by, list(wanted) or None).select("h", "m5", "cause", "session_cnt", "mdn_cnt"))

    def drain(*data):
        frame_of(*data).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        start_statistics(stream, root, f"{tmp_path}/cp", ["cause"], "mdn", seconds=None).awaitTermination()
        return kept()

    first = [("m1", "x", "1001"), ("m1", "x", "1002"), ("m2", "x", "1007"), ("m1", "y", "2359"), (None, None, "1001")]
    assert drain(*first) == [
        ("10", "00", "x", 2, 1), ("10", "00", None, 1, 0), ("10", "05", "x", 1, 1), ("23", "55", "y", 1, 1)
    ]
    want = [
        ("10", "00", "x", 4, 2), ("10", "00", None, 1, 0), ("10", "05", "x", 1, 1), ("11", "00", "x", 1, 1), ("23", "55", "y", 1, 1)
    ]
    second = [("m3", "x", "1004"), ("m1", "x", "1003"), ("m1", "x", "1100")]
    assert drain(*second) == want
    assert add_statistics(frame_of(*second), 1, root, run_id(spark, f"{tmp_path}/cp"), ["cause"], "mdn") is None
    compact_statistics(spark, root, frame_of().schema, ["cause"], "mdn")
    assert kept() == want and kept(("20200101", "11", "00")) == [("11", "00", "x", 1, 1)]
    want[0] = ("10", "00", "x", 6, 3)
    assert drain(("m3", "x", "1000"), ("m9", "x", "1000")) == want


def test_statistics_read_the_files_of_the_touched_minutes_only(spark, tmp_path):
    root, schema = f"{tmp_path}/stat", "mdn string, cause string, d string, h string, m5 string"
    for i in range(4):
        add_statistics(spark.createDataFrame([("m1", "x", "20200101", f"1{i}", "00")], schema), i, root, "r", ["cause"], "mdn")
    files = live_files(spark, root, "numbers")
    assert files.count() == 4
    assert len(matching_files(files, ["20200101/12/00"])) == 1
    assert len(matching_files(files, ["20200101/12/00", "20200101/13/05", "20200101/10/00"])) == 2
    assert matching_files(files, []) == []


def test_offset_rows():
    sources = [{"startOffset": {"t": {"0": 5, "1": 7}}, "endOffset": json.dumps({"t": {"0": 9, "1": 7, "2": 3}})}]
    got = list(ledger_rows(sources, "g", 4, 12))
    assert got == [("t", "g", 0, 4, 5, 9, 12), ("t", "g", 1, 4, 7, 7, 12), ("t", "g", 2, 4, 0, 3, 12)]
    assert list(ledger_rows([{"endOffset": "x"}, {"endOffset": None}], "g", 1, 1)) == []


def test_listener_keeps_a_ledger(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"{tmp_path}/ledger"
    listener = OffsetLedger(spark, root, "grp")
    spark.streams.addListener(listener)
    try:
        for name in ("a", "b"):
            put(source, name, at("10:01:00"))
            start_landing(spark.readStream.text(source), PGW, f"{tmp_path}/out", f"{tmp_path}/cp", seconds=None).awaitTermination()
        for _ in range(100):
            if os.path.exists(root) and spark.read.schema(LEDGER).parquet(root).count() >= 2:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    history = spark.read.schema(LEDGER).parquet(root)
    got = [(r["topic"], r["batch"], r["p_until"], r["p_delta"]) for r in offset_gaps(history).orderBy("batch").collect()]
    assert got == [("files", 0, 1, 0), ("files", 1, 2, 0)]


def test_windowed_sessions_agree_with_landed_ones(spark, tmp_path):
    data = [(f"2020-01-01 10:{m:02d}:00", "a" if m % 3 else "b", f"m{m % 4}") for m in range(0, 30)]
    df = spark.createDataFrame(data, "t string, cause string, mdn string").selectExpr("to_timestamp(t) as ts", "cause", "mdn")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    stats = windowed_sessions(stream, "ts", ["cause"], "mdn", late="0 seconds")
    query = stats.writeStream.outputMode("append").format("memory").queryName("w").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = df.selectExpr("date_format(ts, 'yyyyMMdd') as d", "date_format(ts, 'HH') as h",
                          "lpad(cast(floor(minute(ts) / 5) * 5 as string), 2, '0') as m5", "cause", "mdn")
    exact = {(r["m5"], r["cause"]): (r["session_cnt"], r["mdn_cnt"]) for r in landed_sessions(batch, ["cause"], "mdn").collect()}
    streamed = {(r["window_start"].strftime("%M"), r["cause"]): (r["session_cnt"], r["mdn_cnt"]) for r in spark.table("w").collect()}
    assert streamed and all(exact[k] == v for k, v in streamed.items())
    assert len(rows(spark.table("w"))) >= len(exact) - 2  # the newest window is still open
