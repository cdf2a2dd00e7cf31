"""How far feeds are complete, held against a walk over the slices one by one."""

from datetime import datetime, timedelta

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from probelake.operators import frontier

START = datetime(2024, 1, 31, 22)


def at(minutes, digits=12):
    return (START + timedelta(minutes=minutes)).strftime("%Y%m%d%H%M")[:digits]


def walked(slices, step):
    covered = set()
    for s in slices:
        begin = int((datetime.strptime(s, "%Y%m%d%H%M" if len(s) == 12 else "%Y%m%d%H") - START).total_seconds()) // 60
        covered |= set(range(begin, begin + (60 if len(s) == 10 else step)))
    until = next(m for m in range(10_000) if m not in covered)
    newest = max([0, *(m + 1 for m in covered if m >= 0)])
    return at(until), at(newest), newest - len([m for m in covered if m >= 0])


def test_feeds_with_gaps_hours_and_late_slices(spark):
    slices = {
        "whole": [at(10 * i) for i in range(30)], "hours": [at(60 * i, 10) for i in range(5)],
        "gap": [at(10 * i) for i in range(30) if i not in (7, 8, 20)], "mixed": [at(0, 10), *[at(60 + 10 * i) for i in range(9)]],
        "before": [at(-10 * i) for i in range(1, 4)], "overlap": [at(0, 10), at(30), at(90), at(60, 10)], "other": ["x", "2024", None, at(0)],
    }
    done = spark.createDataFrame([(f, s) for f, own in slices.items() for s in [*own, *own[:2]]], "feed string, slice string")
    feeds = [*slices, "absent"]
    got = {r[0]: tuple(r)[1:] for r in frontier.frontiers(done, feeds, at(0), step=10).collect()}
    want = {f: walked([s for s in own if s and len(s) >= 10], 10) for f, own in {**slices, "absent": []}.items()}
    assert got == want
    assert {f: got[f][2] for f in ("whole", "gap", "absent")} == {"whole": 0, "gap": 30, "absent": 0}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 60)))
def test_any_set_of_slices(spark, numbers):
    slices = [at(5 * i) for i in numbers]
    done = spark.createDataFrame([("f", s) for s in slices], "feed string, slice string")
    assert rows(frontier.frontiers(done, ["f"], at(0))) == [("f", *walked(slices, 5))]


def test_a_day_opens_when_all_feeds_have_the_hour_after_it(spark):
    hours = lambda feed, n: [(feed, at(120 + 60 * i, 10)) for i in range(n)]
    done = spark.createDataFrame([*hours("a", 60), *hours("b", 24), *hours("c", 25)], "feed string, slice string")
    days = spark.createDataFrame([("20240201",), ("20240202",), ("20240203",)], "day string")
    front = frontier.frontiers(done, ["a", "b", "c"], "20240201")
    assert rows(frontier.open_days(front, ["a", "b", "c"], days)) == [
        ("20240201", False, "b"), ("20240202", False, "b,c"), ("20240203", False, "a,b,c")
    ]
    assert rows(frontier.open_days(front, ["a", "b", "c"], days, late_hours=0))[0] == ("20240201", True, "")
    assert frontier.is_open(done, ["a", "c"], "20240201") == (True, "")
    assert frontier.is_open(done, ["a", "b", "absent"], "20240201") == (False, "absent,b")
