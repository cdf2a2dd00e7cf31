import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from probelake.functions import parsing as P
from probelake.functions import scalars as S
from probelake.functions import times
from probelake.sources.feeds import FEEDS, fill_missing, parse_lines, pick_fields, publication, rejected_lines

WIDTHS = {
    "http_early": 49, "s1mme": 41, "s5s8_early": 45, "s6a_early": 40, "gx": 18, "l2tp": 30, "s2a": 23, "s5s8": 31,
    "s6a": 28, "s1u": 64, "http": 98, "http_100": 100, "coap": 84, "coap_82": 82, "mqtt": 89, "mqtt_87": 87,
}


@pytest.mark.parametrize("name", WIDTHS)
def test_layout_has_its_columns_once(name):
    columns = FEEDS[name].output_columns
    assert len(columns) == WIDTHS[name] == len(set(columns))


@pytest.mark.parametrize("name", [n for n in WIDTHS if n not in ("s5s8_early",)])
def test_required_fields_decide(frame, name):
    feed = FEEDS[name]
    exact = "|".join(f"v{i}" for i in range(feed.required))
    short = "|".join(f"v{i}" for i in range(feed.required - 1))
    lines = frame("value string", exact, short, "", "x")
    got = parse_lines(lines, feed).collect()
    assert len(got) == 1
    for i, column in enumerate(feed.columns):
        if column in feed.ints:
            assert got[0][column] == 0
        else:
            assert got[0][column] == (f"v{i}" if i < feed.required else "-1")
    assert rejected_lines(lines, feed).count() == 3


def test_trailing_empty_fields_are_kept_or_dropped(frame):
    lines = frame("value string", "a|b||", "a", "")
    kept = [r[0] for r in lines.select(P.split_keep(F.col("value"))).collect()]
    dropped = [r[0] for r in lines.select(P.split_drop(F.col("value"))).collect()]
    assert kept == [["a", "b", "", ""], ["a"], [""]]
    assert dropped == [["a", "b"], ["a"], [""]]


@pytest.mark.parametrize(
    ("tail", "count", "plain", "leading"),
    [
        ([], 0, "", ""),
        (["3"], 3, "3", "-3"),
        (list("2bcdefgh"), 2, "2,b,c,d,e,f,g,h", "-2,b,c,d,e,f,g,h"),
        (list("2bcdefghi"), 2, "2,b,c,d,e,f,g,h-i", "-2,b,c,d,e,f,g,h-i"),
        (list("xbcdefghijklmnopq"), 0, "x,b,c,d,e,f,g,h-i,j,k,l,m,n,o,p-q", "-x,b,c,d,e,f,g,h-i,j,k,l,m,n,o,p-q"),
    ],
)
def test_variable_tail(frame, tail, count, plain, leading):
    lines = frame("value string", "|".join(["f"] * 29 + tail))
    row = parse_lines(lines, FEEDS["s5s8"]).first()
    assert (row["EPS_Bearer_Number"], row["Bearer_Context"]) == (count, plain)
    assert parse_lines(lines, FEEDS["s5s8"], leading_separator=True).first()["Bearer_Context"] == leading


def test_nine_wide_tail(frame):
    line = "|".join(["f"] * 39 + [str(i) for i in range(1, 12)])
    row = parse_lines(frame("value string", line), FEEDS["s1mme"]).first()
    assert row["epsbearernumber"] == 1
    assert row["bearer_context"] == "1,2,3,4,5,6,7,8,9-10,11"


@pytest.mark.parametrize(
    ("count", "tail", "info", "home", "probe"),
    [
        ("0", ["H", "P"], "", "H", "P"),
        ("2", list("abcdefghijkl") + ["H", "P"], "a-b-c-d-e-f,g-h-i-j-k-l", "H", "P"),
        ("1", list("abcdef") + ["H", "P", "more"], "a-b-c-d-e-f", "H", "P"),
        ("9", list("abcdef") + ["H", "P"], "a-b-c-d-e-f", "H", "P"),
        ("text", ["H", "P"], "", "H", "P"),
        ("-1", ["H", "P"], "", "H", "P"),
    ],
)
def test_counted_tail(frame, count, tail, info, home, probe):
    fields = ["f"] * 42
    fields[19] = count
    row = parse_lines(frame("value string", "|".join(fields + tail)), FEEDS["s5s8_early"]).first()
    assert (row["bearerinfo"], row["home_province"], row["probeid"]) == (info, home, probe)


def test_counted_tail_without_the_columns_after_it_is_rejected(frame):
    fields = ["f"] * 42
    fields[19] = "1"
    lines = frame("value string", "|".join([*fields, *"abcdef", "H"]))
    assert parse_lines(lines, FEEDS["s5s8_early"]).count() == 0
    assert rejected_lines(lines, FEEDS["s5s8_early"]).first()["n_fields"] == 49


def test_early_s6a_gets_its_reversed_number_first(frame):
    line = "|".join(["861234" if i == 5 else f"v{i}" for i in range(39)])
    row = parse_lines(frame("value string", line), FEEDS["s6a_early"])
    assert row.columns[0] == "mdnReverse" and row.first()["mdnReverse"] == "432168"


def test_cut_publication_renames(frame):
    feed = FEEDS["s1u"]
    line = "|".join(f"v{i}" for i in range(64))
    cut = publication(parse_lines(frame("value string", line), feed), feed, "cut")
    row = cut.first()
    assert (row["DestinationType"], row["chargingID"]) == ("v18", "v19")
    assert "Interface" not in cut.columns and "XXX1" not in cut.columns


def test_mqtt_columns_are_not_shifted(frame):
    feed = FEEDS["mqtt_87"]
    row = parse_lines(frame("value string", "|".join(f"v{i}" for i in range(87))), feed).first()
    assert (row["Topic3_Name"], row["Message_Action"], row["Result"]) == ("v75", "v76", "v86")


def test_every_profile_selects_existing_columns(frame):
    for feed in FEEDS.values():
        for profile in feed.profiles:
            line = "|".join("f" for _ in range(feed.required + len(feed.after)))
            publication(parse_lines(frame("value string", line), feed), feed, profile).columns


def test_a_filter_on_parsed_columns_does_not_split_again(frame):
    lines = frame("value string", "|".join("f" * 18))
    filtered = parse_lines(lines, FEEDS["gx"]).where("length(MSISDN) > 0 and RAT = 'f' and Result_Code <> ''")
    assert plan(filtered).count("split(") == 1


def test_lenient_numbers(frame):
    texts = frame("t string", "12", "-3", "+4", " 5", "2.5", "", None, "x", "99999999999")
    got = [r[0] for r in texts.select(S.lenient_int("t")).collect()]
    assert got == [12, -3, 4, 0, 0, 0, 0, 0, 0]
    assert [r[0] for r in texts.select(S.equals_number("t", 12)).collect()][:1] == [True]
    assert [r[0] for r in texts.select(S.fill_blank("t")).collect()][5:7] == ["-1", "-1"]
    assert texts.where(S.above_zero("t")).count() == 5


def test_rates_of_nothing_are_null(frame):
    df = frame("ok long, n long", (1, 3), (0, 0))
    got = [tuple(r) for r in df.select(S.percent(F.col("ok"), F.col("n"), 2), S.quotient(F.col("ok"), F.col("n"))).collect()]
    assert got[0][0] == 33.33 and got[1] == (None, None)


def test_row_keys(frame):
    df = frame("m string, s string, e string", ("123", "a", "b"))
    assert df.select(S.spread_key(F.col("m"), F.col("s"), F.col("e"))).first()[0] == "321_a_b"
    assert df.select(S.spread_key(F.col("m"), F.col("s"), F.col("e"), sep="")).first()[0] == "321ab"


@pytest.mark.parametrize(("minute", "m5"), [("00", "00"), ("04", "00"), ("05", "05"), ("59", "55")])
def test_five_minute_floor(frame, minute, m5):
    text = f"2018-12-28 13:{minute}:07"
    by_text = frame("t string", text).select(*[c.alias(n) for n, c in times.m5_of_text(F.col("t")).items()]).first()
    ts = F.to_timestamp("t")
    by_time = frame("t string", text).select(*[c.alias(n) for n, c in times.m5_columns(ts).items()]).first()
    assert tuple(by_text) == tuple(by_time) == ("20181228", "13", m5)


def test_slice_times(frame):
    s = F.col("s")
    row = frame("s string", "201902281013").select(
        times.slice_day(s), times.slice_ten_minutes(s), times.slice_display(s), times.day_start_millis(times.slice_day(s))
    ).first()
    assert tuple(row) == ("20190228", "20190228101", "2019-02-28 10:10:00", 1551312000000)


def test_exact_arity_pick(frame):
    lines = frame("value string", "a|b|c", "a|b", "a|b|c|d")
    assert rows(pick_fields(lines, {"x": 2, "y": 0}, n_fields=3)) == [("c", "a")]
    assert rows(fill_missing(frame("a string, b string", (None, "x")))) == [("-1", "x")]
