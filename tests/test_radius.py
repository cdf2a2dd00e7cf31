import json

import pytest
from conftest import plan

from probelake.functions.radius import HA, PGW, bad_rows, parse_messages


def message(layout, drop=(), **change):
    body = {k: f"{k}-v" for k in layout.keys}
    body.update(Status="Stop", StopTime="2018-12-28 13:59:05")
    for key, _ in layout.on_stop:
        body[key] = "cont"
    body.update(change)
    return json.dumps({k: v for k, v in body.items() if k not in drop})


def parse(frame, layout, text):
    return parse_messages(frame("value string", text), layout).first()


def test_layout_widths():
    assert len(HA.columns) == 27 and len(PGW.columns) == 24


@pytest.mark.parametrize("layout", [HA, PGW])
def test_stop_and_start(frame, layout):
    stop = parse(frame, layout, message(layout))
    assert (stop["mdn"], stop["radiustime"]) == ("MDN-v", "2018-12-28 13:59:05")
    assert (stop["d"], stop["h"], stop["m5"]) == ("20181228", "13", "55")
    begin = {k: "b" for k, _ in layout.on_start}
    start = parse(frame, layout, message(layout, drop=("StopTime", "SessionContinue"), Status="Start",
                                         StartTime="2018-12-28 13:07:05", **begin))
    assert (start["status"], start["m5"]) == ("Start", "05")
    if layout is HA:
        assert (stop["beginSession"], stop["sessioncontinue"]) == ("", "cont")
        assert (start["beginSession"], start["sessioncontinue"]) == ("b", "")


@pytest.mark.parametrize("layout", [HA, PGW])
@pytest.mark.parametrize(
    ("make", "code"),
    [
        (lambda m, lay: "[1]", "1"),
        (lambda m, lay: "3", "1"),
        (lambda m, lay: "nope", "1"),
        (lambda m, lay: "", "1"),
        (lambda m, lay: "{}", "0"),
        (lambda m, lay: m(lay, drop=("MDN",)), "0"),
        (lambda m, lay: m(lay, drop=("StopTime",)), "0"),
        (lambda m, lay: m(lay, Duration=3), "0"),
        (lambda m, lay: m(lay, MDN={"MDN": "x"}), "0"),
        (lambda m, lay: m(lay, drop=("MDN",), extra={"MDN": "x"}), "0"),
        (lambda m, lay: m(lay, StopTime="2018"), "0"),
        (lambda m, lay: m(lay, StopTime="2018-12-28 13:5x:05"), "0"),
        (lambda m, lay: m(lay, StopTime=None), "0"),
        (lambda m, lay: m(lay, drop=("MDN",), **{"a, MDN: STRING, b": "x"}), "0"),
    ],
)
def test_unusable_messages_keep_their_text(frame, layout, make, code):
    text = make(message, layout)
    df = parse_messages(frame("value string", text), layout)
    row = df.first()
    assert row[0] == code and row["radiustime"] == text
    assert {row[c] for c in layout.columns[1:] if c != "radiustime"} == {"-1"}
    assert bad_rows(df, layout).count() == 1


def test_extra_keys_nested_values_and_nulls_are_fine(frame):
    assert parse(frame, PGW, message(PGW, more="x"))["apn"] == "APN-v"
    assert parse(frame, PGW, message(PGW, more=[{"MDN": 1}], BSID=None))["bsid"] is None
    assert parse(frame, PGW, message(PGW, **{"odd key": 1}))["apn"] == "APN-v"


def test_a_filter_does_not_parse_again(frame):
    df = parse_messages(frame("value string", message(PGW)), PGW).where("m5 <> '-1' and mdn = 'x' and h = '13'")
    assert plan(df).count("parseJson") == 1
