import itertools

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from probelake.functions.times import day_start_millis
from probelake.operators import enrich, kpi
from probelake.operators.kpi import Measure
from probelake.operators.lists import joined_lists
from probelake.operators.reports import Section, aligned, chained
from probelake.plans import audit, devices, labels, quality, rates, sessions
from probelake.session import fits_broadcast

COAP = (
    "MSISDN string, eNB_ID string, APN string, ProcedureType string, Direction string, Status string,"
    " FirstRequestTime string, AckTime string, SGWIP string, DestinationIP string, AppServerIP string,"
    " Roma_Province string"
)


@pytest.fixture(scope="module")
def coap(spark):
    data = []
    for i, (kind, way, status, apn) in enumerate(
        itertools.product("123", "12", ["0", "1", "2", "", None, "x"], ["a.ctnb.b", "net", None])
    ):
        number = "hot" if i % 3 else f"m{i % 7}"
        data.append(
            (number, f"e{i % 4}", apn, kind, way, status, str(i), "" if i % 5 == 0 else str(i * 3), f"g{i % 3}",
             f"10.0.0.{i % 3}", f"s{i % 2}", f"p{i % 4}" if i % 9 else None)
        )
    return spark.createDataFrame(data, COAP)


@pytest.fixture(scope="module")
def sites(spark):
    # e1 twice: rows multiply; e3 missing.
    return spark.createDataFrame(
        [("e0", "P0", "C0"), ("e1", "P1", "C1"), ("e1", "P1", "C2"), ("e2", None, "C3")],
        "enbid string, provName string, cityName string",
    )


@pytest.fixture(scope="module")
def crm(spark):
    return spark.createDataFrame([("hot", "c1"), ("m1", "c1"), ("m2", "c2"), ("m3", "c3")], "mdn string, custid string")


def test_con_non_counts_the_same_folded_or_not(coap, sites, crm):
    direct = rates.con_non_daily(coap, sites, crm, "d", prefold=False)
    folded = rates.con_non_daily(coap, sites, crm, "d", prefold=True)
    automatic = rates.con_non_daily(coap, sites, crm, "d")
    assert rows(direct) == rows(folded) == rows(automatic)
    by_network = {r["networktype"]: r for r in automatic.groupBy("networktype").agg(F.sum("upConcnt").alias("n")).collect()}
    assert set(by_network) == {"NB", "4G"}


def test_con_non_status_text_and_blank_do_not_count(frame, sites, crm):
    coap = frame(COAP, *[("m1", "e0", "x.ctnb", "1", "1", s, "", "", "", "", "", "") for s in ("0", "2", "1", "", None, "x")])
    row = rates.con_non_daily(coap, sites, crm, "d").first()
    assert (row["upConcnt"], row["upConSucccnt"], row["upConRate"], row["downConRate"]) == (6, 2, 33.33, None)


def test_large_dimensions_are_not_broadcast_and_facts_are_folded_first(spark, coap, sites, crm):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not fits_broadcast(crm)
        df = rates.con_non_daily(coap, sites, crm, "d")
        text = plan(df)
        want = rows(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    assert text.rindex("HashAggregate") > text.rindex("SortMergeJoin")
    assert want == rows(rates.con_non_daily(coap, sites, crm, "d"))


def test_size_check_measures_joined_dimensions(spark):
    small = spark.range(50).withColumnRenamed("id", "a")
    assert fits_broadcast(small.join(spark.range(50), F.col("a") == F.col("id")))
    far = spark.range(100_000_000_000)
    assert not fits_broadcast(far.join(small, F.col("a") == F.col("id")))  # not even measured
    wide = spark.range(3_000_000).withColumn("t", F.repeat(F.lit("x"), 20))
    assert not fits_broadcast(wide.join(small, F.col("a") == F.col("id"), "left"))


def test_customer_rates_equal_separate_aggregates(coap, crm):
    renamed = crm.withColumnRenamed("custid", "cust_id")
    got = {(r["cust_id"], r["gather_type"]): r["gather_value"] for r in rates.customer_rates(coap, renamed, ["c1", "c2"], "d").collect()}
    facts = coap.where("APN like '%ctnb%' and ProcedureType = '1'").join(renamed, F.col("MSISDN") == F.col("mdn"))
    for way, label in (("1", labels.COAP_UP_RATE), ("2", labels.COAP_DOWN_RATE)):
        for cust in ("c1", "c2"):
            mine = facts.where((F.col("cust_id") == cust) & (F.col("Direction") == way))
            n = mine.count()
            want = round(mine.where("Status in ('0', '2')").count() * 100 / n, 2) if n else None
            assert got.get((cust, label)) == want
    assert not [k for k in got if k[0] == "c3"]


def test_province_rates_equal_joined_aggregates(coap, frame):
    names = frame("Roma_Province string, PROVNAME string", ("p0", "N0"), ("p1", "N1"), ("p9", "N9"))
    got = {(r["DATATYPE"], r["PRODTYPE"]): r["USERNUM"] for r in rates.coap_province_rates(coap, names, "t").collect()}
    up = coap.where("ProcedureType = '1' and Direction = '1'")
    every = up.groupBy("Roma_Province").agg(F.count("*").alias("alls"))
    good = up.where("Status in ('0', '2')").groupBy("Roma_Province").agg(F.count("*").alias("succ"))
    joined = good.join(every, "Roma_Province").join(names, "Roma_Province")
    want = {(labels.COAP_UP_RATE, r["PROVNAME"]): r["succ"] / r["alls"] * 100 for r in joined.collect()}
    mine = {k: v for k, v in got.items() if k[0] == labels.COAP_UP_RATE and k[1] != labels.NATIONAL}
    assert mine == pytest.approx(want)
    n, ok = up.count(), up.where("Status in ('0', '2')").count()
    # The total counts provinces without a name, too.
    assert got[(labels.COAP_UP_RATE, labels.NATIONAL)] == pytest.approx(ok * 100 / n)


def test_a_province_without_success_is_left_out(frame):
    s5s8 = frame("Procedure_Type string, Procedure_Status string, Roma_Province string",
                 ("3", "1", "p0"), ("3", "0", "p1"), ("3", "1", "p1"), ("2", "0", "p0"), ("", "0", "p0"), ("3", "0", None))
    names = frame("Roma_Province string, PROVNAME string", ("p0", "N0"), ("p1", "N1"))
    got = {r["PRODTYPE"]: r["USERNUM"] for r in rates.bearer_setup_rate(s5s8, names, "t").collect()}
    assert got == {"N1": 50.0, labels.NATIONAL: 50.0}


def test_location_update_by_host_code(frame):
    s6a = frame("Origin_Host string, Procedure_Type string, Procedure_Status string",
                ("mme123456789AA.x", "1", "0"), ("mme123456789AA.x", "1", "5"), ("hss123456789AA.x", "1", "0"),
                ("mme123456789BB.x", "1", "0"))
    hosts = frame("origin string, PROVNAME string", ("AA", "N0"))
    got = {r["PRODTYPE"]: r["USERNUM"] for r in rates.location_update_rate(s6a, hosts, "t").collect()}
    assert got["N0"] == 50.0 and got[labels.NATIONAL] == pytest.approx(200 / 3)


def test_create_session_counts_unknown_gateways(frame):
    s5s8 = frame("APN string, Procedure_Status string, Procedure_Type string, SGW_IP_Add string",
                 ("a.ctnb", "0", "3", "g1"), ("a.ctnb", "0", "3", "g2"), ("a.ctnb", "0", "3", None), ("net", "0", "3", "g1"))
    gateways = frame("SGSNIPAddress string, PROVNAME string", ("g1", "N1"))
    for prefold in (None, True, False):
        got = {r["PRODTYPE"]: r["USERNUM"] for r in rates.create_session_counts(s5s8, gateways, "t", prefold).collect()}
        assert got == {"N1": 1, labels.UNKNOWN: 2}


def test_offline_sessions(frame):
    radius = frame(
        "mdn string, sid string, bsid string, status string, apn string, terminatecause string",
        ("m1", "s1", "e1", "Stop", "net", "a"), ("m1", "s1", "e1", "Stop", "net", "a"), ("m2", "s1", "e1", "Stop", "x.ctnb", "a"),
        ("m2", "s1", "e1", "Start", "net", "a"), ("m1", "s1", "e1", "Stop", None, "a"), ("m3", "s1", "e1", "Stop", "net", "a"),
        ("m1", "s9", "e9", "Stop", "net", "a"), ("m2", "s1", "e1", "Stop", "net", "a"),
    )
    crm = frame("mdn string, cust_id string", ("m1", "c"), ("m2", "c"))
    sites = frame("enbid string, sid string, provName string, cityName string", ("e1", "s1", None, "C"))
    for prefold in (None, True, False):
        def stat(network):
            return [tuple(r)[1:] for r in sessions.offline_stats(radius, crm, sites, network, "t", prefold).collect()]

        assert stat("4g") == [("c", "-1", "C", "a", 3, 2)]
        assert stat("nb") == [("c", "-1", "C", "a", 1, 1)]
        assert stat("3g") == [("c", "-1", "C", "a", 5, 2)]
    assert set(sessions.all_offline_stats(radius, radius, crm, sites, sites, "t")) == {"3g", "4g", "nb"}


def test_five_counters_equal_five_joined_aggregates(coap, frame):
    ids = frame("MDN string", "hot", "m1", "hot")
    gateways = frame("SGSNIPAddress string, PROVNAME string", ("g0", "N0"), ("g1", "N1"))
    got = devices.subscriber_counters(coap, ids, gateways, "s1", "d")
    base = (
        coap.where("AppServerIP = 's1'").join(gateways, F.col("SGWIP") == F.col("SGSNIPAddress"), "left")
        .where(F.col("MSISDN").isin("hot", "m1"))
    )
    conditions = {
        "upcons": "ProcedureType = '1' and Direction = '1'", "upnons": "ProcedureType = '2' and Direction = '1'",
        "downcons": "ProcedureType = '1' and Direction = '2'",
        "downconSucc": "ProcedureType = '1' and Direction = '2' and Status in ('0', '2')",
        "downnons": "ProcedureType = '2' and Direction = '2'",
    }
    want = None
    for name, condition in conditions.items():
        part = base.where(condition).groupBy("MSISDN", "PROVNAME").agg(F.count("*").alias(name))
        want = part if want is None else want.join(part, ["MSISDN", "PROVNAME"])
    assert rows(got.drop("whichDay")) == rows(want) and got.count() > 0


def test_id_lists_too_large_to_broadcast_change_nothing(spark, coap, frame):
    ids, gateways = frame("MDN string", "hot", "m1", "hot"), frame("SGSNIPAddress string, PROVNAME string", ("g0", "N0"))
    named = ids.withColumnRenamed("MDN", "mdn").distinct()

    def results():
        return (
            rows(devices.subscriber_counters(coap, ids, gateways, "s1", "d")),
            rows(devices.outside_addresses(coap, named, "10.0.0.0")),
            rows(quality.quality_sheet(*quality_inputs(frame), "c", "t")),
        )

    small = results()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert results() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_new_gateways_keep_a_null(frame):
    seen = frame("SGW_IP_Add string", "a", "a", "b", None)
    known = frame("SGW_IP_Add string", "b", "z")
    got = devices.new_gateways(seen, known, "d")
    assert rows(got) == [("d", "a"), ("d", None)]
    by_outer = seen.distinct().join(known.withColumnRenamed("SGW_IP_Add", "k"), F.col("SGW_IP_Add") == F.col("k"), "left").where("k is null")
    assert got.count() == by_outer.count()


def test_outside_addresses_have_one_shape_at_any_size(frame):
    data = [("hot", "x.ctnb", f"10.0.0.{i % 5}") for i in range(100)] + [("m1", "x.ctnb", "10.9.9.9"), ("m1", "net", "z")]
    coap = frame("MSISDN string, APN string, DestinationIP string", *data)
    ids = frame("mdn string", "hot", "m1", "m2")
    got = devices.outside_addresses(coap, ids, "10.0.0.0")
    assert rows(got) == [*(("hot", f"10.0.0.{i}", 20) for i in range(1, 5)), ("m1", "10.9.9.9", 1)]
    text = ",".join(sorted(ip for _, _, ip in data[:100] if ip != "10.0.0.0"))
    assert rows(joined_lists(got, "mdn", "DestinationIP", "ips")) == [("hot", text), ("m1", "10.9.9.9")]


S5S8 = "MSISDN string, Procedure_Type string, Procedure_Status string"


def quality_inputs(frame):
    s5s8 = frame(S5S8, ("a", "3", "0"), ("a", "3", "1"), ("a", "2", "1"), ("b", "2", "0"), ("b", "2", ""), ("c", "1", "0"),
                 ("d", "3", None), ("x", "3", "0"))
    coap = frame("MSISDN string, ProcedureType string, Direction string, Status string",
                 ("a", "1", "1", "0"), ("a", "1", "2", "1"), ("b", "1", "1", "2"), ("b", "2", "2", "1"), ("e", "2", "1", "x"), ("c", "3", "1", "0"))
    return s5s8, coap, frame("mdn string", "a", "b", "c", "d", "e", "a")


def test_quality_sheet_equals_chained_full_joins(frame):
    s5s8, coap, ids = quality_inputs(frame)

    def signalling(kind, total, fails, key):
        return s5s8.where((F.col("Procedure_Type") == kind) & (F.col("MSISDN") != "x")).groupBy(F.col("MSISDN").alias(key)).agg(
            F.count("*").alias(total), F.sum(F.expr("case when Procedure_Status != '0' then 1 else 0 end")).alias(fails))

    def exchanges(kind, names, key):
        up, up_f, down, down_f = names
        bad = "Status != '0' and Status != '2'"
        return coap.where(F.col("ProcedureType") == kind).groupBy(F.col("MSISDN").alias(key)).agg(
            *[F.sum(F.expr(f"case when {c} then 1 else 0 end")).alias(n) for n, c in (
                (up, "Direction = '1'"), (up_f, f"Direction = '1' and {bad}"), (down, "Direction = '2'"), (down_f, f"Direction = '2' and {bad}"))])

    a, b = signalling("3", "alls", "fails", "mdn"), signalling("2", "all_cnt", "fail_cnt", "mdn1")
    c = exchanges("1", ("upcnt", "up_fail_cnt", "down_cnt", "down_fail_cnt"), "mdn2")
    d = exchanges("2", ("up1_cnt", "up1_fail_cnt", "down1_cnt", "down1_fail_cnt"), "mdn3")
    want = (
        a.join(b, F.col("mdn") == F.col("mdn1"), "full").join(c, F.col("mdn") == F.col("mdn2"), "full")
        .join(d, F.col("mdn") == F.col("mdn3"), "full")
    )
    got = quality.quality_sheet(s5s8, coap, ids, "c", "t")
    assert rows(got.drop("datatime", "cust_id")) == rows(want)
    one_each = quality.quality_sheet(s5s8, coap, ids, "c", "t", align=True)
    assert sorted(r["MSISDN"] for r in one_each.collect()) == ["a", "b", "d", "e"]


def test_sections_without_rows_are_null(frame):
    df = frame("k string, n1 long, x long, n2 long, y long", ("a", 1, 5, 0, 0), ("b", 0, 0, 2, 7), ("c", 0, 0, 0, 0))
    sections = [Section("k1", ("x",), "n1"), Section("k2", ("y",), "n2")]
    assert rows(chained(df, "k", sections)) == rows(df.sparkSession.createDataFrame([("a", 5, None, None), (None, None, "b", 7)], "k1 string, x long, k2 string, y long"))
    assert rows(aligned(df, "k", sections)) == [("a", 5, None), ("b", None, 7), ("c", None, None)]


TRAFFIC = "PGWIP string, MSISDN string, APN string, StartTime string, OutputOctets string, InputOctets string"


def test_reconciliation_of_traffic(frame):
    feed = frame(
        TRAFFIC,
        ("10.1.0.1", "m1", "nb.x", "2019010112", "5", "0"), ("10.1.0.1", "m1", "nb.x", "2019010112", "5", ""),
        ("10.1.0.2", "m2", "nb.x", "20190101", "5", "5"),  # the bound itself is outside
        ("10.1.0.2", "m2", "nb.x", "2019010200", "5", "5"), ("10.1.0.2", "m2", "x", "2019010112", "5", "5"),
        ("10.1.0.3", "m3", "nb.x", "2019010123", "0", "7"), ("10.1.0.3", "m4", "nb.x", "2019010123", "0", ""),
    )
    late = frame(TRAFFIC, ("10.1.0.1", "m5", "nb.x", "2019010123595", "1", "1"))  # landed on the next day
    sets = {"PGW1": "10.1.", "PGW2": "10.2."}
    got = audit.recon_traffic([feed, late], sets, "nb", "20190101", "20190102")
    assert rows(got) == [
        ("20190101", "COAP", "PGW1", 3, 11.0, 8.0, 19.0),
        ("20190101", "COAP", "PGW2", 0, 0.0, 0.0, 0.0),  # a set without traffic still has its row
    ]
    s5s8 = frame(
        "APN string, PGW_IP_Add string, Procedure_Start_Time string, Result_Code string, Procedure_Type string,"
        " Procedure_Status string, MSISDN string",
        *[("ctnb", "10.1.0.1", "1546300800001", code, "3", "0", m) for code, m in (("16", "a"), ("17", "a"), ("20", "b"), ("19", None))],
    )
    bearers = audit.recon_bearers(
        s5s8, sets, "ctnb", day_start_millis(F.lit("20190101")), day_start_millis(F.lit("20190102")), ["16", "17", "18", "19"], "20190101"
    )
    assert rows(bearers)[0][3:5] == (2, 3.0)
    checklist = frame("filename string, filedir string", ("S1u-1", "x"), ("S1u-2", "x"), ("S5s8-1", "x"))
    expected = audit.expected_files(checklist, {"A": "S1u-", "B": "S5s8-", "C": "none"}, "20190101")
    assert {r["CHECKTYPE"]: r["USERNUM"] for r in expected.collect()} == {"A": 2, "B": 1, "C": 0}
    listing = frame("path string, length long", ("/in/S1u/x-20190101-1", 1), ("/in/S1u/x-20190102-1", 1))
    received = audit.received_files(listing, {"R": "/S1u/"}, "20190101")
    table = audit.reconciliation(got, bearers, expected, received)
    assert table.count() == 8 and table.columns == list(audit.AUDIT_COLUMNS)


def test_http_lines(frame):
    def line(n=100, **at):
        fields = [""] * n
        for i, v in at.items():
            fields[int(i[1:])] = v
        return "|".join(fields)

    lines = frame("value string", line(f2="m", f75="302"), line(f2="m", f75="200"), line(f2="m"), line(99, f2="m", f75="302"))
    assert [r["HttpStatus"] for r in audit.http_status_extract(lines).orderBy("HttpStatus").collect()] == ["", "302"]
    probe = frame("value string", line(f1="861", f2="n861", f69="h", f67="/u"), line(f1="861", f2="n861", f69="h", f67="/u"),
                  line(f1="862", f2="", f69="h"), line(f2="other"), line(30, f2="861"))
    got = audit.probe_audit(probe, ["861", "862"]).collect()
    assert len(got) == 1 and got[0]["DestinationURL"] == "h/u"


def test_gateway_sets(coap, frame):
    row = audit.gateway_down_counts(coap, ["g0", "g2"]).first()
    down = coap.where("SGWIP in ('g0', 'g2') and ProcedureType = '1' and Direction = '2'")
    assert tuple(row) == (down.count(), down.where("Status in ('0', '2')").count())
    s5s8 = frame("RAT string, Procedure_Status string, SGW_IP_Add string", ("8", "0", "a"), ("8", "1", "a"), ("6", "0", "a"), ("8", "0", "z"))
    assert rows(audit.gateway_session_counts(s5s8, ["a", "b"])) == [("a", 1)]


def test_totals_and_distinct_with_null(frame):
    df = frame("g string, v string", ("a", "x"), ("a", "y"), (None, "x"), ("b", None))
    groups = kpi.count_by(df, ["g"], [Measure("n")])
    got = {(r["g"], r["is_total"]): r["n"] for r in kpi.with_total(groups, "g", [Measure("n")], "ALL").collect()}
    assert got == {("a", False): 2, (None, False): 1, ("b", False): 1, ("ALL", True): 4}
    assert df.agg(kpi.distinct_with_null(F.col("v"))).first()[0] == df.dropDuplicates(["v"]).count()


def test_network_tag_and_duplicates(frame):
    df = frame("apn string", "a.ctnb.b", "net", None, "")
    assert [r[0] for r in df.select(enrich.tag_network(F.col("apn"))).collect()] == ["NB", "4G", None, "4G"]
    dim = frame("k string", "a", "a", "b")
    assert rows(enrich.duplicated_keys(dim, "k")) == [("a", 2)]
    facts = frame("f string", "a", "b", "a")
    assert enrich.only_listed(facts, dim, "f", "k").count() == 3
