"""The jobs end to end on files: lines in, result tables out."""

import os

import pytest
from conftest import rows
from test_radius import message
from pyspark.sql import functions as F

from probelake import run
from probelake.functions.radius import PGW
from probelake.plans import labels
from probelake.sinks import ledger
from probelake.sources.feeds import FEEDS
from probelake.sources.manifest import live_files
from probelake.streaming.landing import read_landed
from probelake.streaming.statistics import read_statistics


def line(feed, n=None, **values):
    layout = FEEDS[feed]
    fields = [values.get(c, "") for c in layout.columns][: n or len(layout.columns)]
    return "|".join(fields)


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two feeds landed from lines by the slice job, and the dimensions."""
    root = str(tmp_path_factory.mktemp("lake"))
    day = "20200101"
    coap = [
        line("coap", MSISDN=m, APN="x.ctnb", eNB_ID="e1", ProcedureType=k, Direction=w, Status=s, SGWIP="g1", PGWIP="10.1.0.1",
             AppServerIP="srv", DestinationIP=f"10.0.0.{i}", Roma_Province="p1", FirstRequestTime="10", AckTime="30",
             StartTime=f"{day}10", OutputOctets="5", InputOctets="7")
        for m in ("m1", "m2")
        for i, (k, w, s) in enumerate([("1", "1", "0"), ("1", "1", "1"), ("2", "1", "0"), ("1", "2", "2"), ("2", "2", "0")])
    ]
    s5s8 = [
        line("s5s8", MSISDN=m, APN="ctnb.x", Procedure_Type="3", Procedure_Status=s, SGW_IP_Add="g1", PGW_IP_Add="10.1.0.1",
             Roma_Province="p1", Result_Code="16", Procedure_Start_Time="1577880000000")
        for m, s in (("m1", "0"), ("m2", "1"), ("m3", "0"))
    ]
    s6a = [line("s6a", MSISDN="m1", Origin_Host="mme123456789AA", Procedure_Type="1", Procedure_Status="0")]
    for feed, data in (("coap", coap), ("s5s8", s5s8), ("s6a", s6a)):
        put(f"{root}/in/{feed}/{day}1000/x", *data)
        run.main(["slice", "--feed", feed, "--lines", f"{root}/in/{feed}", "--slice", f"{day}1000", "--out", f"{root}/{feed}",
                  "--done", f"{root}/done"], spark)
    spark.createDataFrame([("m1", "c1"), ("m2", "c2")], "mdn string, custid string").write.parquet(f"{root}/crm")
    spark.createDataFrame([("e1", "P", "C")], "enbid string, provName string, cityName string").write.parquet(f"{root}/sites")
    put(f"{root}/provinces.txt", "p1,N1")
    put(f"{root}/hosts.txt", "N1,AA")
    put(f"{root}/gateways.txt", "g1,N1")
    put(f"{root}/ids.txt", "m1,x", "m3")
    put(f"{root}/numbers.txt", "m1")
    put(f"{root}/check/20200101.txt", "S5s8-1,d", "S1u-1,d")
    return root


def out(spark, lake, name):
    return spark.read.orc(f"{lake}/{name}")


def call(spark, lake, job, name, **options):
    argv = [job, "--out", f"{lake}/{name}"]
    if "progress" in run.JOBS[job][2]:
        argv += ["--progress", f"{lake}/progress"]
    for key, value in options.items():
        argv += [f"--{key.replace('_', '-')}", value.format(lake=lake)]
    run.main(argv, spark)
    return out(spark, lake, name)


def test_daily_jobs(spark, lake):
    day = "20200101"
    con = call(spark, lake, "con-non-daily", "con", coap="{lake}/coap", sites="{lake}/sites", crm="{lake}/crm", day=day)
    assert rows(con.select("custid", "upConcnt", "upConSucccnt", "upConRate", "networktype")) == [("c1", 2, 1, 50.0, "NB"), ("c2", 2, 1, 50.0, "NB")]
    call(spark, lake, "con-non-daily", "con", coap="{lake}/coap", sites="{lake}/sites", crm="{lake}/crm", day=day)
    assert out(spark, lake, "con").count() == 2  # a rerun replaces its slice
    assert rows(ledger.read_progress(spark, f"{lake}/progress", "con")) == [("con", day, day)]
    cust = call(spark, lake, "customer-rates", "cust", coap="{lake}/coap", crm="{lake}/crm", customers="c1", day=day)
    assert {r["gather_type"]: r["gather_value"] for r in cust.collect()} == {
        labels.COAP_UP_RATE: 50.0, labels.COAP_DOWN_RATE: 100.0, labels.COAP_DOWN_DELAY: 20.0}
    created = call(spark, lake, "create-sessions", "created", s5s8="{lake}/s5s8", gateways="{lake}/gateways.txt", day=day)
    assert rows(created.select("PRODTYPE", "USERNUM")) == [("N1", 2)]
    counters = call(spark, lake, "subscriber-counters", "counters", coap="{lake}/coap", ids="{lake}/ids.txt",
                    gateways="{lake}/gateways.txt", server="srv", day=day)
    assert rows(counters.select("MSISDN", "upcons", "downconSucc")) == [("m1", 2, 1)]
    outside = call(spark, lake, "outside-addresses", "outside", coap="{lake}/coap", ids="{lake}/numbers.txt", allowed="10.0.0.0", day=day, next_day="20200108")
    assert rows(outside.select("mdn", "DestinationIP_value")) == [("m1", "10.0.0.1,10.0.0.2,10.0.0.3,10.0.0.4")]
    sheet = call(spark, lake, "quality-sheet", "sheet", s5s8="{lake}/s5s8", coap="{lake}/coap", crm="{lake}/crm", customers="c2", day=day)
    assert rows(sheet.select("mdn", "alls", "fails", "upcnt", "up_fail_cnt")) == [("m2", 1, 1, 2, 1)]


def test_province_kpis_survive_a_missing_feed(spark, lake):
    options = dict(s5s8="{lake}/s5s8", coap="{lake}/coap", provinces="{lake}/provinces.txt", hosts="{lake}/hosts.txt", slice="202001011000")
    kpis = call(spark, lake, "province-kpis", "kpis", s6a="{lake}/s6a", **options)
    got = {(r["DATATYPE"], r["PRODTYPE"]): r["USERNUM"] for r in kpis.collect()}
    assert got[(labels.LOCATION_UPDATE_RATE, "N1")] == 100.0 and got[(labels.COAP_UP_RATE, labels.NATIONAL)] == 50.0
    assert got[(labels.BEARER_SETUP_RATE, "N1")] == pytest.approx(200 / 3)
    assert {r["STA_TIME"] for r in kpis.collect()} == {"2020-01-01 10:00:00"}
    without = call(spark, lake, "province-kpis", "kpis2", s6a="{lake}/absent", **options)
    assert without.where(F.col("DATATYPE") == labels.LOCATION_UPDATE_RATE).count() == 0 and without.count() == len(got) - 2


def test_new_gateways_are_new_once(spark, lake):
    options = dict(s5s8="{lake}/s5s8", known="{lake}/known", day="20200101")
    for _ in range(2):  # a rerun of the day finds the same
        found = call(spark, lake, "new-gateways", "found", **options)
        assert rows(found.select("sgw_add_ip")) == [("g1",)]
    assert spark.read.orc(f"{lake}/known").count() == 1
    for _ in range(2):
        found = call(spark, lake, "new-gateways", "found2", s5s8="{lake}/s5s8", known="{lake}/known2", filters="{lake}/filters", day="20200101")
        assert rows(found.select("sgw_add_ip")) == [("g1",)]


def test_reconciliation(spark, lake):
    table = call(
        spark, lake, "reconcile", "recon", coap="{lake}/coap", s1u="{lake}/none", mqtt="{lake}/none", s5s8="{lake}/s5s8",
        sets="PGW1=10.1.,PGW2=10.2.", apn="x.ctnb", bearer_apn="ctnb", inbox="{lake}/in", checklist="{lake}/check",
        prefixes="S5S8_NUM_DAY=S5s8-,S1U_NUM_DAY=S1u-", day="20200101", next_day="20200102",
    )
    with pytest.raises(RuntimeError, match="20200101 is not complete yet: coap,mqtt,s1u,s5s8"):
        call(
            spark, lake, "reconcile", "recon2", coap="{lake}/coap", s1u="{lake}/none", mqtt="{lake}/none", s5s8="{lake}/s5s8",
            sets="PGW1=10.1.", apn="x", bearer_apn="x", inbox="{lake}/in", checklist="{lake}/check", prefixes="A=B", day="20200101",
            next_day="20200102", done="{lake}/done",
        )
    got = {(r["CHECKTYPE"], r["PGW"]): (r["USERNUM"], r["UPFLOW"], r["DOWNFLOW"]) for r in table.collect()}
    assert got[("COAP", "PGW1")] == (2, 50.0, 70.0) and got[("COAP", "PGW2")] == (0, 0.0, 0.0)
    assert got[("S5C", "PGW1")] == (2, 2.0, -1.0)
    assert got[("DPI_S1U_NUM_DAY", "ALL")][0] == 1 and len(got) == 8


def test_http_jobs(spark, lake):
    def http(**at):
        fields = [""] * 100
        for k, v in at.items():
            fields[int(k[1:])] = v
        return "|".join(fields)

    put(f"{lake}/http/2020010110/x", http(f2="m1", f69="h", f67="/u", f75="302"), http(f2="m2", f69="h", f67="/v", f75="200"))
    status = call(spark, lake, "http-status", "status", lines="{lake}/http", slice="2020010110")
    assert rows(status.select("MSISDN", "HttpStatus")) == [("m1", "302")]
    probe = call(spark, lake, "probe-audit", "probe", lines="{lake}/http", slice="2020010110", numbers="m2", csv="{lake}/probe_csv")
    assert rows(probe.select("MSISDN", "DestinationURL")) == [("m2", "h/v")]
    assert spark.read.option("sep", "|").option("header", True).csv(f"{lake}/probe_csv").count() == 1


def test_radius_from_messages_to_statistics(spark, lake):
    put(f"{lake}/radius/a", *[message(PGW, MDN=m, BSID="e1", APN=a, StopTime="2020-01-01 10:02:00")
                              for m, a in (("m1", "net"), ("m1", "net"), ("m2", "x.ctnb"))])
    run.main(["land-radius", "--network", "4g", "--lines", f"{lake}/radius", "--out", f"{lake}/landed",
              "--checkpoint", f"{lake}/cp"], spark)
    stats = call(spark, lake, "offline-stats", "offline", network="4g", radius="{lake}/landed", crm="{lake}/crm",
                 sites="{lake}/sites", slice="202001011000")
    assert rows(stats.select("cust_id", "provName", "session_cnt", "mdn_cnt")) == [("c1", "P", 2, 1)]
    put(f"{lake}/hosts/h1/radius_2020.json", '{"MDN":"m2","BSID":"e1","APN":"net","Status":"Stop","TerminateCause":"x"}')
    from_files = call(spark, lake, "offline-stats", "offline2", network="4g", json="{lake}/hosts/*/radius_2020.json",
                      crm="{lake}/crm", sites="{lake}/sites", slice="202001011000")
    assert rows(from_files.select("cust_id", "TerminateCause", "session_cnt")) == [("c2", "x", 1)]
    assert rows(ledger.read_progress(spark, f"{lake}/progress", "offline"))[0][1] == "20200101100000"
    run.main(["land-radius", "--network", "4g", "--lines", f"{lake}/radius", "--out", f"{lake}/landed",
              "--checkpoint", f"{lake}/cp2"], spark)
    run.main(["compact", "--network", "4g", "--radius", f"{lake}/landed", "--slice", "202001011000"], spark)
    assert read_landed(spark, f"{lake}/landed", PGW).count() == 6 and live_files(spark, f"{lake}/landed").count() == 1
    run.main(["session-stats", "--network", "4g", "--lines", f"{lake}/radius", "--out", f"{lake}/sessions", "--checkpoint", f"{lake}/cp3"], spark)
    by = spark.createDataFrame([], "terminatecause string").schema
    assert [(r["session_cnt"], r["mdn_cnt"]) for r in read_statistics(spark, f"{lake}/sessions", by).collect()] == [(3, 2)]
