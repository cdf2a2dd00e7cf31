"""KPI, session, audit and device reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import fill_null
from ..functions.times import day_start_millis, slice_display, slice_ten_minutes
from ..operators.enrich import duplicated_keys
from ..operators.kpi import Measure, count_by, with_total
from ..operators.lists import joined_lists
from ..plans import audit, devices, labels, quality, rates, sessions
from ..sources.lookups import lookup_from_lines
from . import sql as S
from . import tables as T
from .registry import query

DAY = "20200420"
TIME = "2020-04-20 10:10:00"


# -- CoAP exchanges --------------------------------------------------------

@query(
    "con_non_daily",
    S.with_views(S.COAP, S.SITES)
    + f"""
    , facts as (
      select *, case when APN like '%ctnb%' then 'NB' when APN not like '%ctnb%' then '4G' end as networktype,
        Status in ('0', '2') as ok from coap)
    , counts as (
      select p.p_brand as custid, s.provName, s.cityName, f.networktype,
        count(*) filter (where Direction = '1' and ProcedureType = '1') as upConcnt,
        count(*) filter (where Direction = '1' and ProcedureType = '1' and ok) as upConSucccnt,
        count(*) filter (where Direction = '1' and ProcedureType = '2') as upNoncnt,
        count(*) filter (where Direction = '2' and ProcedureType = '1') as downConcnt,
        count(*) filter (where Direction = '2' and ProcedureType = '1' and ok) as downConSucccnt,
        count(*) filter (where Direction = '2' and ProcedureType = '2') as downNoncnt
      from facts f left join sites s on f.eNB_ID = s.enbid
        left join part p on f.MSISDN = cast(p.p_partkey as varchar)
      where f.networktype is not null group by all)
    select '{DAY}' as datatime, *,
      round(upConSucccnt * cast(100 as double) / nullif(upConcnt, 0), 2) as upConRate,
      round(downConSucccnt * cast(100 as double) / nullif(downConcnt, 0), 2) as downConRate
    from counts""",
)
def con_non_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rates.con_non_daily(T.coap(spark, sf), T.sites_of_suppliers(spark, sf), T.crm_of_parts(spark, sf), DAY)


CUSTOMERS = tuple(f"Brand#{i}" for i in range(1, 19))


@query(
    "cust_rate_long",
    S.with_views(S.COAP)
    + f"""
    , facts as (
      select p_brand as cust_id, Direction, Status in ('0', '2') as ok, ack_ms - first_ms as delay
      from coap join part on MSISDN = cast(p_partkey as varchar)
      where APN like '%ctnb%' and ProcedureType = '1' and p_brand in {CUSTOMERS})
    select '{DAY}' as gather_date, cust_id, '{labels.COAP_UP_RATE}' as gather_type,
      round(count(*) filter (where ok) * cast(100 as double) / count(*), 2) as gather_value
    from facts where Direction = '1' group by cust_id
    union all
    select '{DAY}', cust_id, '{labels.COAP_DOWN_RATE}',
      round(count(*) filter (where ok) * cast(100 as double) / count(*), 2)
    from facts where Direction = '2' group by cust_id
    union all
    select '{DAY}', cust_id, '{labels.COAP_DOWN_DELAY}', round(avg(cast(delay as double)), 2)
    from facts where Direction = '2' group by cust_id""",
)
def cust_rate_long(spark: SparkSession, sf: str) -> DataFrame:
    return rates.customer_rates(T.coap(spark, sf), T.crm_of_parts(spark, sf, "cust_id"), CUSTOMERS, DAY)


@query(
    "kpi_coap_province",
    S.with_views(S.COAP, S.PROVINCES)
    + f"""
    , con as (select *, Status in ('0', '2') as ok, ack_ms - first_ms as delay from coap where ProcedureType = '1')
    , g as (
      select Roma_Province as code,
        count(*) filter (where Direction = '1') as ua, count(*) filter (where Direction = '1' and ok) as uo,
        count(*) filter (where Direction = '2') as da, count(*) filter (where Direction = '2' and ok) as dok,
        sum(delay) filter (where Direction = '2') as ds
      from con group by 1)
    , t as (select sum(ua) as ua, sum(uo) as uo, sum(da) as da, sum(dok) as dok, sum(ds) as ds from g)
    , named as (
      select PROVNAME as p, ua, uo, da, dok, ds, false as tot from g join provinces using (code)
      union all select '{labels.NATIONAL}', ua, uo, da, dok, ds, true from t)
    select '{labels.COAP_UP_RATE}' as DATATYPE, '{TIME}' as STA_TIME, p as PRODTYPE,
      uo * cast(100 as double) / nullif(ua, 0) as USERNUM from named where tot or uo > 0
    union all
    select '{labels.COAP_DOWN_RATE}', '{TIME}', p, dok * cast(100 as double) / nullif(da, 0)
      from named where tot or dok > 0
    union all
    select '{labels.COAP_DOWN_DELAY}', '{TIME}', p, cast(ds as double) / nullif(da, 0) from named where tot or da > 0""",
)
def kpi_coap_province(spark: SparkSession, sf: str) -> DataFrame:
    return rates.coap_province_rates(T.coap(spark, sf), T.provinces(spark, sf), TIME)


# -- Signalling ------------------------------------------------------------

@query(
    "kpi_bearer_setup",
    S.with_views(S.S5S8, S.PROVINCES)
    + f"""
    , g as (
      select Roma_Province as code, count(*) as a, count(*) filter (where Procedure_Status = '0') as s
      from s5s8 where Procedure_Type = '3' group by 1)
    select '{labels.BEARER_SETUP_RATE}' as DATATYPE, '{TIME}' as STA_TIME, PROVNAME as PRODTYPE,
      s * cast(100 as double) / a as USERNUM from g join provinces using (code) where s > 0
    union all
    select '{labels.BEARER_SETUP_RATE}', '{TIME}', '{labels.NATIONAL}',
      sum(s) * cast(100 as double) / nullif(sum(a), 0) from g""",
)
def kpi_bearer_setup(spark: SparkSession, sf: str) -> DataFrame:
    return rates.bearer_setup_rate(T.s5s8(spark, sf), T.provinces(spark, sf), TIME)


@query(
    "kpi_host_code",
    f"""
    with g as (
      select lpad(cast(c_nationkey as varchar), 2, '0') as origin, count(*) as a,
        count(*) filter (where c_acctbal > 5000) as s
      from customer where c_mktsegment <> 'HOUSEHOLD' and c_acctbal > 0 group by 1)
    select '{labels.LOCATION_UPDATE_RATE}' as DATATYPE, '{TIME}' as STA_TIME, n_name as PRODTYPE,
      s * cast(100 as double) / a as USERNUM
    from g join nation on origin = lpad(cast(n_nationkey as varchar), 2, '0')
    where s > 0 and n_regionkey <> 2
    union all
    select '{labels.LOCATION_UPDATE_RATE}', '{TIME}', '{labels.NATIONAL}',
      sum(s) * cast(100 as double) / nullif(sum(a), 0) from g""",
)
def kpi_host_code(spark: SparkSession, sf: str) -> DataFrame:
    hosts = T.provinces(spark, sf, "origin").withColumn("origin", F.lpad("origin", 2, "0"))
    return rates.location_update_rate(T.s6a(spark, sf), hosts, TIME)


@query(
    "kpi_10min_prov",
    S.with_views(S.RADIUS)
    + """
    , g as (
      select substr(strftime(ts, '%Y%m%d%H%M'), 1, 11) || '0' as bucket, bsid,
        count(*) as a, count(*) filter (where terminatecause = 'error') as e
      from radius group by 1, 2)
    select strftime(strptime(bucket, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M:%S') as STA_TIME, n_name as PROVNAME,
      a as alls, e as errors, round(e * cast(100 as double) / a, 4) as rate
    from g join nation on bsid = cast(n_nationkey as varchar) where e > 0""",
)
def kpi_10min_prov(spark: SparkSession, sf: str) -> DataFrame:
    slice_id = F.date_format("ts", "yyyyMMddHHmm")
    rows = T.radius(spark, sf).select(slice_ten_minutes(slice_id).alias("bucket"), "bsid", "terminatecause")
    counts = count_by(
        rows, ["bucket", "bsid"], [Measure("alls"), Measure("errors", F.col("terminatecause") == "error")]
    )
    names = T.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("bsid"), F.col("n_name").alias("PROVNAME"))
    return counts.where("errors > 0").join(names, "bsid").select(
        slice_display(F.col("bucket")).alias("STA_TIME"), "PROVNAME", "alls", "errors",
        F.round(F.col("errors") * 100.0 / F.col("alls"), 4).alias("rate"),
    )


@query(
    "kpi_with_national",
    f"""
    select coalesce(g, '{labels.NATIONAL}') as l_returnflag, cnt, qty, tot as is_total from (
      select l_returnflag as g, count(*) as cnt, round(sum(l_quantity), 2) as qty, grouping(l_returnflag) = 1 as tot
      from lineitem group by rollup (l_returnflag))""",
)
def kpi_with_national(spark: SparkSession, sf: str) -> DataFrame:
    measures = [Measure("cnt"), Measure("qty", value=F.col("l_quantity"))]
    groups = count_by(T.table(spark, sf, "lineitem"), ["l_returnflag"], measures)
    return with_total(groups, "l_returnflag", measures, labels.NATIONAL).withColumn("qty", F.round("qty", 2))


@query(
    "create_session_by_prov",
    S.with_views(S.S5S8, S.GATEWAYS)
    + f"""
    select '{labels.CREATE_SESSION_COUNT}' as DATATYPE, '{TIME}' as STA_TIME,
      coalesce(PROVNAME, '{labels.UNKNOWN}') as PRODTYPE, count(*) as USERNUM
    from s5s8 left join gateways on SGW_IP_Add = ip
    where APN like '%ctnb%' and Procedure_Status = '0' and Procedure_Type = '3' group by 3""",
)
def create_session_by_prov(spark: SparkSession, sf: str) -> DataFrame:
    return rates.create_session_counts(T.s5s8(spark, sf), T.gateways(spark, sf), TIME)


# -- Sessions --------------------------------------------------------------

def _offline_sql(condition: str) -> str:
    return S.with_views(S.RADIUS, S.NATION_SITES) + f"""
    select '{TIME}' as datatime, c_mktsegment as cust_id, coalesce(provName, '-1') as "provName",
      coalesce(cityName, '-1') as "cityName", terminatecause as "TerminateCause",
      count(*) as session_cnt, count(distinct mdn) as mdn_cnt
    from radius join sites on bsid = enbid join customer on mdn = cast(c_custkey as varchar)
    where status = 'Stop' and {condition} group by all"""


@query("offline_stat_4g", _offline_sql("apn not like '%ctnb%'"))
def offline_stat_4g(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.offline_stats(
        T.radius(spark, sf), T.crm_of_customers(spark, sf), T.sites_of_nations(spark, sf), "4g", TIME
    )


@query("offline_stat_nb", _offline_sql("apn like '%ctnb%'"))
def offline_stat_nb(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.offline_stats(
        T.radius(spark, sf), T.crm_of_customers(spark, sf), T.sites_of_nations(spark, sf), "nb", TIME
    )


@query("offline_stat_3g", _offline_sql("sites.cityName <> 'NATION_7'"))
def offline_stat_3g(spark: SparkSession, sf: str) -> DataFrame:
    # Site lines as delivered: tab-separated; a line with a fourth field is dropped.
    sites = T.sites_of_nations(spark, sf, "sid")
    extra = F.when(F.col("cityName") == "NATION_7", F.lit("\textra")).otherwise("")
    lines = sites.select(
        F.concat(F.concat_ws("\t", "sid", fill_null("provName", ""), "cityName"), extra).alias("value")
    )
    parsed = lookup_from_lines(lines, ("sid", "provName", "cityName"), "\t", exact=True)
    known = parsed.withColumn("provName", F.when(F.col("provName") != "", F.col("provName")))
    return sessions.offline_stats(T.radius(spark, sf), T.crm_of_customers(spark, sf), known, "3g", TIME)


# -- Reconciliation --------------------------------------------------------

SETS = {"PGW1": "10.14.", "PGW2": "10.15."}
FROM_DAY, UNTIL_DAY = "19960101", "20000101"


@query(
    "recon_gateway",
    S.with_views(S.COAP)
    + f"""
    , f as (
      select case when SGWIP like '10.14.%' then 'PGW1' else 'PGW2' end as PGW, MSISDN, out_octets, in_octets
      from coap where APN like 'meter.apn.ctnb%' and (SGWIP like '10.14.%' or SGWIP like '10.15.%')
        and StartTime > '{FROM_DAY}' and StartTime < '{UNTIL_DAY}' and (out_octets > 0 or in_octets > 0))
    select '{FROM_DAY}' as STA_TIME, 'COAP' as CHECKTYPE, n.PGW, count(distinct MSISDN) as USERNUM,
      coalesce(sum(out_octets), 0) as UPFLOW, coalesce(sum(in_octets), 0) as DOWNFLOW,
      coalesce(sum(out_octets) + sum(in_octets), 0) as TOTALFLOW
    from (values ('PGW1'), ('PGW2')) n(PGW) left join f using (PGW) group by n.PGW""",
)
def recon_gateway(spark: SparkSession, sf: str) -> DataFrame:
    return audit.recon_traffic([T.coap(spark, sf)], SETS, "meter.apn.ctnb", FROM_DAY, UNTIL_DAY)


RESULT_CODES = ("16", "17", "18", "19")


@query(
    "recon_bearer",
    S.with_views(S.S5S8)
    + f"""
    , f as (
      select case when SGW_IP_Add like '10.14.%' then 'PGW1' else 'PGW2' end as PGW, MSISDN
      from s5s8 where APN like 'ctnb%' and (SGW_IP_Add like '10.14.%' or SGW_IP_Add like '10.15.%')
        and cast(start_ms as varchar) > cast(epoch_ms(timestamp '1996-01-01') as varchar)
        and cast(start_ms as varchar) < cast(epoch_ms(timestamp '2000-01-01') as varchar)
        and Result_Code in {RESULT_CODES} and Procedure_Type = '3' and Procedure_Status = '0')
    select '{FROM_DAY}' as STA_TIME, 'S5C' as CHECKTYPE, n.PGW, count(distinct MSISDN) as USERNUM,
      cast(count(MSISDN) as double) as UPFLOW, cast(-1 as double) as DOWNFLOW, cast(-1 as double) as TOTALFLOW
    from (values ('PGW1'), ('PGW2')) n(PGW) left join f using (PGW) group by n.PGW""",
)
def recon_bearer(spark: SparkSession, sf: str) -> DataFrame:
    return audit.recon_bearers(
        T.s5s8(spark, sf), SETS, "ctnb", day_start_millis(F.lit(FROM_DAY)), day_start_millis(F.lit(UNTIL_DAY)),
        RESULT_CODES, FROM_DAY,
    )


CHECKLIST = {"DPI_S5S8_NUM_DAY": "S5s8-", "DPI_S1U_NUM_DAY": "S1u-", "DPI_COAP_NUM_DAY": "S1ucoap-"}


@query(
    "recon_expected_files",
    """
    select '19960101' as STA_TIME, t.tag as CHECKTYPE, 'ALL' as PGW, count(o.o_orderkey) as USERNUM,
      cast(-1 as double) as UPFLOW, cast(-1 as double) as DOWNFLOW, cast(-1 as double) as TOTALFLOW
    from (values ('DPI_S5S8_NUM_DAY', 'F'), ('DPI_S1U_NUM_DAY', 'O'), ('DPI_COAP_NUM_DAY', 'P')) t(tag, st)
      left join orders o on o.o_orderstatus = t.st and o.o_orderpriority <> '5-LOW' group by t.tag""",
)
def recon_expected_files(spark: SparkSession, sf: str) -> DataFrame:
    # One checklist line per order; lines without a directory field do not count.
    kind = F.when(F.col("o_orderstatus") == "F", "S5s8-").when(F.col("o_orderstatus") == "O", "S1u-").otherwise("S1ucoap-")
    folder = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.concat(F.lit(",/in/"), "o_orderpriority"))
    lines = T.table(spark, sf, "orders").select(
        F.concat(kind, F.col("o_orderkey").cast("string"), F.lit(".txt"), folder).alias("value")
    )
    checklist = lookup_from_lines(lines, ("filename", "filedir"))
    return audit.expected_files(checklist, CHECKLIST, FROM_DAY)


# -- Gateways and subscribers ----------------------------------------------

@query(
    "new_gateways",
    S.with_views(S.S5S8)
    + """
    select distinct '19980101' as sta_time, SGW_IP_Add as sgw_add_ip from s5s8
    where SGW_IP_Add not in (select SGW_IP_Add from s5s8 where RAT = '6' and Procedure_Status = '1'
      and Procedure_Type = '3' and APN like '%ctnet%' and o_orderdate < timestamp '1996-06-01')""",
)
def new_gateways(spark: SparkSession, sf: str) -> DataFrame:
    seen = T.s5s8(spark, sf)
    known = seen.where(
        "RAT = '6' and Procedure_Status = '1' and Procedure_Type = '3' and APN like '%ctnet%'"
        " and o_orderdate < timestamp_ntz '1996-06-01 00:00:00'"
    ).select("SGW_IP_Add")
    return devices.new_gateways(seen, known, "19980101")


@query(
    "subscriber_counters",
    S.with_views(S.COAP, S.GATEWAYS)
    + f"""
    , c as (
      select eNB_ID as "MSISDN", PROVNAME as "PROVNAME",
        count(*) filter (where ProcedureType = '1' and Direction = '1') as upcons,
        count(*) filter (where ProcedureType = '2' and Direction = '1') as upnons,
        count(*) filter (where ProcedureType = '1' and Direction = '2') as downcons,
        count(*) filter (where ProcedureType = '1' and Direction = '2' and Status in ('0', '2')) as "downconSucc",
        count(*) filter (where ProcedureType = '2' and Direction = '2') as downnons
      from coap left join gateways on SGWIP = ip
      where AppServerIP = '10.30.0.1'
        and eNB_ID in (select cast(s_suppkey as varchar) from supplier where s_acctbal > 1000)
      group by 1, 2)
    select '{DAY}' as "whichDay", * from c
    where "PROVNAME" is not null and least(upcons, upnons, downcons, "downconSucc", downnons) > 0""",
)
def subscriber_counters(spark: SparkSession, sf: str) -> DataFrame:
    # The sites stand in for the numbers here: each has enough traffic.
    traffic = T.coap(spark, sf).withColumn("MSISDN", F.col("eNB_ID"))
    ids = T.table(spark, sf, "supplier").where("s_acctbal > 1000").select(F.col("s_suppkey").cast("string").alias("MDN"))
    return devices.subscriber_counters(traffic, ids, T.gateways(spark, sf), "10.30.0.1", DAY)


@query(
    "outside_address_list",
    S.with_views(S.COAP)
    + """
    select cast(p_partkey as varchar) as mdn, DestinationIP as "DestinationIP", count(*) as times
    from part join coap on MSISDN = cast(p_partkey as varchar)
    where APN like '%ctnb%' and DestinationIP <> '10.20.0.1' group by 1, 2""",
)
def outside_address_list(spark: SparkSession, sf: str) -> DataFrame:
    ids = T.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("mdn"))
    return devices.outside_addresses(T.coap(spark, sf), ids, "10.20.0.1")


@query(
    "outside_address_text",
    S.with_views(S.COAP)
    + """
    select cast(p_partkey as varchar) as mdn,
      string_agg(DestinationIP, ',' order by DestinationIP) as "DestinationIP_value"
    from part join coap on MSISDN = cast(p_partkey as varchar)
    where APN like '%ctnb%' and DestinationIP <> '10.20.0.1' group by 1""",
)
def outside_address_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists as report cells, one row per number."""
    return joined_lists(outside_address_list(spark, sf), "mdn", "DestinationIP", "DestinationIP_value")


_QUALITY = (
    S.with_views(S.COAP, S.S5S8)
    + """
    , ids as (select cast(c_custkey as varchar) as mdn from customer where c_mktsegment = 'BUILDING')
    , a as (select MSISDN as mdn, count(*) as alls, count(*) filter (where Procedure_Status <> '0') as fails
      from s5s8 where Procedure_Type = '3' and MSISDN in (select mdn from ids) group by 1)
    , b as (select MSISDN as mdn1, count(*) as all_cnt, count(*) filter (where Procedure_Status <> '0') as fail_cnt
      from s5s8 where Procedure_Type = '2' and MSISDN in (select mdn from ids) group by 1)
    , c as (select MSISDN as mdn2, count(*) filter (where Direction = '1') as upcnt,
        count(*) filter (where Direction = '1' and Status <> '0' and Status <> '2') as up_fail_cnt,
        count(*) filter (where Direction = '2') as down_cnt,
        count(*) filter (where Direction = '2' and Status <> '0' and Status <> '2') as down_fail_cnt
      from coap where ProcedureType = '1' and MSISDN in (select mdn from ids) group by 1)
    , d as (select MSISDN as mdn3, count(*) filter (where Direction = '1') as up1_cnt,
        count(*) filter (where Direction = '1' and Status <> '0' and Status <> '2') as up1_fail_cnt,
        count(*) filter (where Direction = '2') as down1_cnt,
        count(*) filter (where Direction = '2' and Status <> '0' and Status <> '2') as down1_fail_cnt
      from coap where ProcedureType = '2' and MSISDN in (select mdn from ids) group by 1)
    """
)


def _quality(spark: SparkSession, sf: str, align: bool) -> DataFrame:
    crm = T.crm_of_customers(spark, sf)
    ids = crm.where(F.col("cust_id") == "BUILDING").select("mdn")
    return quality.quality_sheet(T.s5s8(spark, sf), T.coap(spark, sf), ids, "BUILDING", DAY, align=align)


@query(
    "quality_sheet",
    _QUALITY
    + f"""select '{DAY}' as datatime, 'BUILDING' as cust_id, a.*, b.*, c.*, d.* from a
    full join b on a.mdn = b.mdn1 full join c on a.mdn = c.mdn2 full join d on a.mdn = d.mdn3""",
)
def quality_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf, align=False)


@query(
    "quality_sheet_aligned",
    _QUALITY
    + f"""select '{DAY}' as datatime, 'BUILDING' as cust_id,
      ids.mdn as "MSISDN", alls, fails, all_cnt, fail_cnt, upcnt, up_fail_cnt, down_cnt, down_fail_cnt,
      up1_cnt, up1_fail_cnt, down1_cnt, down1_fail_cnt
    from ids left join a on ids.mdn = a.mdn left join b on ids.mdn = mdn1 left join c on ids.mdn = mdn2
      left join d on ids.mdn = mdn3
    where coalesce(a.mdn, mdn1, mdn2, mdn3) is not null""",
)
def quality_sheet_aligned(spark: SparkSession, sf: str) -> DataFrame:
    return _quality(spark, sf, align=True)


GATEWAY_LIST = tuple(f"10.{14 + i % 3}.0.{i}" for i in range(24))


@query(
    "gateway_down_counts",
    S.with_views(S.COAP)
    + f"""
    select count(*) filter (where ProcedureType = '1' and Direction = '2') as down_all,
      count(*) filter (where ProcedureType = '1' and Direction = '2' and Status in ('0', '2')) as down_ok
    from coap where SGWIP in {GATEWAY_LIST}""",
)
def gateway_down_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.gateway_down_counts(T.coap(spark, sf), GATEWAY_LIST)


@query(
    "gateway_set_count",
    S.with_views(S.S5S8)
    + f"""
    select SGW_IP_Add as "SGW_IP_Add", count(*) as cnt from s5s8
    where RAT = '8' and Procedure_Status = '0' and SGW_IP_Add in {GATEWAY_LIST} group by 1""",
)
def gateway_set_count(spark: SparkSession, sf: str) -> DataFrame:
    return audit.gateway_session_counts(T.s5s8(spark, sf), GATEWAY_LIST)


@query(
    "duplicated_keys",
    S.with_views(S.GATEWAYS)
    + 'select PROVNAME as "PROVNAME", count(*) as n_rows from gateways group by 1 having count(*) > 1',
)
def duplicated_dimension_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicated_keys(T.gateways(spark, sf), "PROVNAME")


@query(
    "preview",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
    order by l_orderkey, l_linenumber, l_partkey, l_suppkey limit 30""",
)
def preview(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return T.table(spark, sf, "lineitem").select(*columns).orderBy(*columns).limit(30)
