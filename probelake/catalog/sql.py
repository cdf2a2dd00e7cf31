"""The same views as common table expressions for the SQL side."""

COAP = """
coap as (
  select cast(l_partkey as varchar) as MSISDN, cast(l_suppkey as varchar) as eNB_ID,
    case when l_tax >= 0.05 then 'meter.apn.ctnb.example' when l_tax >= 0.02 then 'ctnet.example' end as APN,
    case l_returnflag when 'A' then '1' when 'N' then '2' else '3' end as ProcedureType,
    case l_linestatus when 'O' then '1' else '2' end as Direction,
    case when l_linenumber = 7 then '' else cast(l_linenumber % 4 as varchar) end as Status,
    cast(floor(l_quantity) as bigint) * 10 as first_ms,
    case when l_linenumber <> 6 then cast(floor(l_quantity) as bigint) * 10
      + cast(floor(l_extendedprice / 100) as bigint) end as ack_ms,
    '10.' || (14 + l_suppkey % 3) || '.0.' || (l_suppkey % 32) as SGWIP,
    '10.20.' || (l_suppkey % 4) || '.' || l_linenumber as DestinationIP,
    '10.30.0.' || (l_linenumber % 3) as AppServerIP,
    cast(l_suppkey % 25 as varchar) as Roma_Province,
    strftime(l_shipdate, '%Y%m%d') || lpad(cast(l_linenumber as varchar), 2, '0') || '0000' as StartTime,
    case when l_linenumber <> 5 then cast(floor(l_extendedprice) as double) end as out_octets,
    cast(floor(l_quantity) - 10 as double) as in_octets
  from lineitem)
"""

S5S8 = """
s5s8 as (
  select cast(o_custkey as varchar) as MSISDN,
    case o_orderstatus when 'F' then '3' when 'O' then '2' else '1' end as Procedure_Type,
    case substr(o_orderpriority, 1, 1) when '1' then '0' when '2' then '0' when '3' then '1'
      when '4' then '2' else '' end as Procedure_Status,
    case when o_totalprice > 250000 then '8' else '6' end as RAT,
    case when o_totalprice > 400000 then null when o_totalprice > 150000 then 'ctnb.example'
      else 'ctnet.example' end as APN,
    '10.' || (14 + o_custkey % 3) || '.0.' || (o_custkey % 32) as SGW_IP_Add,
    cast(o_custkey % 25 as varchar) as Roma_Province,
    cast(14 + o_custkey % 8 as varchar) as Result_Code,
    epoch_ms(o_orderdate) as start_ms,
    o_orderkey, o_orderdate
  from orders)
"""

RADIUS = """
radius as (
  select cast(user_id as varchar) as mdn, cast(user_id % 25 as varchar) as bsid,
    case when event_type = 'view' then 'Start' else 'Stop' end as status,
    case when event_type = 'click' then null when props like '%9%' then 'meter.ctnb.example'
      else 'ctnet.example' end as apn,
    event_type as terminatecause, ts, event_id
  from events)
"""

SITES = """
sites as (
  select cast(s_suppkey as varchar) as enbid, r_name as provName, n_name as cityName
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  where r_name <> 'ASIA')
"""

NATION_SITES = """
sites as (
  select cast(n_nationkey as varchar) as enbid, case when r_name <> 'ASIA' then r_name end as provName,
    n_name as cityName
  from nation join region on n_regionkey = r_regionkey)
"""

PROVINCES = """
provinces as (
  select cast(n_nationkey as varchar) as code, n_name as PROVNAME from nation where n_regionkey <> 2)
"""

GATEWAYS = """
gateways as (
  select distinct '10.' || (14 + s_suppkey % 3) || '.0.' || (s_suppkey % 32) as ip,
    'PROV_' || (s_suppkey % 32) as PROVNAME
  from supplier where s_suppkey % 3 <> 2)
"""


def with_views(*views: str) -> str:
    return "with " + ",".join(v.strip() for v in views) + "\n"
