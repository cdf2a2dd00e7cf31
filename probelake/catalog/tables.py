"""Driver tables in the shape of the feeds.

lineitem plays the CoAP feed, orders the S5S8 feed, customer the S6A feed and
events the RADIUS records. Each view is a plain projection, so a job over it
reads only the source columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The schemas of the driver tables in use. Stating them spares
#: every query a job per table that would read them from the files.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def coap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey as string) as MSISDN",
        "cast(l_suppkey as string) as eNB_ID",
        "case when l_tax >= 0.05 then 'meter.apn.ctnb.example' when l_tax >= 0.02 then 'ctnet.example' end as APN",
        "case l_returnflag when 'A' then '1' when 'N' then '2' else '3' end as ProcedureType",
        "case l_linestatus when 'O' then '1' else '2' end as Direction",
        "case when l_linenumber = 7 then '' else cast(l_linenumber % 4 as string) end as Status",
        "cast(cast(floor(l_quantity) as bigint) * 10 as string) as FirstRequestTime",
        "case when l_linenumber = 6 then '' else cast(cast(floor(l_quantity) as bigint) * 10"
        " + cast(floor(l_extendedprice / 100) as bigint) as string) end as AckTime",
        "concat('10.', cast(14 + l_suppkey % 3 as string), '.0.', cast(l_suppkey % 32 as string)) as SGWIP",
        "concat('10.', cast(14 + l_suppkey % 3 as string), '.0.', cast(l_suppkey % 32 as string)) as PGWIP",
        "concat('10.20.', cast(l_suppkey % 4 as string), '.', cast(l_linenumber as string)) as DestinationIP",
        "concat('10.30.0.', cast(l_linenumber % 3 as string)) as AppServerIP",
        "cast(l_suppkey % 25 as string) as Roma_Province",
        "concat(date_format(l_shipdate, 'yyyyMMdd'), lpad(cast(l_linenumber as string), 2, '0'), '0000') as StartTime",
        "case when l_linenumber = 5 then '' else cast(cast(floor(l_extendedprice) as bigint) as string) end as OutputOctets",
        "cast(cast(floor(l_quantity) as bigint) - 10 as string) as InputOctets",
    )


def s5s8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey as string) as MSISDN",
        "case o_orderstatus when 'F' then '3' when 'O' then '2' else '1' end as Procedure_Type",
        "case substr(o_orderpriority, 1, 1) when '1' then '0' when '2' then '0' when '3' then '1'"
        " when '4' then '2' else '' end as Procedure_Status",
        "case when o_totalprice > 250000 then '8' else '6' end as RAT",
        "case when o_totalprice > 400000 then null when o_totalprice > 150000 then 'ctnb.example'"
        " else 'ctnet.example' end as APN",
        "concat('10.', cast(14 + o_custkey % 3 as string), '.0.', cast(o_custkey % 32 as string)) as SGW_IP_Add",
        "concat('10.', cast(14 + o_custkey % 3 as string), '.0.', cast(o_custkey % 32 as string)) as PGW_IP_Add",
        "cast(o_custkey % 25 as string) as Roma_Province",
        "cast(14 + o_custkey % 8 as string) as Result_Code",
        "cast(unix_millis(cast(o_orderdate as timestamp)) as string) as Procedure_Start_Time",
        "o_orderkey",
        "o_orderdate",
    )


def s6a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat(case when c_mktsegment = 'HOUSEHOLD' then 'hss' else 'mme' end, '-host.pr-',"
        " lpad(cast(c_nationkey as string), 2, '0'), '.example') as Origin_Host",
        "case when c_acctbal > 0 then '1' else '2' end as Procedure_Type",
        "case when c_acctbal > 5000 then '0' when c_acctbal > 2500 then '1' else '' end as Procedure_Status",
    )


def radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as mdn",
        "cast(user_id % 25 as string) as bsid",
        "cast(user_id % 25 as string) as sid",
        "case when event_type = 'view' then 'Start' else 'Stop' end as status",
        "case when event_type = 'click' then null when props like '%9%' then 'meter.ctnb.example' else 'ctnet.example' end as apn",
        "event_type as terminatecause",
        "cast(ts as timestamp) as ts",
        "event_id",
    )


def radius_messages(spark: SparkSession, sf_dir: str, layout, *kept: str) -> DataFrame:
    """One JSON message per event, with the event's columns ``kept``; several kinds of them are unusable."""
    e = table(spark, sf_dir, "events")
    starting = F.col("event_type") == "view"
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    fields = {k: F.concat(F.lit(k.lower() + "-"), F.col("user_id").cast("string")) for k in layout.keys}
    fields["MDN"] = F.col("user_id").cast("string")
    fields["Status"] = F.when(starting, "Start").otherwise("Stop")
    fields["TerminateCause"] = F.col("event_type")
    for key, _ in layout.on_start:
        fields[key] = F.when(starting, F.lit("true"))
    for key, _ in layout.on_stop:
        fields[key] = F.when(~starting, F.lit("0"))
    fields["StartTime"] = F.when(starting, time)
    fields["StopTime"] = F.when((F.col("event_type") != "view") & (F.col("value") < 80), time)
    body = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    message = (
        F.when((F.col("event_type") == "error") & F.col("props").contains("3"), F.concat(F.lit("["), body, F.lit("]")))
        .when((F.col("event_type") == "error") & F.col("props").contains("7"), F.substring(body, 1, 20))
        .when(
            (F.col("event_type") == "signup") & F.col("props").contains("5"),
            F.regexp_replace(body, '"Duration":"[^"]*"', '"Duration":12'),
        )
        .otherwise(body)
    )
    return e.select(message.alias("value"), *kept)


def sites_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site -> province and city for the CoAP view; one region is not covered."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_name") != "ASIA")
        .select(
            F.col("s_suppkey").cast("string").alias("enbid"),
            F.col("r_name").alias("provName"),
            F.col("n_name").alias("cityName"),
        )
    )


def sites_of_nations(spark: SparkSession, sf_dir: str, key: str = "enbid") -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias(key),
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("provName"),
        F.col("n_name").alias("cityName"),
    )


def crm_of_parts(spark: SparkSession, sf_dir: str, customer_column: str = "custid") -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("mdn"), F.col("p_brand").alias(customer_column)
    )


def crm_of_customers(spark: SparkSession, sf_dir: str, customer_column: str = "cust_id") -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("mdn"), F.col("c_mktsegment").alias(customer_column)
    )


def provinces(spark: SparkSession, sf_dir: str, key: str = "Roma_Province") -> DataFrame:
    """Province code -> name; one region is not covered."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_regionkey") != 2)
        .select(F.col("n_nationkey").cast("string").alias(key), F.col("n_name").alias("PROVNAME"))
    )


def gateways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gateway address -> province, from the suppliers; the third network is not covered."""
    return (
        table(spark, sf_dir, "supplier")
        .where("s_suppkey % 3 <> 2")
        .selectExpr(
            "concat('10.', cast(14 + s_suppkey % 3 as string), '.0.', cast(s_suppkey % 32 as string)) as SGSNIPAddress",
            "concat('PROV_', cast(s_suppkey % 32 as string)) as PROVNAME",
        )
        .distinct()
    )
