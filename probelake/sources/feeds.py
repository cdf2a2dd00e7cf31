"""Layouts of the probe feeds and the parser that applies them.

A layout says which positional field becomes which column, how many fields a
line must have, which fields may be missing and how a variable tail is folded.
Parsing is one native projection over the split line.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.scalars import fill_null, lenient_int


@dataclass(frozen=True)
class Tail:
    """A variable tail. ``width`` fields form a group; with ``count_at`` the
    line states the number of groups, otherwise the tail runs to its end."""

    column: str
    start: int
    width: int
    inner: str
    outer: str
    count_at: int | None = None


@dataclass(frozen=True)
class Feed:
    """``columns`` are in line order. Fields from ``required`` on may be absent
    and become ``-1``. ``ints`` are lenient integers (0 on failure). ``after``
    names the columns that follow a counted tail."""

    name: str
    columns: tuple[str, ...]
    required: int
    keep_trailing: bool = True
    ints: tuple[str, ...] = ()
    tail: Tail | None = None
    after: tuple[str, ...] = ()
    reversed_number: str | None = None
    land_filter: str | None = None
    publish_filter: str | None = None
    profiles: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def output_columns(self) -> tuple[str, ...]:
        front = ("mdnReverse",) if self.reversed_number else ()
        tail = (self.tail.column,) if self.tail else ()
        return (*front, *self.columns, *tail, *self.after)

    def split(self, value: Column) -> Column:
        return P.split_keep(value) if self.keep_trailing else P.split_drop(value)


def _words(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# ---------------------------------------------------------------------------
# Column names in line order.

HTTP_EARLY_COLUMNS = _words("""
imsi msisdn imei apn destinationip destinationport sourceip sourceport sgw_ip mme_ip pgw_ip
ecgi_temp tai_temp visitedplmnid rattype protocolid servicetype_new starttime endtime duration
inputoctets outputoctets inputpacket outputpacket pdn_connectionid bearerid bearerqos
recordclosecause useragent destinationurl_new domainname host contentlen contenttype iflink refer
httpaction httpstatus respdelay behaviortarget syntime synacktime acktime actiontime
firstpackettime pageopentime lastpacktime lastpacktime_tmp pagevolume
""")

S1MME_COLUMNS = _words("""
interface_type xdr_id imsi imei msisdn rat home_province procedure_type procedure_start_time
procedure_end_time procedure_status reqcausecode failcausecode keyparam mme_ue_siap_id guti
target_id user_ipv4 user_ipv6 machine_ip_add_type mme_sig_ip ran_ne_sig_ip mmeport enbport tai
ecgi apn other_tac other_eci oldmmegroupid oldmmecode oldmtmsi mme_group_id mme_code m_tmsi tmsi
mme_ue_s1ap_id enodeb_id eci epsbearernumber
""")

S5S8_EARLY_COLUMNS = _words("""
interface_type xdr_id rat imsi imei msisdn procedure_type procedure_start_time procedure_end_time
procedure_status failure_cause user_ip sgw_ip_add pgw_ip_add sgw_port pgw_port sgwcontrolteid
pgwcontrolteid indicationflags ulilength uli epsbearernumber bearer1id bearer1type bearer1qci
bearer1status bearer1sgw_gtp_teid bearer1pgw_gtp_teid sai_cgi_ecgi rai_tai user_ipv4 user_ipv6
layer1id layer2id layer3id layer4id layer5id layer6id apn apn_ambr_ul apn_ambr_dl
machine_ip_add_type
""")

S6A_EARLY_COLUMNS = _words("""
interface_type xdr_id rat imsi imei msisdn procedure_type procedure_start_time procedure_end_time
procedure_status cause user_ip mme_address hss_address mmeport hssport originrealm
destinationrealm originhost destinationhost applicationid subscriberstatus accessrestrictiondata
user_ipv4 user_ipv6 layer1id layer2id layer3id layer4id layer5id layer6id machine_ip_add_type
default_apn ue_ambr_ul ue_ambr_dl home_province visit_mcc visit_mnc probeid
""")

SIGNAL_HEAD = _words("""
Interface XDR_ID IMSI IMEI MSISDN RAT Home_Province Roma_Province Procedure_Type
Procedure_Start_Time Procedure_End_Time Procedure_Status
""")

GX_COLUMNS = SIGNAL_HEAD + _words("""
Result_Code G3PPUserLocationInfo G3PP2BSID Machine_IP_Add_type PCEF_IP_Add PCRF_IP_Add
""")

L2TP_COLUMNS = SIGNAL_HEAD + _words("""
LAC_IP LNS_IP LAC_TUNNEL_ID LNS_TUNNEL_ID SESSION_START_TIME SESSION_END_TIME LAC_SESSION_ID
LNS_SESSION_ID APN CallSerialNumber AUTH_TYPE AUTH_NAME AUTH_Status IPCP_User_IP IPCP_LNS_IP
Result_Code Error_Code Error_Message
""")

S2A_COLUMNS = SIGNAL_HEAD + _words("""
Result_Code APN G3PP2_BSID PCF_IP USER_IPv4 USER_IPv6 Machine_IP_Add_type HSGW_IP_Add PGW_IP_Add
HSGW_Port PGW_Port
""")

S5S8_COLUMNS = SIGNAL_HEAD + _words("""
Result_Code APN APN_AMBR_UL APN_AMBR_DL USER_IPv4 USER_IPv6 Machine_IP_Add_type SGW_IP_Add
PGW_IP_Add SGW_Port PGW_Port SGW_Control_TEID PGW_Control_TEID TAI ECGI ULI_Length ULI
EPS_Bearer_Number
""")

S6A_COLUMNS = SIGNAL_HEAD + _words("""
Result_Code Machine_IP_Add_type MME_Address HSS_Address MME_Port HSS_Port Subscriber_Status
Access_Restriction_Data Default_APN UE_AMBR_UL UE_AMBR_DL USER_IPv4 USER_IPv6 Origin_Host
Destination_Host Application_ID
""")

S1U_COLUMNS = _words("""
Interface IMSI MSISDN IMEI APN DestinationIP DestinationPort SourceIP SourcePort SGWIP MMEIP PGWIP
ECGI TAI VisitedPLMNId RATType ProtocolID ServiceType XXX1 XXX2 StartTime EndTime Duration
InputOctets OutputOctets InputPacket OutputPacket PDNConnectionId BearerID BearerQoS
RecordCloseCause ENBIP SGWPort eNBPort eNBGTP_TEID SGWGTP_TEID PGWPort MME_UE_S1AP_ID
eNB_UE_S1AP_ID MME_Group_ID MME_Code eNB_ID Home_Province UserIP UserPort L4protocal AppServerIP
AppServer_Port ULTCPReorderingPacket DLTCPReorderingPacket ULTCP_RetransPacket DLTCP_RetransPacket
TCPSetupResponseDelay TCPSetupACKDelay ULIPFragPacks DLIPFragPacks Delay_Setup_FirstTransaction
Delay_FirstTransaction_FirstResPackt WindowSize MSSSize TCPSynNumber TCPConnetState
SessionStopFlag Roma_Province
""")

TTL_COLUMNS = ("UP_TTL", "DOWN_TTL")

COAP_EXTRA = _words("""
Version ProcedureType Token Requst_Action Response_result Status FirstRequestTime AckTime
LastRequestTime Retrans_UL_Count Retrans_DL_Count Direction Uri_Port Destination_URI Host Proxy_URI
Proxy_Scheme MSGID
""")

HTTP_EXTRA = _words("""
UserAgent DestinationURL DomainName Host ContentLen ContentType IfLink Refer HttpAction HttpStatus
ResDelay Behavior_Target SYNtime SYNACKtime ACKtime ActionTime FirstPacketTime PageOpenTime
Lastpacktime PageVolume HttpVersion FirstResptime LastAcktime Cookie WtpFailType WtpFailCause title
key_word WebBrowser FirstFINACKTime DNSQueryTime DNSResponseTime DNSFlowID FirstScreenFinTime
""")

MQTT_EXTRA = _words("""
Version ProcedureType ClientID UserName MQTT KeepAlive DupFlag Qos Protocol_Name Topic_Name
Topic2_Name Topic3_Name Message_Action MsgActionAck MessageID RepeatCount MsgActionTime
MsgActionAck_Time Pubreceived_Time Pubrelease_Time PubComplete_Time Status Result
""")

#: Columns left out of the short ("cut") publication of a signalling feed.
SIGNAL_CUT_OUT = _words("Interface XDR_ID Home_Province")
S2A_CUT_OUT = SIGNAL_CUT_OUT + _words("HSGW_Port PGW_Port")
S5S8_CUT_OUT = SIGNAL_CUT_OUT + _words(
    "APN_AMBR_UL APN_AMBR_DL SGW_Port PGW_Port SGW_Control_TEID PGW_Control_TEID TAI ULI_Length"
)
S6A_CUT_OUT = SIGNAL_CUT_OUT + _words("MME_Port HSS_Port Subscriber_Status Application_ID")

#: Columns of the short publication shared by the user-plane feeds.
USER_CUT_HEAD = _words("""
IMSI MSISDN IMEI APN DestinationIP DestinationPort SourceIP SourcePort SGWIP MMEIP PGWIP ECGI
RATType
""")
USER_CUT_SESSION = (
    "XXX1 as DestinationType", "XXX2 as chargingID", "StartTime", "EndTime", "Duration",
    "InputOctets", "OutputOctets", "InputPacket", "OutputPacket",
)
S1U_CUT_TCP = _words("""
L4protocal ULTCPReorderingPacket DLTCPReorderingPacket ULTCP_RetransPacket DLTCP_RetransPacket
TCPSetupResponseDelay TCPSetupACKDelay Delay_Setup_FirstTransaction
Delay_FirstTransaction_FirstResPackt WindowSize MSSSize TCPSynNumber TCPConnetState SessionStopFlag
""")
COAP_CUT_OUT = _words("Version Uri_Port Destination_URI Host Proxy_URI Proxy_Scheme")

#: Key columns that come first when an early feed is published.
EARLY_KEYS = {
    "http_early": ("msisdn", "starttime", "endtime"),
    "s1mme": ("msisdn", "procedure_start_time", "procedure_end_time"),
    "s5s8_early": ("msisdn", "procedure_start_time", "procedure_end_time"),
    "s6a_early": ("mdnReverse", "msisdn", "procedure_start_time", "procedure_end_time"),
}
# End of fixed values.
# ---------------------------------------------------------------------------

HAS_NUMBER = "length(MSISDN) > 0"
NB_APN = "APN like '%ctnb%'"


def _without(columns: tuple[str, ...], out: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(c for c in columns if c not in out)


def _key_first(name: str, columns: tuple[str, ...]) -> tuple[str, ...]:
    keys = EARLY_KEYS[name]
    return (*keys, *_without(columns, keys))


def _http_columns() -> tuple[str, ...]:
    renamed = {"XXX1": "DestinationType", "XXX2": "chargingID", "TCPConnetState": "TCPConnectState"}
    return tuple(renamed.get(c, c) for c in S1U_COLUMNS)


def _user_feed(name: str, extra: tuple[str, ...], required: int, cut: tuple[str, ...], nb_only: bool) -> Feed:
    columns = S1U_COLUMNS + extra
    return Feed(
        name,
        columns,
        required=required,
        land_filter=f"{HAS_NUMBER} and {NB_APN}" if nb_only else HAS_NUMBER,
        profiles={"full": _without(columns, TTL_COLUMNS), "cut": cut},
    )


def _build() -> dict[str, Feed]:
    feeds: list[Feed] = [
        Feed(
            "http_early", HTTP_EARLY_COLUMNS, required=40, keep_trailing=False,
            profiles={"full": _key_first("http_early", HTTP_EARLY_COLUMNS)},
        ),
        Feed(
            "s1mme", S1MME_COLUMNS, required=38, keep_trailing=False, ints=("epsbearernumber",),
            tail=Tail("bearer_context", start=39, width=9, inner=",", outer="-"),
            profiles={"full": _key_first("s1mme", S1MME_COLUMNS + ("bearer_context",))},
        ),
        Feed(
            "s5s8_early", S5S8_EARLY_COLUMNS, required=42, keep_trailing=False, ints=("ulilength",),
            tail=Tail("bearerinfo", start=42, width=6, inner="-", outer=",", count_at=19),
            after=("home_province", "probeid"),
            profiles={
                "full": _key_first(
                    "s5s8_early", S5S8_EARLY_COLUMNS + ("bearerinfo", "home_province", "probeid")
                )
            },
        ),
        Feed(
            "s6a_early", S6A_EARLY_COLUMNS, required=39, keep_trailing=False, reversed_number="msisdn",
            profiles={"full": _key_first("s6a_early", ("mdnReverse",) + S6A_EARLY_COLUMNS)},
        ),
        Feed("gx", GX_COLUMNS, required=18, land_filter=HAS_NUMBER,
             profiles={"full": GX_COLUMNS, "cut": _without(GX_COLUMNS, SIGNAL_CUT_OUT)}),
        Feed("l2tp", L2TP_COLUMNS, required=30, land_filter=HAS_NUMBER,
             profiles={"full": _without(L2TP_COLUMNS, SIGNAL_CUT_OUT)}),
        Feed("s2a", S2A_COLUMNS, required=23, land_filter=HAS_NUMBER,
             profiles={"full": S2A_COLUMNS, "cut": _without(S2A_COLUMNS, S2A_CUT_OUT)}),
        Feed(
            "s5s8", S5S8_COLUMNS, required=29, ints=("EPS_Bearer_Number",),
            tail=Tail("Bearer_Context", start=29, width=8, inner=",", outer="-"),
            land_filter=HAS_NUMBER, publish_filter=f"{NB_APN} or RAT = '8'",
            profiles={
                "full": S5S8_COLUMNS + ("Bearer_Context",),
                "cut": _without(S5S8_COLUMNS, S5S8_CUT_OUT) + ("Bearer_Context",),
            },
        ),
        Feed("s6a", S6A_COLUMNS, required=28, land_filter=HAS_NUMBER,
             profiles={"full": S6A_COLUMNS, "cut": _without(S6A_COLUMNS, S6A_CUT_OUT)}),
        _user_feed(
            "s1u", (), 64, USER_CUT_HEAD + USER_CUT_SESSION + S1U_CUT_TCP + ("Roma_Province",), nb_only=True
        ),
        Feed("http", _http_columns() + HTTP_EXTRA, required=98, land_filter=HAS_NUMBER,
             profiles={"full": _http_columns() + HTTP_EXTRA}),
        Feed("http_100", _http_columns() + TTL_COLUMNS + HTTP_EXTRA, required=100, land_filter=HAS_NUMBER,
             profiles={"full": _http_columns() + HTTP_EXTRA}),
    ]
    coap_cut = (
        USER_CUT_HEAD + ("ProtocolID", "ServiceType") + USER_CUT_SESSION + ("Roma_Province",)
        + _without(COAP_EXTRA, COAP_CUT_OUT)
    )
    mqtt_cut = (
        USER_CUT_HEAD + ("ProtocolID", "ServiceType") + USER_CUT_SESSION + ("Roma_Province",)
        + _without(MQTT_EXTRA, ("Version",))
    )
    feeds += [
        _user_feed("coap", TTL_COLUMNS + COAP_EXTRA, 62, coap_cut, nb_only=False),
        _user_feed("coap_82", COAP_EXTRA, 62, coap_cut, nb_only=False),
        _user_feed("mqtt", TTL_COLUMNS + MQTT_EXTRA, 89, mqtt_cut, nb_only=True),
        _user_feed("mqtt_87", MQTT_EXTRA, 87, mqtt_cut, nb_only=True),
    ]
    return {f.name: f for f in feeds}


FEEDS: dict[str, Feed] = _build()

#: Fields of the 100-field HTTP line that the status extract keeps.
HTTP_STATUS_FIELDS = {
    "MSISDN": 2, "APN": 4, "StartTime": 20, "EndTime": 21, "DestinationIP": 5, "Host": 69,
    "UserAgent": 66, "HttpStatus": 75,
}
#: Fields of the same line that the probe audit keeps.
PROBE_AUDIT_FIELDS = {
    "StartTime": 20, "EndTime": 21, "MSISDN": 2, "IMSI": 1, "APN": 4, "PGWIP": 11, "UserIP": 7,
    "UserPort": 8, "SourceIP": 5, "SourcePort": 6,
}
PROBE_AUDIT_HOST, PROBE_AUDIT_URL = 69, 67


def split_lines(lines: DataFrame, feed: Feed, value: str = "value") -> DataFrame:
    """``_line, _f``: every line with its fields.

    The fields leave a generator, which filters do not pass: a condition on a
    parsed column reads the fields there are, where a plain projection would
    have it split the line again for every column it mentions.
    """
    return lines.select(F.col(value).alias("_line"), F.explode(F.array(feed.split(F.col(value)))).alias("_f"))


def parse_lines(
    lines: DataFrame, feed: Feed, value: str = "value", leading_separator: bool = False
) -> DataFrame:
    """Typed rows of the lines that have all required fields.

    ``leading_separator`` gives folded tails the separator in front of the
    first group, as found in tables published earlier.
    """
    split = split_lines(lines, feed, value).where(_complete(feed))
    fields = F.col("_f")
    out: dict[str, Column] = {}
    if feed.reversed_number:
        at = feed.columns.index(feed.reversed_number)
        out["mdnReverse"] = F.reverse(P.field(fields, at))
    for i, name in enumerate(feed.columns):
        if name in feed.ints:
            out[name] = lenient_int(P.field(fields, i))
        elif i >= feed.required:
            out[name] = P.optional_field(fields, i)
        else:
            out[name] = P.field(fields, i)
    if feed.tail:
        tail = feed.tail
        out[tail.column] = P.join_groups(_tail(feed), tail.inner, tail.outer, leading_separator)
        for i, name in enumerate(feed.after):
            out[name] = P.field(fields, _tail_end(feed) + i)
    return split.select(*[out[c].alias(c) for c in feed.output_columns])


def rejected_lines(lines: DataFrame, feed: Feed, value: str = "value") -> DataFrame:
    """The lines ``parse_lines`` leaves out, with their number of fields."""
    split = split_lines(lines, feed, value).where(~_complete(feed))
    return split.select(F.lit(feed.name).alias("feed"), F.size("_f").alias("n_fields"), F.col("_line").alias("line"))


def publication(df: DataFrame, feed: Feed, profile: str = "full") -> DataFrame:
    """Columns and names under which a landed feed is published."""
    return df.selectExpr(*feed.profiles[profile])


def pick_fields(lines: DataFrame, positions: dict[str, int], n_fields: int | None = None, value: str = "value") -> DataFrame:
    """Named fields by position; with ``n_fields`` only lines of exactly that
    many fields count."""
    split = lines.select(F.explode(F.array(P.split_keep(F.col(value)))).alias("_f"))
    if n_fields is not None:
        split = split.where(F.size("_f") == n_fields)
    return split.select(*[P.field(F.col("_f"), i).alias(c) for c, i in positions.items()])


def fill_missing(df: DataFrame) -> DataFrame:
    """Null text becomes ``-1`` in every column."""
    return df.select(*[fill_null(c).alias(c) for c in df.columns])


def _complete(feed: Feed) -> Column:
    size = F.size("_f")
    if feed.after:
        return size >= _tail_end(feed) + len(feed.after)
    return size >= feed.required


def _declared(feed: Feed) -> Column:
    return lenient_int(P.field(F.col("_f"), feed.tail.count_at))


def _tail(feed: Feed) -> Column:
    tail = feed.tail
    if tail.count_at is None:
        return P.tail_groups(F.col("_f"), tail.start, tail.width)
    return P.counted_groups(F.col("_f"), _declared(feed), tail.start, tail.width)


def _tail_end(feed: Feed) -> Column:
    tail = feed.tail
    groups = P.whole_groups(F.col("_f"), _declared(feed), tail.start, tail.width)
    return groups * tail.width + tail.start
