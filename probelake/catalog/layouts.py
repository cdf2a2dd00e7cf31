"""What the lines of each feed hold, field by field, stated apart from the parser so that its tables are checked against it."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Column names in field order, as the published tables have them.
_GX = """
Interface XDR_ID IMSI IMEI MSISDN RAT Home_Province Roma_Province Procedure_Type Procedure_Start_Time Procedure_End_Time
Procedure_Status Result_Code G3PPUserLocationInfo G3PP2BSID Machine_IP_Add_type PCEF_IP_Add PCRF_IP_Add
"""
_L2TP = """
Interface XDR_ID IMSI IMEI MSISDN RAT Home_Province Roma_Province Procedure_Type Procedure_Start_Time Procedure_End_Time
Procedure_Status LAC_IP LNS_IP LAC_TUNNEL_ID LNS_TUNNEL_ID SESSION_START_TIME SESSION_END_TIME LAC_SESSION_ID LNS_SESSION_ID
APN CallSerialNumber AUTH_TYPE AUTH_NAME AUTH_Status IPCP_User_IP IPCP_LNS_IP Result_Code Error_Code Error_Message
"""
_S2A = """
Interface XDR_ID IMSI IMEI MSISDN RAT Home_Province Roma_Province Procedure_Type Procedure_Start_Time Procedure_End_Time
Procedure_Status Result_Code APN G3PP2_BSID PCF_IP USER_IPv4 USER_IPv6 Machine_IP_Add_type HSGW_IP_Add PGW_IP_Add HSGW_Port
PGW_Port
"""
_S5S8 = """
Interface XDR_ID IMSI IMEI MSISDN RAT Home_Province Roma_Province Procedure_Type Procedure_Start_Time Procedure_End_Time
Procedure_Status Result_Code APN APN_AMBR_UL APN_AMBR_DL USER_IPv4 USER_IPv6 Machine_IP_Add_type SGW_IP_Add PGW_IP_Add
SGW_Port PGW_Port SGW_Control_TEID PGW_Control_TEID TAI ECGI ULI_Length ULI EPS_Bearer_Number
"""
_S6A = """
Interface XDR_ID IMSI IMEI MSISDN RAT Home_Province Roma_Province Procedure_Type Procedure_Start_Time Procedure_End_Time
Procedure_Status Result_Code Machine_IP_Add_type MME_Address HSS_Address MME_Port HSS_Port Subscriber_Status
Access_Restriction_Data Default_APN UE_AMBR_UL UE_AMBR_DL USER_IPv4 USER_IPv6 Origin_Host Destination_Host Application_ID
"""
_S6A_EARLY = """
interface_type xdr_id rat imsi imei msisdn procedure_type procedure_start_time procedure_end_time procedure_status cause
user_ip mme_address hss_address mmeport hssport originrealm destinationrealm originhost destinationhost applicationid
subscriberstatus accessrestrictiondata user_ipv4 user_ipv6 layer1id layer2id layer3id layer4id layer5id layer6id
machine_ip_add_type default_apn ue_ambr_ul ue_ambr_dl home_province visit_mcc visit_mnc probeid
"""
_S1MME = """
interface_type xdr_id imsi imei msisdn rat home_province procedure_type procedure_start_time procedure_end_time
procedure_status reqcausecode failcausecode keyparam mme_ue_siap_id guti target_id user_ipv4 user_ipv6 machine_ip_add_type
mme_sig_ip ran_ne_sig_ip mmeport enbport tai ecgi apn other_tac other_eci oldmmegroupid oldmmecode oldmtmsi mme_group_id
mme_code m_tmsi tmsi mme_ue_s1ap_id enodeb_id eci epsbearernumber
"""
_HTTP_EARLY = """
imsi msisdn imei apn destinationip destinationport sourceip sourceport sgw_ip mme_ip pgw_ip ecgi_temp tai_temp visitedplmnid
rattype protocolid servicetype_new starttime endtime duration inputoctets outputoctets inputpacket outputpacket
pdn_connectionid bearerid bearerqos recordclosecause useragent destinationurl_new domainname host contentlen contenttype
iflink refer httpaction httpstatus respdelay behaviortarget syntime synacktime acktime actiontime firstpackettime
pageopentime lastpacktime lastpacktime_tmp pagevolume
"""
_S1U = """
Interface IMSI MSISDN IMEI APN DestinationIP DestinationPort SourceIP SourcePort SGWIP MMEIP PGWIP ECGI TAI VisitedPLMNId
RATType ProtocolID ServiceType XXX1 XXX2 StartTime EndTime Duration InputOctets OutputOctets InputPacket OutputPacket
PDNConnectionId BearerID BearerQoS RecordCloseCause ENBIP SGWPort eNBPort eNBGTP_TEID SGWGTP_TEID PGWPort MME_UE_S1AP_ID
eNB_UE_S1AP_ID MME_Group_ID MME_Code eNB_ID Home_Province UserIP UserPort L4protocal AppServerIP AppServer_Port
ULTCPReorderingPacket DLTCPReorderingPacket ULTCP_RetransPacket DLTCP_RetransPacket TCPSetupResponseDelay TCPSetupACKDelay
ULIPFragPacks DLIPFragPacks Delay_Setup_FirstTransaction Delay_FirstTransaction_FirstResPackt WindowSize MSSSize
TCPSynNumber TCPConnetState SessionStopFlag Roma_Province
"""
_HTTP_HEAD = """
Interface IMSI MSISDN IMEI APN DestinationIP DestinationPort SourceIP SourcePort SGWIP MMEIP PGWIP ECGI TAI VisitedPLMNId
RATType ProtocolID ServiceType DestinationType chargingID StartTime EndTime Duration InputOctets OutputOctets InputPacket
OutputPacket PDNConnectionId BearerID BearerQoS RecordCloseCause ENBIP SGWPort eNBPort eNBGTP_TEID SGWGTP_TEID PGWPort
MME_UE_S1AP_ID eNB_UE_S1AP_ID MME_Group_ID MME_Code eNB_ID Home_Province UserIP UserPort L4protocal AppServerIP
AppServer_Port ULTCPReorderingPacket DLTCPReorderingPacket ULTCP_RetransPacket DLTCP_RetransPacket TCPSetupResponseDelay
TCPSetupACKDelay ULIPFragPacks DLIPFragPacks Delay_Setup_FirstTransaction Delay_FirstTransaction_FirstResPackt WindowSize
MSSSize TCPSynNumber TCPConnectState SessionStopFlag Roma_Province
"""
_HTTP_TAIL = """
UserAgent DestinationURL DomainName Host ContentLen ContentType IfLink Refer HttpAction HttpStatus ResDelay Behavior_Target
SYNtime SYNACKtime ACKtime ActionTime FirstPacketTime PageOpenTime Lastpacktime PageVolume HttpVersion FirstResptime
LastAcktime Cookie WtpFailType WtpFailCause title key_word WebBrowser FirstFINACKTime DNSQueryTime DNSResponseTime DNSFlowID
FirstScreenFinTime
"""
_TTL = "UP_TTL DOWN_TTL"
_COAP_TAIL = """
Version ProcedureType Token Requst_Action Response_result Status FirstRequestTime AckTime LastRequestTime Retrans_UL_Count
Retrans_DL_Count Direction Uri_Port Destination_URI Host Proxy_URI Proxy_Scheme MSGID
"""
_MQTT_TAIL = """
Version ProcedureType ClientID UserName MQTT KeepAlive DupFlag Qos Protocol_Name Topic_Name Topic2_Name Topic3_Name
Message_Action MsgActionAck MessageID RepeatCount MsgActionTime MsgActionAck_Time Pubreceived_Time Pubrelease_Time
PubComplete_Time Status Result
"""
# End of fixed values.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """``fields`` by position; ``unpublished`` ones are read and not published.

    Fields from ``required`` on may be absent and are ``'-1'`` then, unless the feed folds its last fields, from the one
    named ``bearers`` (a whole number) on, in groups of ``group`` into the column ``folded``.
    """

    fields: str
    required: int
    unpublished: str = ""
    number: bool = False
    access_point: bool = False
    bearers: str = ""
    folded: str = ""
    group: int = 0
    reversed_number: bool = False

    @property
    def names(self) -> list[str]:
        return self.fields.split()


LAYOUTS = {
    "gx": Layout(_GX, 18, number=True),
    "l2tp": Layout(_L2TP, 30, "Interface XDR_ID Home_Province", number=True),
    "s2a": Layout(_S2A, 23, number=True),
    "s5s8": Layout(_S5S8, 29, number=True, bearers="EPS_Bearer_Number", folded="Bearer_Context", group=8),
    "s6a": Layout(_S6A, 28, number=True),
    "s6a_early": Layout(_S6A_EARLY, 39, reversed_number=True),
    "s1mme": Layout(_S1MME, 38, bearers="epsbearernumber", folded="bearer_context", group=9),
    "http_early": Layout(_HTTP_EARLY, 40),
    "s1u": Layout(_S1U, 64, number=True, access_point=True),
    "http": Layout(_HTTP_HEAD + _HTTP_TAIL, 98, number=True),
    "http_100": Layout(f"{_HTTP_HEAD} {_TTL} {_HTTP_TAIL}", 100, _TTL, number=True),
    "coap": Layout(f"{_S1U} {_TTL} {_COAP_TAIL}", 62, _TTL, number=True),
    "coap_82": Layout(_S1U + _COAP_TAIL, 62, number=True),
    "mqtt": Layout(f"{_S1U} {_TTL} {_MQTT_TAIL}", 89, _TTL, number=True, access_point=True),
    "mqtt_87": Layout(_S1U + _MQTT_TAIL, 87, number=True, access_point=True),
}
