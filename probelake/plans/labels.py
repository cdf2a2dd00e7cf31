"""Labels under which results are published."""

BEARER_SETUP_RATE = "承载建立成功率"
LOCATION_UPDATE_RATE = "HSS位置更新成功率"
COAP_UP_RATE = "NB上行成功率"
COAP_DOWN_RATE = "NB下行成功率"
COAP_DOWN_DELAY = "NB下行时延"
CREATE_SESSION_COUNT = "S5-C_CreateSession次数"
NATIONAL = "全国"
UNKNOWN = "未知"
