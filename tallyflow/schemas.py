"""Record schemas."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

_TYPES = {"string": StringType, "int": IntegerType, "bigint": LongType, "double": DoubleType}


def record(columns: str) -> StructType:
    """Schema from ``name type, ...`` text; unlike DDL parsing it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]()) for name, kind in pairs])


SEARCH_LOG = record(
    "query_time string, user_id string, query_words string, result_rank int, click_rank int, click_url string"
)
RATING = record("user_id string, item_id string, rating double, rated_at bigint")
PERSON = record("name string, age int, hobby string")
CALL_LOG = record(
    "station_id string, call_out string, call_in string, call_status string, call_time bigint, duration bigint"
)
IP_RANGE = record("ip_from bigint, ip_to bigint, province string, city string")
REGION_BLOCK = record(
    "level int, block bigint, piece_from bigint, piece_to bigint, province string, city string, octet int, edition int"
)
TOPIC_RECORD = record("key string, value string")

# Payload fields are read as text and cast afterwards, so one badly typed field nulls itself only.
DEVICE_SIGNAL = record("device string, deviceType string, signal string, time string")
USER_EVENT = record("eventTime string, eventType string, userID string")
RAW_ORDER = record(
    "orderId string, userId string, orderTime string, ip string, orderMoney string, orderStatus string"
)
ORDER = record(
    "orderId string, userId string, orderTime string, ip string, orderMoney string, orderStatus string, "
    "province string, city string"
)

# The column names and types of the ad-event record, in table order.
AD_EVENT_SOURCE = record(
    """
    adcreativeid bigint, adorderid bigint, adpayment double, adplatformkey string,
    adplatformproviderid bigint, adppprice double, adprice double, adspacetype bigint,
    adspacetypename string, advertisersid bigint, adxrate double, age string, agentrate double,
    ah bigint, androidid string, androididmd5 string, androididsha1 string, appid string,
    appname string, apptype bigint, aw bigint, bidfloor double, bidprice double,
    callbackdate string, channelid string, cityname string, client bigint, cnywinprice double,
    cur string, density string, device string, devicetype bigint, district string, email string,
    idfa string, idfamd5 string, idfasha1 string, imei string, imeimd5 string, imeisha1 string,
    initbidprice double, ip string, iptype bigint, isbid bigint, isbilling bigint,
    iseffective bigint, ispid bigint, ispname string, isqualityapp bigint, iswin bigint,
    keywords string, lang string, lat string, lomarkrate double, mac string, macmd5 string,
    macsha1 string, mediatype bigint, networkmannerid bigint, networkmannername string,
    openudid string, openudidmd5 string, openudidsha1 string, osversion string, paymode bigint,
    ph bigint, processnode bigint, provincename string, putinmodeltype bigint, pw bigint,
    rate double, realip string, reqdate string, reqhour string, requestdate string,
    requestmode bigint, rtbcity string, rtbdistrict string, rtbprovince string, rtbstreet string,
    sdkversion string, sessionid string, sex string, storeurl string, tagid string, tel string,
    title string, userid string, uuid string, uuidunknow string, winprice double
    """
)
AD_EVENT = StructType(
    [*AD_EVENT_SOURCE.fields, *record("province string, city string, date_str string").fields]
)
