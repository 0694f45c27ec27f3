"""Column layouts of the bid log, its dictionaries and the serving table."""

from __future__ import annotations

from pyspark.sql import types as T

# The bid-log file format.  Field names, types and their order in each layout are given
# by the data files and must not be changed.
FIELD_TYPES = {
    "bid_id": T.StringType(),
    "timestamp": T.StringType(),
    "ipinyou_id": T.StringType(),
    "user_agent": T.StringType(),
    "ip": T.StringType(),
    "region": T.IntegerType(),
    "city_id": T.IntegerType(),
    "ad_exchange_id": T.IntegerType(),
    "domain": T.StringType(),
    "url": T.StringType(),
    "anonymous_url_id": T.StringType(),
    "ad_slot_id": T.StringType(),
    "ad_slot_width": T.IntegerType(),
    "ad_slot_height": T.IntegerType(),
    "ad_slot_visibility": T.IntegerType(),
    "ad_slot_format": T.IntegerType(),
    "ad_slot_floor_price": T.LongType(),
    "creative_id": T.StringType(),
    "bidding_price": T.FloatType(),
    "paying_price": T.FloatType(),
    "key_page_url": T.StringType(),
    "advertiser_id": T.LongType(),
    "user_tags": T.StringType(),
    "log_type_id": T.IntegerType(),
    "predict": T.StringType(),
}

# Column order of the raw layout (24 fields).
RAW_LAYOUT = (
    "bid_id timestamp log_type_id ipinyou_id user_agent ip region city_id ad_exchange_id domain url "
    "anonymous_url_id ad_slot_id ad_slot_width ad_slot_height ad_slot_visibility ad_slot_format "
    "ad_slot_floor_price creative_id bidding_price paying_price key_page_url advertiser_id user_tags"
).split()

# Column order of the stream layout (23 fields).
STREAM_LAYOUT = (
    "bid_id timestamp ipinyou_id user_agent ip region city_id ad_exchange_id domain url anonymous_url_id "
    "ad_slot_id ad_slot_width ad_slot_height ad_slot_visibility ad_slot_format ad_slot_floor_price "
    "creative_id bidding_price advertiser_id user_tags log_type_id paying_price"
).split()

# The batch layout is the stream layout with the prediction last.
BATCH_LAYOUT = [*STREAM_LAYOUT, "predict"]


def layout_schema(layout: list[str]) -> T.StructType:
    """Typed schema of a layout."""
    return T.StructType([T.StructField(name, FIELD_TYPES[name], True) for name in layout])


def all_string(schema: T.StructType) -> T.StructType:
    """The same columns, all of type string."""
    return T.StructType([T.StructField(f.name, T.StringType(), f.nullable) for f in schema.fields])


RAW_SCHEMA = layout_schema(RAW_LAYOUT)
STREAM_SCHEMA = layout_schema(STREAM_LAYOUT)
BATCH_SCHEMA = layout_schema(BATCH_LAYOUT)

# Dictionary file layouts.
AD_EXCHANGE_DDL = "ad_exchange_id int, ad_exchange_name string, ad_exchange_desc string"
LOG_TYPE_DDL = "log_type_id int, log_type_name string"
CITY_DDL = (
    "city_id int, city_name string, state_id int, population bigint, area float, density float, "
    "latitude float, longitude float"
)
STATE_DDL = "state_id int, state_name string, state_population bigint, state_gsp bigint"
SITE_PAGES_DDL = "site_page_id bigint, site_page_url string, site_page_tag string"
PROFILE_TAGS_DDL = (
    "user_profile_tag_id bigint, user_profile_tag_value string, user_profile_tag_price_type string, "
    "user_profile_tag_match_type string, user_profile_tag_dest_url string"
)

# Columns of an enriched row taken from the bid log and from each dictionary.
SERVED_BID_COLUMNS = (
    "bid_id timestamp ipinyou_id user_agent ip domain url anonymous_url_id ad_slot_id ad_slot_width "
    "ad_slot_height ad_slot_visibility ad_slot_format ad_slot_floor_price creative_id bidding_price "
    "advertiser_id paying_price"
).split()
SERVED_DICTIONARY_COLUMNS = (
    "ad_exchange_name ad_exchange_desc log_type_name city_name population area density coordinates "
    "state_name state_population state_gsp keyword_name"
).split()

# Feature column of each log type that counts as user history.
FEATURE_OF_LOG_TYPE = {
    "bid-click": "bid_click_kw",
    "site-open": "site_open_kw",
    "site-search": "site_search_kw",
    "site-click": "site_click_kw",
    "site-lead": "site_lead_kw",
}
FEATURE_COLUMNS = list(FEATURE_OF_LOG_TYPE.values())

# User-agent columns of an enriched row.
UA_COLUMNS = (
    "ua_browser ua_browser_group ua_browser_manufacturer ua_browser_rendering_engine ua_browser_version "
    "ua_browser_version_minor ua_browser_version_major ua_id ua_os ua_os_name ua_os_device ua_os_group "
    "ua_os_manufacturer"
).split()
PREDICTION_COLUMNS = ["predict", "false_prob", "true_prob"]

# The ten columns the serving table is usually read with.
SERVING_REPORT_COLUMNS = (
    "ipinyou_id timestamp site_click_kw site_lead_kw site_open_kw site_search_kw bid_click_kw false_prob "
    "true_prob predict"
).split()
SERVING_KEY = ["ipinyou_id", "timestamp"]

# Columns of a message source; the Kafka source has them all.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
