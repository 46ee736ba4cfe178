"""Input schemas, output column lists and the fixed values of the data model."""

from __future__ import annotations

STRING, FLOAT64, INT64 = "STRING", "FLOAT64", "INT64"
SPARK_TYPE = {STRING: "string", FLOAT64: "double", INT64: "bigint"}
LOGICAL_TYPE = {"string": STRING, "double": FLOAT64, "bigint": INT64}


def _columns(text: str) -> dict[str, str]:
    """Flat ``name type`` list as an ordered mapping."""
    return dict(part.split() for part in text.split(","))


def ddl(columns: dict[str, str]) -> str:
    """Spark DDL text of a column mapping."""
    quoted = {name: name.replace("`", "``") for name in columns}
    return ", ".join(f"`{quoted[name]}` {kind}" for name, kind in columns.items())


# ---------------------------------------------------------------------------
# Input: nested event export and user snapshot
# ---------------------------------------------------------------------------

PARAM_VALUE = "string_value:string,int_value:bigint,float_value:double,double_value:double"
PARAMS = f"array<struct<key:string,value:struct<{PARAM_VALUE}>>>"
USER_PROPERTIES = (
    f"array<struct<key:string,value:struct<{PARAM_VALUE},set_timestamp_micros:bigint>>>"
)
ITEM_FIELDS = {
    "item_id": "string",
    "item_name": "string",
    "item_brand": "string",
    "item_variant": "string",
    "item_category": "string",
    "item_category2": "string",
    "item_category3": "string",
    "item_category4": "string",
    "item_category5": "string",
    "price": "double",
    "quantity": "bigint",
    "coupon": "string",
    "affiliation": "string",
    "location_id": "string",
    "item_list_id": "string",
    "item_list_name": "string",
    "item_list_index": "string",
    "promotion_id": "string",
    "promotion_name": "string",
    "creative_name": "string",
    "creative_slot": "string",
}
ITEM = ",".join(f"{name}:{kind}" for name, kind in ITEM_FIELDS.items())
ITEMS = f"array<struct<{ITEM},item_params:{PARAMS}>>"
EVENTS = {
    "shard": "string",
    "event_date": "string",
    "event_timestamp": "bigint",
    "event_name": "string",
    "user_pseudo_id": "string",
    "user_id": "string",
    "event_params": PARAMS,
    "user_properties": USER_PROPERTIES,
    "items": ITEMS,
    "device": (
        "struct<category:string,mobile_brand_name:string,mobile_model_name:string,"
        "operating_system:string,operating_system_version:string,browser:string,"
        "language:string,web_info:struct<browser:string,hostname:string>>"
    ),
    "geo": (
        "struct<continent:string,sub_continent:string,country:string,region:string,"
        "city:string>"
    ),
    "traffic_source": "struct<source:string,medium:string,name:string>",
    "collected_traffic_source": (
        "struct<manual_source:string,manual_medium:string,manual_campaign_name:string,"
        "manual_term:string,manual_content:string,gclid:string>"
    ),
    "privacy_info": "struct<analytics_storage:string>",
    "app_info": "struct<id:string,version:string>",
    "platform": "string",
    "ecommerce": "struct<purchase_revenue:double>",
}
USERS = {
    "shard": "string",
    "pseudo_user_id": "string",
    "user_id": "string",
    "user_info": (
        "struct<last_active_timestamp_micros:bigint,user_first_touch_timestamp_micros:bigint>"
    ),
    "device": "struct<category:string,mobile_brand_name:string,operating_system:string>",
    "geo": "struct<country:string,region:string,city:string>",
    "user_properties": (
        "array<struct<key:string,value:struct<user_property_name:string,"
        "set_timestamp_micros:bigint,string_value:string>>>"
    ),
    "audiences": (
        "array<struct<id:bigint,name:string,membership_start_timestamp_micros:bigint,"
        "membership_expiry_timestamp_micros:bigint,npa:boolean>>"
    ),
}

# ---------------------------------------------------------------------------
# These must equal the data model's own lists for right results.
# ---------------------------------------------------------------------------

# Declared type of well-known parameters.
DECLARED_TYPES = {
    "percent_scrolled": FLOAT64,
    "link_url": STRING,
    "link_id": STRING,
    "link_classes": STRING,
    "link_domain": STRING,
    "outbound": STRING,
    "search_term": STRING,
    "file_extension": STRING,
    "file_name": STRING,
    "video_provider": STRING,
    "video_title": STRING,
    "video_url": STRING,
    "video_current_time": FLOAT64,
    "video_duration": FLOAT64,
    "video_percent": FLOAT64,
    "visible": STRING,
    "value": FLOAT64,
    "currency": STRING,
    "transaction_id": STRING,
    "tax": FLOAT64,
    "shipping": FLOAT64,
    "coupon": STRING,
    "payment_type": STRING,
    "shipping_tier": STRING,
    "affiliation": STRING,
    "item_id": STRING,
    "item_name": STRING,
    "item_brand": STRING,
    "item_variant": STRING,
    "item_category": STRING,
    "item_category2": STRING,
    "item_category3": STRING,
    "item_category4": STRING,
    "item_category5": STRING,
    "price": FLOAT64,
    "quantity": INT64,
    "discount": FLOAT64,
    "promotion_id": STRING,
    "promotion_name": STRING,
    "creative_name": STRING,
    "creative_slot": STRING,
    "location_id": STRING,
    "method": STRING,
    "content_type": STRING,
    "level": INT64,
    "score": INT64,
    "virtual_currency_name": STRING,
    "character": STRING,
    "group_id": STRING,
    "achievement_id": STRING,
    "page_location": STRING,
    "page_referrer": STRING,
    "page_title": STRING,
    "engagement_time_msec": INT64,
    "ga_session_id": INT64,
    "ga_session_number": INT64,
}

# Event names of each category; any other name is custom.
EVENT_CATEGORIES = {
    "auto": ["first_visit", "session_start", "user_engagement"],
    "enhanced": [
        "page_view", "scroll", "click", "view_search_results", "file_download",
        "video_start", "video_progress", "video_complete", "form_start", "form_submit",
    ],
    "recommended": [
        "purchase", "add_to_cart", "begin_checkout", "add_payment_info", "add_shipping_info",
        "view_item", "view_item_list", "select_item", "view_promotion", "select_promotion",
        "remove_from_cart", "view_cart", "refund", "login", "sign_up", "search",
        "level_start", "level_end", "level_up",
    ],
}

# Parameter names of each category; clarity_* is martech, the rest custom.
PARAM_CATEGORIES = {
    "auto": [
        "page_location", "page_title", "page_referrer", "engaged_session_event",
        "engagement_time_msec", "campaign", "campaign_id", "campaign_source",
        "campaign_medium", "campaign_term", "campaign_content", "source", "medium", "term",
        "content", "gclid", "dclid", "srsltid", "gad_source", "gad_campaignid",
    ],
    "enhanced": [
        "percent_scrolled", "search_term", "unique_search_term", "link_url", "link_domain",
        "link_classes", "link_id", "link_text", "outbound", "file_extension", "file_name",
        "video_current_time", "video_duration", "video_percent", "video_provider",
        "video_title", "video_url", "visible", "form_destination", "form_id", "form_name",
        "form_submit_text",
    ],
    "recommended": [
        "transaction_id", "value", "tax", "shipping", "currency", "coupon", "affiliation",
        "payment_type", "shipping_tier", "level", "level_name", "character", "score",
        "achievement_id", "group_id", "content_type", "content_id", "virtual_currency_name",
        "success", "method", "item_list_id", "item_list_name", "creative_name",
        "creative_slot", "location_id", "promotion_id", "promotion_name",
    ],
}

# Parameters that never enter the registry, and the dropped event.
EXCLUDED_PARAMS = [
    "ga_session_id", "ga_session_number", "session_engaged", "entrances", "batch_page_id",
    "batch_ordering_id", "ignore_referrer", "debug_mode",
]
DROPPED_EVENT = "fetch_user_data"

# Parameter-name patterns kept out of the wide tables.
HIDDEN_PATTERNS = ["batch_%", "clarity_%"]
HIDDEN_PARAM = "gclid"

# The always-registered pair, look-back and replay address.
ALWAYS_REGISTERED = ("search", "search_term", STRING)
LOOKBACK_DAYS = 180
REPLAY_PREFIX = "https://clarity.microsoft.com/player/"

# Wording of log rows.
REASON_TYPE_UNIFIED = "values of several types; the widest type of text, float, integer counts"
REASON_ITEM_TYPE_UNIFIED = "item values of several types; the widest of text, float, integer counts"
REASON_PARAM_ADDED = "new event parameter"
REASON_ITEM_PARAM_ADDED = "new item parameter"
REASON_INTEGRATED = "new event parameter became a column"

# ---------------------------------------------------------------------------
# Output tables (fixed values: table and column names)
# ---------------------------------------------------------------------------

STANDARD_COLUMNS = [
    "event_timestamp_micros", "device_category", "mobile_brand_name", "mobile_model_name",
    "operating_system", "operating_system_version", "browser", "device_language", "hostname",
    "hostname_norm", "continent", "sub_continent", "country", "region", "city",
    "traffic_source", "traffic_medium", "traffic_campaign", "collected_source",
    "collected_medium", "collected_campaign", "analytics_storage", "platform", "gclid",
    "is_key_event",
]
EVENT_TABLE_HEAD = _columns(
    "user_pseudo_id string, user_id string, ga_session_id bigint, "
    "pseudonymous_session_id string, page_view_id string, event_timestamp timestamp_ntz, "
    "event_date date, is_identified_user boolean, clarity_play_url string"
)
MICRO_USER_HEAD = _columns(
    "event_date date, event_timestamp timestamp_ntz, event_timestamp_micros bigint, "
    "event_name string, user_pseudo_id string, user_id string, is_identified_user boolean, "
    "ga_session_id bigint, pseudonymous_session_id string, page_view_id string, "
    "is_key_event bigint, event_id string, session_event_no bigint, user_event_no bigint, "
    "clarity_play_url string, device_category string, mobile_brand_name string, "
    "mobile_model_name string, operating_system string, operating_system_version string, "
    "browser string, device_language string, hostname string, hostname_norm string, "
    "prev_hostname_norm string, next_hostname_norm string, is_cross_domain_hop boolean, "
    "continent string, sub_continent string, country string, region string, city string, "
    "traffic_source string, traffic_medium string, traffic_campaign string, "
    "collected_source string, collected_medium string, collected_campaign string, "
    "analytics_storage string, platform string, gclid string, prev_event_name string, "
    "seconds_from_prev_event bigint, max_scroll_percent bigint"
)
USER_DATE_COLUMNS = _columns(
    "last_active_timestamp timestamp, last_active_date date, "
    "first_touch_timestamp timestamp, first_touch_date date, "
    "updated_at timestamp, source_table_date date"
)
BATCH_ID = _columns("batch_id string")
MICRO_USER_FIXED = MICRO_USER_HEAD | USER_DATE_COLUMNS | BATCH_ID
MICRO_ITEMS_HEAD = _columns(
    "event_date date, event_timestamp timestamp_ntz, event_timestamp_micros bigint, "
    "event_name string, user_pseudo_id string, user_id string, is_identified_user boolean, "
    "ga_session_id bigint, pseudonymous_session_id string, transaction_id string, "
    "ecommerce_total_value double, item_index bigint, item_id string, item_name string, "
    "item_brand string, item_variant string, item_category string, item_category2 string, "
    "item_category3 string, item_category4 string, item_category5 string, price double, "
    "quantity bigint, coupon string, item_subtotal double, affiliation string, "
    "location_id string, item_list_id string, item_list_name string, item_list_index string, "
    "promotion_id string, promotion_name string, creative_name string, creative_slot string, "
    "event_id string, item_event_no bigint, device_category string, "
    "mobile_brand_name string, operating_system string, browser string, "
    "device_language string, hostname string, continent string, sub_continent string, "
    "country string, region string, city string, analytics_storage string, "
    "platform string, is_key_event bigint"
)
MICRO_ITEMS_TAIL = _columns(
    "page_location string, traffic_source string, traffic_medium string, "
    "traffic_campaign string, created_at timestamp_ntz, batch_id string"
)
MICRO_ITEMS_FIXED = MICRO_ITEMS_HEAD | MICRO_ITEMS_TAIL

EVENT_PARAM_REGISTRY = _columns(
    "event_name string, param_name string, data_type string, micro_column_name string, "
    "event_category string, param_category string, created_at timestamp"
)
ITEM_PARAM_REGISTRY = _columns(
    "param_name string, data_type string, micro_column_name string, created_at timestamp"
)
SCHEMA_HISTORY = _columns(
    "executed_at timestamp, column_name string, data_type string, reason string"
)
SCHEMA_AUDIT = _columns(
    "column_name string, status string, reason string, original_data_types string, "
    "events_involved string"
)
INTEGRATED_COLUMNS = _columns(
    "source_table string, integrated_column string, reason string, processed_at timestamp"
)
IDENTITY_MAP = _columns(
    "user_pseudo_id string, user_id string, first_touch_date date, created_at timestamp"
)
SLOT_REGISTRY = _columns(
    "slot_key string, user_property_name string, last_set_timestamp timestamp, "
    "last_set_date date, source_table_date date, lookback_start_date date, "
    "lookback_end_date date, created_at timestamp"
)
USER_ATTRIBUTES_HEAD = _columns(
    "user_pseudo_id string, user_id string, last_active_timestamp timestamp, "
    "last_active_date date, first_touch_timestamp timestamp, first_touch_date date, "
    "country string, region string, city string, device_category string, "
    "mobile_brand_name string, operating_system string"
)
USER_ATTRIBUTES_TAIL = _columns("updated_at timestamp, source_table_date date")
AUDIENCE_LOG = _columns(
    "user_pseudo_id string, user_id string, audience_id string, audience_name string, "
    "membership_start_timestamp timestamp, membership_expiry_timestamp timestamp, "
    "npa boolean, pseudonymous_session_id string, source_table_date date, created_at timestamp"
)
USER_PROPERTY_LOG = _columns(
    "user_pseudo_id string, user_id string, property_key string, "
    "property_value_string string, property_value_int bigint, property_value_float double, "
    "set_timestamp timestamp, set_date date, event_timestamp timestamp_ntz, "
    "event_name string, ga_session_id bigint, pseudonymous_session_id string, "
    "source_event_date date, created_at timestamp"
)
PROPERTY_SUMMARY = _columns(
    "property_key string, resolved_type string, unique_users bigint, total_records bigint, "
    "first_seen timestamp, last_seen timestamp"
)
FAILED_VALUES = _columns(
    "batch_id string, executed_at timestamp, event_name string, param_name string, "
    "data_type string, lost bigint"
)
PROPERTY_STATE = _columns(
    "property_key string, texts bigint, floats bigint, integers bigint, total_records bigint, "
    "first_seen timestamp, last_seen timestamp, unique_users bigint"
)
RUN_LOG = _columns(
    "batch_id string, executed_at timestamp, start_date string, end_date string, "
    "phase_0_status string, phase_1_status string, phase_2_status string, "
    "phase_3a_status string, phase_3b_status string, is_force_reset boolean, "
    "is_incremental boolean, total_rows bigint, execution_time_seconds double, "
    "processor_version string, client_id string"
)
SNAPSHOT_LOG = _columns(
    "snapshot_at timestamp, trigger_type string, start_date string, end_date string, "
    "is_force_reset boolean, is_incremental boolean, pre_change_fields string, "
    "post_change_fields string, rerun_force_reset boolean, mst_event_params_cnt bigint, "
    "mst_item_params_cnt bigint, micro_user_columns_cnt bigint, "
    "micro_items_columns_cnt bigint, client_id string, created_by string"
)
