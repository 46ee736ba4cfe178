"""Driver tables in the nested event-export schema (for registered queries, bench, tests).

Every row becomes one event by itself, so the adapter shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schema as S

PLAIN_NAMES = {"view": "page_view"}
RICH_NAMES = {"view": "page_view", "click": "scroll", "signup": "session_start"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def value_struct(text: str = "NULL", integer: str = "NULL", number: str = "NULL") -> str:
    return (
        f"named_struct('string_value', cast({text} as string), "
        f"'int_value', cast({integer} as bigint), 'float_value', cast(NULL as double), "
        f"'double_value', cast({number} as double))"
    )


def param(key: str, value: str) -> str:
    return f"named_struct('key', '{key}', 'value', {value})"


def struct(**fields: str) -> str:
    inner = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"named_struct({inner})"


NO_TEXT = "cast(NULL as string)"


def web_events(
    spark: SparkSession, sf_dir: str, names: dict[str, str] = PLAIN_NAMES
) -> DataFrame:
    """The ``events`` table as a nested event export.

    One session per user and UTC day, none when k mod 50 is 49. Parameters:
    ``ga_session_id``, ``k`` (integer), ``value`` (double), ``rank`` (integer on views and
    clicks, double on purchases, text on the rest), ``page_location``; on clicks
    ``percent_scrolled``; on sign-ups the replay ids, of which the session's is missing
    when k is a multiple of five. Sign-ups carry a user id.
    """
    renames = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in names.items())
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type AS kind",
        "value AS number",
        "user_id AS member",
        f"CASE event_type {renames} ELSE event_type END AS event_name",
        "unix_micros(cast(ts AS timestamp)) AS micros",
        "unix_micros(date_trunc('DAY', cast(ts AS timestamp))) AS day_micros",
        "date_format(ts, 'yyyyMMdd') AS shard",
        "cast(datediff(to_date(ts), DATE '2024-01-01') AS bigint) AS day_no",
        "cast(get_json_object(props, '$.k') AS bigint) AS k",
    )
    rank_text = value_struct(text="concat('r', k)")
    rank = (
        f"CASE WHEN kind IN ('view', 'click') THEN {value_struct(integer='k')} "
        f"WHEN kind = 'purchase' THEN {value_struct(number='number')} ELSE {rank_text} END"
    )
    common = ", ".join(
        [
            param("ga_session_id", value_struct(integer="CASE WHEN k % 50 <> 49 THEN day_no END")),
            param("k", value_struct(integer="k")),
            param("value", value_struct(number="number")),
            param("rank", rank),
            param("page_location", value_struct(text="concat('/p/', k % 10)")),
        ]
    )
    scroll = param("percent_scrolled", value_struct(integer="k"))
    replay = ", ".join(
        [
            param("clarity_project_id", value_struct(text="'prj'")),
            param("clarity_user_id", value_struct(text="member")),
            param(
                "clarity_session_id",
                value_struct(text="CASE WHEN k % 5 <> 0 THEN concat('s', k) END"),
            ),
        ]
    )
    params = (
        f"CASE kind WHEN 'click' THEN array({common}, {scroll}) "
        f"WHEN 'signup' THEN array({common}, {replay}) ELSE array({common}) END"
    )

    def setting(key: str, text: str, integer: str, at: str) -> str:
        value = value_struct(text=text, integer=integer)[:-1] + f", 'set_timestamp_micros', {at})"
        return param(key, value)

    plan = setting("plan", "concat('t', k % 3)", "NULL", "day_micros")
    visits = setting("visits", "NULL", "k", "CASE WHEN kind = 'purchase' THEN micros END")
    host = "CASE k % 3 WHEN 0 THEN 'www.a.test' WHEN 1 THEN 'A.test' ELSE 'b.test' END"
    device = struct(
        category="CASE WHEN k % 2 = 0 THEN 'desktop' ELSE 'mobile' END",
        mobile_brand_name=NO_TEXT,
        mobile_model_name=NO_TEXT,
        operating_system="'os'",
        operating_system_version="'1'",
        browser="'app'",
        language="'en'",
        web_info=struct(browser="CASE WHEN k % 4 <> 0 THEN 'web' END", hostname=host),
    )
    geo = struct(
        continent=NO_TEXT, sub_continent=NO_TEXT, country="'JP'", region=NO_TEXT, city=NO_TEXT
    )
    collected = struct(
        manual_source="'csrc'",
        manual_medium=NO_TEXT,
        manual_campaign_name=NO_TEXT,
        manual_term=NO_TEXT,
        manual_content=NO_TEXT,
        gclid="CASE WHEN k % 7 = 0 THEN 'g' END",
    )
    return rows.selectExpr(
        "shard",
        "shard AS event_date",
        "micros AS event_timestamp",
        "event_name",
        "concat('u', member) AS user_pseudo_id",
        "CASE WHEN kind = 'signup' THEN concat('m', member) END AS user_id",
        f"{params} AS event_params",
        f"array({plan}, {visits}) AS user_properties",
        f"cast(NULL AS {S.ITEMS}) AS items",
        f"{device} AS device",
        f"{geo} AS geo",
        f"{struct(source=repr('src'), medium=repr('med'), name=NO_TEXT)} AS traffic_source",
        f"{collected} AS collected_traffic_source",
        "named_struct('analytics_storage', 'Yes') AS privacy_info",
        f"{struct(id=NO_TEXT, version=NO_TEXT)} AS app_info",
        "'WEB' AS platform",
        "named_struct('purchase_revenue', cast(NULL AS double)) AS ecommerce",
        "event_id AS source_id",
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``lineitem`` row as one e-commerce event with two items.

    The user is the supplier number, the session the order number. The second item has no
    quantity. Item parameters: line status (text), tax (double), line number (integer) and
    ``mix`` (integer on even lines, double on odd ones).
    """
    item_params = ", ".join(
        [
            param("status", value_struct(text="l_linestatus")),
            param("tax", value_struct(number="l_tax")),
            param("line", value_struct(integer="l_linenumber")),
            param(
                "mix",
                f"CASE WHEN l_linenumber % 2 = 0 THEN {value_struct(integer='l_linenumber')} "
                f"ELSE {value_struct(number='l_tax')} END",
            ),
        ]
    )

    def item(item_id: str, price: str, quantity: str) -> str:
        given = {"item_id": item_id, "price": price, "quantity": quantity}
        fields = {
            name: f"cast({given.get(name, 'NULL')} AS {kind})"
            for name, kind in S.ITEM_FIELDS.items()
        }
        return struct(**fields, item_params=f"array({item_params})")

    bought = item("concat('i', l_partkey)", "l_extendedprice", "l_quantity")
    gift = item("concat('gift', l_partkey % 10)", "l_discount", "NULL")
    params = ", ".join(
        [
            param("ga_session_id", value_struct(text="l_orderkey")),
            param("transaction_id", value_struct(text="concat('t', l_orderkey)")),
        ]
    )
    given = {
        "shard": "date_format(l_shipdate, 'yyyyMMdd')",
        "event_date": "date_format(l_shipdate, 'yyyyMMdd')",
        "event_timestamp": "unix_micros(cast(l_shipdate AS timestamp)) + l_linenumber",
        "event_name": (
            "CASE l_returnflag WHEN 'R' THEN 'refund' WHEN 'A' THEN 'add_to_cart' "
            "ELSE 'purchase' END"
        ),
        "user_pseudo_id": "concat('u', l_suppkey)",
        "event_params": f"array({params})",
        "items": f"array({bought}, {gift})",
    }
    return table(spark, sf_dir, "lineitem").selectExpr(
        *[f"cast({given.get(name, 'NULL')} AS {kind}) AS {name}" for name, kind in S.EVENTS.items()]
    )


def customer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as user snapshots: two shards per customer."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    rows = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]).selectExpr(
        "*",
        "explode(array('20240129', '20240130')) AS shard",
        "1700000000000000 + c_custkey AS fixed_start",
        "1700000000000000 + c_custkey * 1000000 AS base",
    )
    rows = rows.selectExpr("*", "shard = '20240129' AS is_old")

    def slot(key: str, name: str, text: str) -> str:
        value = struct(
            user_property_name=name,
            set_timestamp_micros="base + if(is_old, 0, 1)",
            string_value=text,
        )
        return param(key, value)

    def audience(number: str, start: str) -> str:
        return struct(
            id=f"cast({number} AS bigint)",
            name=f"concat('aud', {number})",
            membership_start_timestamp_micros=start,
            membership_expiry_timestamp_micros=f"{start} + 1000000",
            npa="c_custkey % 2 = 0",
        )

    slots = ", ".join(
        [
            slot("slot1", "if(is_old, 'market', 'market seg')", "if(is_old, 'old', c_mktsegment)"),
            slot("slot2", "'balance'", "cast(floor(c_acctbal) AS string)"),
        ]
    )
    audiences = ", ".join(
        [audience("c_custkey % 5", "fixed_start"), audience("7", "fixed_start + if(is_old, 0, 1)")]
    )
    user_info = struct(
        last_active_timestamp_micros="base + if(is_old, 5, 6)",
        user_first_touch_timestamp_micros="base - if(is_old, 5, 4)",
    )
    return rows.selectExpr(
        "shard",
        "concat('u', c_custkey) AS pseudo_user_id",
        "CASE WHEN c_custkey % 3 = 0 THEN concat('c', c_custkey) END AS user_id",
        f"{user_info} AS user_info",
        f"{struct(category=repr('desktop'), mobile_brand_name=NO_TEXT, operating_system=repr('os'))}"
        " AS device",
        f"{struct(country='n_name', region=NO_TEXT, city=NO_TEXT)} AS geo",
        f"array({slots}) AS user_properties",
        f"array({audiences}) AS audiences",
    )
