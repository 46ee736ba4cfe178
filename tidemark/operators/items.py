"""Item-level table: one row per item of an event."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions import ids
from tidemark.functions.lattice import widest_of
from tidemark.functions.params import extract_item_param, param_value, session_id
from tidemark.operators.events import SESSION
from tidemark.operators.ordered import Ordering, segmented_with_copies, windowed
from tidemark.operators.skew import (
    DETECT,
    hot_row_limit,
    known_or_detected,
    left_join,
    part_row_limit,
    quoted,
)
from tidemark.sources.shards import widened

ITEM_GROUP = ["user_pseudo_id", "ga_session_id", "item_id"]
ITEM_ORDER = Ordering(
    group=ITEM_GROUP,
    order=["event_timestamp_micros", "event_name", "item_index", "_row"],
    number="item_event_no",
)
#: Columns that others of the same row tell, see :func:`with_made_columns`.
MADE_COLUMNS = [
    "item_subtotal", "is_identified_user", "is_key_event", "pseudonymous_session_id", "event_id",
]
#: Each part reads all rows again, so their number is bounded.
MOST_PARTS = 8


@dataclass(frozen=True)
class ItemColumn:
    name: str
    param: str
    data_type: str


def item_columns(registry: DataFrame) -> list[ItemColumn]:
    """Item parameters as columns, by name; fixed columns keep their names.

    What reaches the driver is the list of the table's columns."""
    rows = registry.select("param_name", "data_type", "micro_column_name").collect()
    used = {c.lower() for c in S.MICRO_ITEMS_FIXED}
    chosen = []
    for row in sorted(rows, key=lambda r: r["micro_column_name"]):
        name = row["micro_column_name"]
        if name.lower() not in used:
            used.add(name.lower())
            chosen.append(ItemColumn(name, row["param_name"], widest_of([row["data_type"]])))
    return chosen


def item_events(events: DataFrame) -> DataFrame:
    """Distinct names of events that carry items."""
    return events.where(F.size("items") > 0).select("event_name").distinct()


def item_param_columns(columns: list[ItemColumn]) -> list[Column]:
    return [
        extract_item_param(F.col("item.item_params"), c.param, c.data_type).alias(c.name)
        for c in columns
    ]


def explode_items(
    events: DataFrame,
    identity: DataFrame,
    columns: list[ItemColumn],
    start: str,
    end: str,
    tz: str,
    batch_id: str,
    now: Column,
    exclusive_end: bool = False,
    hot=DETECT,
) -> DataFrame:
    """One row per item with event, page and item fields; user id from the identity map only.

    ``event_date`` is the source's own day; the range is tested on local time.
    """
    micros = F.col("event_timestamp")
    inside = ids.in_local_window(micros, start, end, tz, exclusive_end)
    device, web = "device", "device.web_info"
    taken = [
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        ids.local_timestamp(micros, tz).alias("event_timestamp"),
        micros.alias("event_timestamp_micros"),
        F.col("event_name"),
        F.col("user_pseudo_id"),
        session_id(F.col("event_params")).alias("ga_session_id"),
        param_value(F.col("event_params"), "transaction_id")["string_value"].alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("ecommerce_total_value"),
        F.col(f"{device}.category").alias("device_category"),
        F.col(f"{device}.mobile_brand_name").alias("mobile_brand_name"),
        F.col(f"{device}.operating_system").alias("operating_system"),
        F.col(f"{web}.browser").alias("browser"),
        F.col(f"{device}.language").alias("device_language"),
        F.col(f"{web}.hostname").alias("hostname"),
        *[F.col(f"geo.{c}").alias(c) for c in ("continent", "sub_continent", "country", "region", "city")],
        F.col("privacy_info.analytics_storage").alias("analytics_storage"),
        F.col("platform"),
        param_value(F.col("event_params"), "page_location")["string_value"].alias("page_location"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_campaign"),
    ]
    # What an event has is taken once, below the explode: beside it, Spark would do so for each item.
    # Spark leaves out events without items itself, after what callers ask of the time.
    held = widened(events, start, end).where(inside).select(*taken, "items")
    exploded = held.select(
        *[c for c in held.columns if c != "items"], F.posexplode("items").alias("item_index", "item")
    )
    flat = exploded.select(
        *[c for c in exploded.columns if c not in ("item_index", "item")],
        F.col("item_index").cast("bigint").alias("item_index"),
        *[F.col(f"item.{f}").alias(f) for f in S.ITEM_FIELDS],
        *item_param_columns(columns),
    )
    joined = left_join(
        flat, identity.select("user_pseudo_id", "user_id"), ["user_pseudo_id"], hot=hot
    )
    rows = joined.withColumns(
        {
            "created_at": ids.local_timestamp(F.unix_micros(now), tz),
            "batch_id": F.lit(batch_id),
        }
    )
    return with_made_columns(rows)


def with_made_columns(rows: DataFrame) -> DataFrame:
    """Rows with their ``MADE_COLUMNS``. Where many rows are moved, these are dropped before and made
    after: a hash like an event's id takes more room in a shuffle than all that it is made from."""
    user, session = F.col("user_pseudo_id"), F.col("ga_session_id")
    return rows.withColumns(
        {
            "item_subtotal": F.col("price") * F.coalesce("quantity", F.lit(1)),
            "is_identified_user": F.col("user_id").isNotNull(),
            "is_key_event": ids.event_key_flag(F.col("event_name")),
            "pseudonymous_session_id": ids.pseudonymous_session_id(user, session),
            "event_id": ids.event_id(
                user, F.col("event_timestamp_micros"), F.col("event_name"), session
            ),
        }
    )


def items_schema(columns: list[ItemColumn]) -> dict[str, str]:
    dynamic = {c.name: S.SPARK_TYPE[c.data_type] for c in columns}
    return S.MICRO_ITEMS_HEAD | dynamic | S.MICRO_ITEMS_TAIL


def session_parts(spark: SparkSession, number: int) -> list[Column]:
    """Conditions that deal ``number`` item rows into parts of whole sessions, of
    ``tidemark.partRows`` rows where ``MOST_PARTS`` allow that."""
    parts = min(MOST_PARTS, -(-number // part_row_limit(spark)))
    part = F.pmod(F.xxhash64(*SESSION), F.lit(parts))
    return [part == n for n in range(parts)] if parts > 1 else [F.lit(True)]


def number_items(rows: DataFrame, hot=DETECT) -> DataFrame:
    """Running number per (session, item) by time, event and item index.

    Exact copies of a row may be numbered in any order. ``hot`` may hold hot users; then the others'
    rows are dealt by session, so the items of an event, alike in most columns, stay together in
    the shuffle files and compress well.
    """
    by_user = hot is not DETECT
    whole = F.xxhash64(*quoted(rows.columns))
    rows = rows.withColumn("_row", whole)
    spec = ITEM_ORDER
    hot = known_or_detected(hot, rows, spec.group)
    if hot is None:
        return windowed(rows.repartition(*SESSION) if by_user else rows, spec).drop("_row")
    ordinary, large = hot.split(rows)
    ordinary = ordinary.repartition(*SESSION) if by_user else ordinary
    numbered = segmented_with_copies(
        large, spec.group, spec.order, spec.number, hot.segments(), hot_row_limit(rows.sparkSession)
    )
    return windowed(ordinary, spec).unionByName(numbered).drop("_row")
