"""Event flattening: base events with page numbers, standard columns, event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions import ids
from tidemark.functions.lattice import wider
from tidemark.functions.params import param_value, session_id
from tidemark.operators.columns import ColumnPlan
from tidemark.operators.ordered import segmented_running_count, windowed_running_count
from tidemark.operators.skew import DETECT, known_or_detected, left_join, quote
from tidemark.sources.shards import widened

USER = ["user_pseudo_id"]
SESSION = ["user_pseudo_id", "ga_session_id"]


def events_in_window(
    events: DataFrame, start: str, end: str, tz: str, exclusive_end: bool = False
) -> DataFrame:
    """Events of the local days, with the session number out of the parameter array."""
    inside = ids.in_local_window(F.col("event_timestamp"), start, end, tz, exclusive_end)
    return (
        widened(events, start, end)
        .where(inside)
        .withColumn("ga_session_id", session_id(F.col("event_params")))
    )


def page_numbers(events: DataFrame, hot=DETECT) -> DataFrame:
    """Running count of page views per session; events of one microsecond are peers."""
    hit = F.col("event_name") == "page_view"
    args = (SESSION, "event_timestamp", hit, "page_number")
    hot = known_or_detected(hot, events, USER)
    if hot is None:
        return windowed_running_count(events, *args)
    ordinary, large = hot.split(events)
    return windowed_running_count(ordinary, *args).unionByName(
        segmented_running_count(large, *args, hot.segments())
    )


def base_events(
    events: DataFrame,
    identity: DataFrame,
    start: str,
    end: str,
    tz: str,
    exclusive_end: bool = False,
    hot=DETECT,
) -> DataFrame:
    """Events of the window with page number and mapped user id.

    Ordinary users cost one exchange and one sort: page window and identity join both use
    the partitioning by user, and the window's sort order starts with the join key.
    """
    rows = events_in_window(events, start, end, tz, exclusive_end).drop("user_id")
    hot = known_or_detected(hot, rows, USER)
    known = identity.select("user_pseudo_id", "user_id")
    if hot is None:
        return page_numbers(rows.repartition(*USER), hot=None).join(known, USER, "left")
    ordinary, large = hot.split(rows)
    plain = page_numbers(ordinary.repartition(*USER), hot=None).join(known, USER, "left")
    hit = F.col("event_name") == "page_view"
    counted = segmented_running_count(
        large, SESSION, "event_timestamp", hit, "page_number", hot.segments()
    )
    mapped = counted.join(hot.narrow(known), USER, "left")
    return plain.unionByName(mapped)


def standard_columns() -> list[Column]:
    """The 25 standard columns of every event table, in their order."""
    hostname = F.col("device.web_info.hostname")
    fields = {
        "event_timestamp_micros": F.col("event_timestamp"),
        "device_category": F.col("device.category"),
        "mobile_brand_name": F.col("device.mobile_brand_name"),
        "mobile_model_name": F.col("device.mobile_model_name"),
        "operating_system": F.col("device.operating_system"),
        "operating_system_version": F.col("device.operating_system_version"),
        "browser": F.coalesce("device.web_info.browser", "device.browser"),
        "device_language": F.col("device.language"),
        "hostname": hostname,
        "hostname_norm": ids.hostname_norm(hostname),
        "continent": F.col("geo.continent"),
        "sub_continent": F.col("geo.sub_continent"),
        "country": F.col("geo.country"),
        "region": F.col("geo.region"),
        "city": F.col("geo.city"),
        "traffic_source": F.col("traffic_source.source"),
        "traffic_medium": F.col("traffic_source.medium"),
        "traffic_campaign": F.col("traffic_source.name"),
        "collected_source": F.col("collected_traffic_source.manual_source"),
        "collected_medium": F.col("collected_traffic_source.manual_medium"),
        "collected_campaign": F.col("collected_traffic_source.manual_campaign_name"),
        "analytics_storage": F.col("privacy_info.analytics_storage"),
        "platform": F.col("platform"),
        "gclid": F.col("collected_traffic_source.gclid"),
        "is_key_event": ids.event_key_flag(F.col("event_name")),
    }
    return [fields[name].alias(name) for name in S.STANDARD_COLUMNS]


def event_head(tz: str) -> list[Column]:
    """Ids, local time and replay address of an event."""
    user, session, micros = F.col("user_pseudo_id"), F.col("ga_session_id"), F.col("event_timestamp")
    params = F.col("event_params")
    replay = [
        param_value(params, key)["string_value"]
        for key in ("clarity_project_id", "clarity_user_id", "clarity_session_id")
    ]
    return [
        user,
        F.col("user_id"),
        session,
        ids.pseudonymous_session_id(user, session).alias("pseudonymous_session_id"),
        ids.page_view_id(user, session, F.col("page_number")).alias("page_view_id"),
        ids.local_timestamp(micros, tz).alias("event_timestamp"),
        ids.local_date(micros, tz).alias("event_date"),
        F.col("user_id").isNotNull().alias("is_identified_user"),
        F.when(F.col("event_name") == "session_start", ids.replay_url(*replay)).alias(
            "clarity_play_url"
        ),
    ]


def flatten_events(
    base: DataFrame, plan: ColumnPlan, tz: str, batch_id: str, include_unregistered: bool = True
) -> DataFrame:
    """All event tables in one pass: fixed columns plus one typed column per parameter."""
    kept = base.where(F.col("event_name") != S.DROPPED_EVENT)
    if not include_unregistered:
        kept = kept.where(F.col("event_name").isin(plan.events))
    params, event = F.col("event_params"), F.col("event_name")
    return kept.select(
        *event_head(tz),
        *standard_columns(),
        *[c.expression(params, event).alias(c.name) for c in plan.raw],
        F.lit(batch_id).alias("batch_id"),
        "event_name",
    )


def event_table(tables: DataFrame, plan: ColumnPlan, name: str) -> DataFrame:
    """One event's flat table: its own parameters in their registered types."""
    columns = [c for c in S.EVENT_TABLE_HEAD if c != "clarity_play_url" or name == "session_start"]
    own = [(c.name, c.type_for(name)) for c in plan.raw]
    return tables.where(F.col("event_name") == name).select(
        *columns,
        *S.STANDARD_COLUMNS,
        *[F.col(quote(c)).try_cast(S.SPARK_TYPE[t]).alias(c) for c, t in own if t],
        "batch_id",
    )


def lossy_events(seen: DataFrame, registry: DataFrame) -> list[str]:
    """Events of which a parameter was seen in a wider type than its registered one: few names."""
    registered = registry.select("event_name", "param_name", F.col("data_type").alias("registered"))
    both = seen.join(registered, ["event_name", "param_name"])
    wider_seen = wider(F.col("data_type"), F.col("registered")) != F.col("registered")
    rows = both.where(wider_seen).select("event_name").distinct().collect()
    return sorted(row[0] for row in rows if row[0] is not None)


def lost_values(events: DataFrame, plan: ColumnPlan) -> DataFrame:
    """(event_name, param_name, data_type, lost): values that their column's type does not hold."""
    columns = [c for c in plan.raw if c.data_type != S.STRING]  # text holds every value
    params, event = F.col("event_params"), F.col("event_name")
    misses = [
        F.struct(F.lit(c.name).alias("param_name"), F.lit(c.data_type).alias("data_type"),
                 c.lost(params, event).alias("lost"))
        for c in columns
    ]
    missed = F.explode(F.filter(F.array(*misses), lambda m: m["lost"])).alias("m")
    if not misses:
        missed = F.explode(F.array().cast("array<struct<param_name: string, data_type: string>>")).alias("m")
    found = events.select("event_name", missed)
    return found.groupBy("event_name", "m.param_name", "m.data_type").agg(F.count("*").alias("lost"))
