"""Identity map, slot registry, user attributes, audiences and user properties."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.ids import local_date, local_timestamp, pseudonymous_session_id, shift_day
from tidemark.functions.params import param_value
from tidemark.operators.ordered import newest
from tidemark.operators.skew import DETECT, cut_lineage, left_join
from tidemark.operators.upsert import append_if_new
from tidemark.sources.shards import in_shards, look_back


def shard_date(shard: Column) -> Column:
    return F.to_date(shard, "yyyyMMdd")


def filled(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def identity_days(events: DataFrame) -> DataFrame:
    """Newest non-empty user id per pseudonymous id and shard: what a shard adds to the map."""
    newest_id = F.max(F.struct("event_timestamp", "user_id"))
    known = events.where(filled(F.col("user_id")))
    return known.groupBy("shard", "user_pseudo_id").agg(newest_id.alias("latest")).select(
        "user_pseudo_id", "latest.event_timestamp", "latest.user_id",
        shard_date(F.col("shard")).alias("event_date"),
    )


def identity_of(days: DataFrame, tz: str, now: Column) -> DataFrame:
    """The identity map from the newest ids of its shards.

    ``first_touch_date`` is the local date of that newest event. Ids of the same
    microsecond are told apart by their text.
    """
    newest_id = F.max(F.struct("event_timestamp", "user_id"))
    return days.groupBy("user_pseudo_id").agg(newest_id.alias("latest")).select(
        "user_pseudo_id",
        F.col("latest.user_id").alias("user_id"),
        local_date(F.col("latest.event_timestamp"), tz).alias("first_touch_date"),
        now.alias("created_at"),
    )


def identity_map(
    events: DataFrame, start: str, end: str, tz: str, now: Column, days: int = S.LOOKBACK_DAYS
) -> DataFrame:
    """Newest non-empty user id per pseudonymous id in the look-back range."""
    return identity_of(identity_days(look_back(events, start, end, days)), tz, now)


def slot_registry(
    users: DataFrame, start: str, end: str, tz: str, now: Column, days: int = S.LOOKBACK_DAYS
) -> DataFrame:
    """Newest definition of each user-property slot."""
    props = look_back(users, start, end, days).select(
        "shard", F.explode("user_properties").alias("prop")
    )
    name = F.col("prop.value.user_property_name")
    newest_definition = F.max(
        F.struct(
            F.col("shard"),
            F.col("prop.value.set_timestamp_micros").alias("micros"),
            name.alias("name"),
        )
    )
    return (
        props.where(filled(name))
        .groupBy(F.col("prop.key").alias("slot_key"))
        .agg(newest_definition.alias("latest"))
        .select(
            "slot_key",
            F.col("latest.name").alias("user_property_name"),
            F.timestamp_micros("latest.micros").alias("last_set_timestamp"),
            local_date(F.col("latest.micros"), tz).alias("last_set_date"),
            shard_date(F.col("latest.shard")).alias("source_table_date"),
            shard_date(F.lit(shift_day(start, -days))).alias("lookback_start_date"),
            shard_date(F.lit(end)).alias("lookback_end_date"),
            now.alias("created_at"),
        )
    )


@dataclass(frozen=True)
class Slot:
    key: str
    column: str


def slot_columns(slots: DataFrame, taken: set[str]) -> tuple[list[Slot], list[str]]:
    """Slots as column names, and the slot keys that get none: a list of columns.

    Names keep letters, digits and underscores. Of two slots with one name the newest
    wins; a name of a fixed column is not available.
    """
    named = slots.select(
        "slot_key",
        F.regexp_replace("user_property_name", "[^a-zA-Z0-9_]", "_").alias("column"),
        "last_set_timestamp",
    ).orderBy(F.col("last_set_timestamp").desc_nulls_last(), "slot_key")
    rows = named.collect()
    used, chosen, refused = {name.lower() for name in taken}, [], []
    for row in rows:
        if row["column"].lower() in used:
            refused.append(row["slot_key"])
        else:
            used.add(row["column"].lower())
            chosen.append(Slot(row["slot_key"], row["column"]))
    return sorted(chosen, key=lambda slot: slot.column), refused


def slot_value(props: Column, key: str) -> Column:
    """Largest text stored under this slot key."""
    hits = F.filter(props, lambda p: p["key"] == F.lit(key))
    return F.array_max(F.transform(hits, lambda p: p["value"]["string_value"]))


def user_attributes(
    users: DataFrame,
    identity: DataFrame,
    slots: list[Slot],
    start: str,
    end: str,
    tz: str,
    now: Column,
    days: int = S.LOOKBACK_DAYS,
) -> DataFrame:
    """Newest snapshot per user with resolved user id and one column per slot.

    Snapshots are sorted by user in the map tasks, as the plain columns that the result needs.
    """
    slim = look_back(users, start, end, days).select(
        "shard", "pseudo_user_id", "user_id",
        F.col("user_info.last_active_timestamp_micros").alias("_active"),
        F.col("user_info.user_first_touch_timestamp_micros").alias("_first"),
        "geo.country", "geo.region", "geo.city", F.col("device.category").alias("device_category"),
        "device.mobile_brand_name", "device.operating_system",
        *[slot_value(F.col("user_properties"), s.key).alias(f"_slot{n}") for n, s in enumerate(slots)],
    )
    active, first = F.col("_active"), F.col("_first")
    latest = newest(
        slim,
        ["pseudo_user_id"],
        [F.col("shard").desc(), active.desc(), F.col("user_id").desc()],
    )
    known = identity.select(
        F.col("user_pseudo_id").alias("pseudo_user_id"), F.col("user_id").alias("mapped_id")
    )
    return latest.join(known, "pseudo_user_id", "left").select(
        F.col("pseudo_user_id").alias("user_pseudo_id"),
        F.coalesce("mapped_id", "user_id").alias("user_id"),
        F.timestamp_micros(active).alias("last_active_timestamp"),
        local_date(active, tz).alias("last_active_date"),
        F.timestamp_micros(first).alias("first_touch_timestamp"),
        local_date(first, tz).alias("first_touch_date"),
        "country",
        "region",
        "city",
        "device_category",
        "mobile_brand_name",
        "operating_system",
        *[F.col(f"_slot{n}").alias(s.column) for n, s in enumerate(slots)],
        now.alias("updated_at"),
        shard_date(F.col("shard")).alias("source_table_date"),
    )


def audience_log(
    users: DataFrame,
    identity: DataFrame,
    existing: DataFrame,
    start: str,
    end: str,
    now: Column,
    days: int = S.LOOKBACK_DAYS,
) -> DataFrame:
    """New audience memberships, one per (user, audience, start), newest shard first."""
    exploded = look_back(users, start, end, days).select(
        "shard", F.col("pseudo_user_id").alias("user_pseudo_id"), F.explode("audiences").alias("a")
    )
    members = exploded.select(
        "shard",
        "user_pseudo_id",
        F.col("a.id").cast("string").alias("audience_id"),
        F.col("a.name").alias("audience_name"),
        F.timestamp_micros("a.membership_start_timestamp_micros").alias(
            "membership_start_timestamp"
        ),
        F.timestamp_micros("a.membership_expiry_timestamp_micros").alias(
            "membership_expiry_timestamp"
        ),
        F.col("a.npa").alias("npa"),
    )
    keys = ["user_pseudo_id", "audience_id", "membership_start_timestamp"]
    once = newest(
        members,
        keys,
        [F.col("shard").desc(), F.col("membership_expiry_timestamp").desc(), "audience_name", "npa"],
    )
    fresh = cut_lineage(append_if_new(once, existing, keys))
    return left_join(fresh, identity.select("user_pseudo_id", "user_id"), ["user_pseudo_id"]).select(
        "user_pseudo_id",
        "user_id",
        "audience_id",
        "audience_name",
        "membership_start_timestamp",
        "membership_expiry_timestamp",
        "npa",
        F.concat("user_pseudo_id", F.lit("_"), "shard").alias("pseudonymous_session_id"),
        shard_date(F.col("shard")).alias("source_table_date"),
        now.alias("created_at"),
    )


def user_property_log(
    events: DataFrame,
    identity: DataFrame,
    existing: DataFrame,
    start: str,
    end: str,
    tz: str,
    now: Column,
    hot=DETECT,
) -> DataFrame:
    """New user-property settings of the range, newest event per (user, key, set time).

    Of the growing log only the days that the new settings have are read.
    """
    exploded = in_shards(events, start, end).select(
        "shard",
        "user_pseudo_id",
        "event_timestamp",
        "event_name",
        param_value(F.col("event_params"), "ga_session_id")["int_value"].alias("ga_session_id"),
        F.explode("user_properties").alias("p"),
    )
    settings = exploded.where("p.value.set_timestamp_micros IS NOT NULL").select(
        "*",
        F.col("p.key").alias("property_key"),
        F.col("p.value.set_timestamp_micros").alias("set_micros"),
    )
    latest = newest(
        settings,
        ["user_pseudo_id", "property_key", "set_micros"],
        [
            F.col("event_timestamp").desc(),
            F.col("event_name"),
            F.col("ga_session_id"),
            F.col("p.value.string_value"),
            F.col("p.value.int_value"),
            F.col("p.value.float_value"),
        ],
    ).withColumn("set_timestamp", F.timestamp_micros("set_micros"))
    latest = cut_lineage(latest.withColumn("set_date", local_date(F.col("set_micros"), tz)))
    first, last = latest.agg(F.min("set_date"), F.max("set_date")).first()
    old = existing.where(F.col("set_date").between(F.lit(first), F.lit(last)))
    fresh = append_if_new(latest, old, ["user_pseudo_id", "property_key", "set_timestamp"])
    return left_join(
        fresh, identity.select("user_pseudo_id", "user_id"), ["user_pseudo_id"], hot=hot
    ).select(
        "user_pseudo_id",
        "user_id",
        "property_key",
        F.col("p.value.string_value").alias("property_value_string"),
        F.col("p.value.int_value").alias("property_value_int"),
        F.col("p.value.float_value").alias("property_value_float"),
        "set_timestamp",
        "set_date",
        local_timestamp(F.col("event_timestamp"), tz).alias("event_timestamp"),
        "event_name",
        "ga_session_id",
        pseudonymous_session_id(F.col("user_pseudo_id"), F.col("ga_session_id")).alias(
            "pseudonymous_session_id"
        ),
        shard_date(F.col("shard")).alias("source_event_date"),
        now.alias("created_at"),
    )


def property_sums(log: DataFrame) -> DataFrame:
    """Per property the sums that add up over parts of the log, without users."""
    return log.groupBy("property_key").agg(
        F.count("property_value_string").alias("texts"),
        F.count("property_value_float").alias("floats"),
        F.count("property_value_int").alias("integers"),
        F.count("*").alias("total_records"),
        F.min("set_timestamp").alias("first_seen"),
        F.max("set_timestamp").alias("last_seen"),
    )


def property_users(log: DataFrame) -> DataFrame:
    """Distinct (property, user) of a part of the log."""
    return log.where("user_pseudo_id IS NOT NULL").select("property_key", "user_pseudo_id").distinct()


def merged_properties(old: DataFrame, sums: DataFrame, new_users: DataFrame) -> DataFrame:
    """State of all properties: older state, sums of new settings, (property, user) not seen before."""
    fresh = new_users.groupBy("property_key").agg(F.count("*").alias("unique_users"))
    both = old.unionByName(sums, allowMissingColumns=True).unionByName(fresh, allowMissingColumns=True)
    added = ["texts", "floats", "integers", "total_records", "unique_users"]
    return both.groupBy("property_key").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def summary_of(state: DataFrame) -> DataFrame:
    """Per property: resolved type, users, records, first and last setting."""
    resolved = (
        F.when(F.col("texts") > 0, S.STRING)
        .when(F.col("floats") > 0, S.FLOAT64)
        .when(F.col("integers") > 0, S.INT64)
        .otherwise(S.STRING)
    )
    return state.select(
        "property_key", resolved.alias("resolved_type"), "unique_users", "total_records",
        "first_seen", "last_seen",
    )


def property_summary(log: DataFrame) -> DataFrame:
    """The summary of a whole log."""
    sums = property_sums(log)
    nothing = sums.limit(0).withColumn("unique_users", F.lit(0).cast("bigint"))
    return summary_of(merged_properties(nothing, sums, property_users(log)))
