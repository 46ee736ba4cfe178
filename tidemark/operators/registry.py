"""Parameter registry: observe, unify, upsert, classify, name, and its logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.lattice import wider, widest
from tidemark.functions.params import observed_item_type, observed_type
from tidemark.operators.upsert import insert_if_absent, upsert_by_key


class EmptyRegistryInput(ValueError):
    """Events exist but carry no parameters: the export is probably not complete."""


def declared_type(param: Column, declared: dict[str, str] = S.DECLARED_TYPES) -> Column:
    """Type the dictionary gives a parameter, NULL if it has none."""
    by_type = {t: [k for k, v in declared.items() if v == t] for t in S.SPARK_TYPE}
    out = F.when(F.lit(False), F.lit(S.STRING))
    for data_type, names in by_type.items():
        if names:
            out = out.when(param.isin(names), F.lit(data_type))
    return out


def seen_types(events: DataFrame) -> DataFrame:
    """Distinct (event, parameter, type of the value as it is).

    Only keys and values of the parameter arrays are read, and distinct combines in the map tasks.
    """
    # The outer form spares a second look at each array; the key filter drops its empty rows.
    exploded = events.select("event_name", F.explode_outer("event_params").alias("p"))
    seen = exploded.select(
        "event_name",
        F.col("p.key").alias("param_name"),
        observed_type(F.col("p.value")).alias("data_type"),
    )
    return seen.where(~F.col("param_name").isin(S.EXCLUDED_PARAMS)).distinct()


def declare(seen: DataFrame, declared: dict[str, str] = S.DECLARED_TYPES) -> DataFrame:
    """Seen types, the dictionary's type taking precedence.

    A parameter seen with two types keeps its two rows even when the dictionary then gives both
    the same type.
    """
    given = declared_type(F.col("param_name"), declared)
    return seen.withColumn("data_type", F.coalesce(given, F.col("data_type")))


def observe_params(events: DataFrame, declared: dict[str, str] = S.DECLARED_TYPES) -> DataFrame:
    """Distinct (event, parameter, observed or declared type)."""
    return declare(seen_types(events), declared)


def unify_types(raw: DataFrame, keys: list[str]) -> DataFrame:
    """Widest type per key."""
    return raw.groupBy(*keys).agg(widest(F.col("data_type")).alias("data_type"))


def upsert_registry(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge on (event, parameter): types only widen, name and time come from the new row."""
    rule = {"data_type": wider(F.col("o.data_type"), F.col("n.data_type"))}
    return upsert_by_key(old, new, ["event_name", "param_name"], rule)


def _category(name: Column, lists: dict[str, list[str]], otherwise: Column) -> Column:
    out = F.when(F.lit(False), F.lit("custom"))
    for label, names in lists.items():
        out = out.when(name.isin(names), F.lit(label))
    return out.otherwise(otherwise)


def classify_event(event_name: Column) -> Column:
    return _category(event_name, S.EVENT_CATEGORIES, F.lit("custom"))


def classify_param(param_name: Column) -> Column:
    rest = F.when(param_name.like("clarity_%"), "martech").otherwise("custom")
    return _category(param_name, S.PARAM_CATEGORIES, rest)


def only_where_unset(current: Column, value: Column) -> Column:
    return F.when(current.isNull() | (current == ""), value).otherwise(current)


def is_event_specific(param: Column, param_category: Column, event_category: Column) -> Column:
    """Parameters that get a column of their own for each event."""
    custom = (param_category == "custom") & (event_category == "custom")
    return (param == "value") | F.coalesce(custom, F.lit(False))


def column_name(
    param: Column, event: Column, param_category: Column, event_category: Column
) -> Column:
    specific = is_event_specific(param, param_category, event_category)
    return F.when(specific, F.concat(param, F.lit("__"), event)).otherwise(param)


def build_registry(raw: DataFrame, old: DataFrame, now: Column) -> DataFrame:
    """Registry after one run: unify, merge, add the fixed pair, classify, name.

    Classification comes after the fixed pair is added, so the pair has its categories at once.
    """
    new = unify_types(raw, ["event_name", "param_name"]).select(
        "event_name",
        "param_name",
        "data_type",
        F.col("param_name").alias("micro_column_name"),
        now.alias("created_at"),
    )
    merged = upsert_registry(old, new).where(F.col("event_name") != S.DROPPED_EVENT)
    event, param, data_type = S.ALWAYS_REGISTERED
    fixed = raw.sparkSession.range(1).select(
        F.lit(event).alias("event_name"),
        F.lit(param).alias("param_name"),
        F.lit(data_type).alias("data_type"),
        F.lit(param).alias("micro_column_name"),
        now.alias("created_at"),
    )
    merged = insert_if_absent(merged, fixed, ["event_name", "param_name"])
    merged = merged.withColumns(
        {
            "event_category": only_where_unset(
                F.col("event_category"), classify_event(F.col("event_name"))
            ),
            "param_category": only_where_unset(
                F.col("param_category"), classify_param(F.col("param_name"))
            ),
        }
    )
    name = column_name(*map(F.col, ["param_name", "event_name", "param_category", "event_category"]))
    return merged.withColumn("micro_column_name", name).select(*S.EVENT_PARAM_REGISTRY)


def duplicate_params(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """(event, parameter) pairs seen with more than one type."""
    keys = ["event_name", "param_name"]
    resolved = registry.select(*keys, F.col("data_type").alias("_resolved"))
    return (
        raw.join(resolved, keys, "left")
        .groupBy(*keys, "_resolved")
        .agg(
            F.count("*").alias("duplicate_count"),
            F.expr("listagg(data_type, ',') WITHIN GROUP (ORDER BY data_type)").alias(
                "types_found"
            ),
        )
        .where("duplicate_count > 1")
        .select(
            *keys,
            "duplicate_count",
            "types_found",
            F.coalesce("_resolved", F.lit("UNKNOWN")).alias("resolved_type"),
        )
    )


def _distinct_text(column: str) -> Column:
    """Sorted distinct values as text; the sets are as small as the registry."""
    return F.array_join(F.array_sort(F.collect_set(column)), ",")


def _mixed(raw: DataFrame, **texts: Column) -> DataFrame:
    """Parameters with more than one type."""
    types = F.collect_set("data_type")
    return (
        raw.groupBy("param_name")
        .agg(F.size(types).alias("_types"), *[c.alias(name) for name, c in texts.items()])
        .where("_types > 1")
    )


def type_audit(raw: DataFrame) -> DataFrame:
    """Parameters with more than one type across events."""
    return _mixed(
        raw,
        original_data_types=_distinct_text("data_type"),
        events_involved=_distinct_text("event_name"),
    ).select(
        F.col("param_name").alias("column_name"),
        F.lit("TYPE_UNIFIED").alias("status"),
        F.lit(S.REASON_TYPE_UNIFIED).alias("reason"),
        "original_data_types",
        "events_involved",
    )


def observe_item_params(events: DataFrame) -> DataFrame:
    """Distinct (item parameter, observed type) over all items of all events."""
    # The outer form spares a second look at each array; what is empty has no position.
    items = events.select(F.explode_outer("items.item_params").alias("params"))
    exploded = items.select(F.posexplode_outer("params").alias("at", "p"))
    return exploded.where("at IS NOT NULL").select(
        F.col("p.key").alias("param_name"),
        observed_item_type(F.col("p.value")).alias("data_type"),
    ).distinct()


def item_registry(raw: DataFrame, old: DataFrame, now: Column) -> DataFrame:
    """Item-parameter registry after one run; its types only widen, too."""
    new = unify_types(raw, ["param_name"]).select(
        "param_name",
        "data_type",
        F.concat("param_name", F.lit("__items")).alias("micro_column_name"),
        now.alias("created_at"),
    )
    rule = {"data_type": wider(F.col("o.data_type"), F.col("n.data_type"))}
    return upsert_by_key(old, new, ["param_name"], rule).select(*S.ITEM_PARAM_REGISTRY)


def item_type_audit(raw: DataFrame) -> DataFrame:
    return _mixed(raw, original_data_types=_distinct_text("data_type")).select(
        F.concat("param_name", F.lit("__items")).alias("column_name"),
        F.lit("TYPE_UNIFIED_ITEMS").alias("status"),
        F.lit(S.REASON_ITEM_TYPE_UNIFIED).alias("reason"),
        "original_data_types",
        F.lit("item_params(all_events)").alias("events_involved"),
    )


def require_params(raw: DataFrame, start: str) -> None:
    if raw.isEmpty():
        raise EmptyRegistryInput(
            f"events of {start} exist but no parameters were found; "
            "the export may not be complete yet"
        )
