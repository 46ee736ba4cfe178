"""From the registry to column lists: parameter classes, unified types, final names.

The registry is small (it is a list of columns) and is collected once; the rest is Python
building ``Column`` objects.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.lattice import widest_of
from tidemark.functions.params import extract_param, extracted_type, param_value
from tidemark.operators.registry import is_event_specific
from tidemark.operators.skew import quote


def param_class(registry: DataFrame) -> DataFrame:
    """The registry with the class of each parameter and the type of its column.

    ``ptype`` is ``unique`` (own column per event), ``common``, ``replay`` (a column of the event
    tables only) or ``none``. ``unified_type`` covers all event tables: more than one type gives
    STRING, and names that differ only in case share a column. ``event_count`` is the number of
    events that carry the parameter.
    """
    param, event = F.col("param_name"), F.col("event_name")
    specific = is_event_specific(*map(F.col, ["param_name", "param_category", "event_category"]))
    replay = param.like("clarity_%")
    hidden = param.like("batch_%") | (param == S.HIDDEN_PARAM) | (replay & (event != "session_start"))
    ptype = (
        F.when(hidden, "none").when(replay, "replay").when(specific, "unique").otherwise("common")
    )
    extracted = F.when(param.like("%percent%"), S.FLOAT64).otherwise(F.col("data_type"))
    seen = F.when(F.col("ptype") != "none", extracted)
    types = F.collect_set(seen).over(W.partitionBy(F.lower("param_name")))
    events = F.size(F.collect_set("event_name").over(W.partitionBy("param_name")))
    return registry.withColumn("ptype", ptype).select(
        "param_name",
        "micro_column_name",
        "event_name",
        "data_type",
        "ptype",
        F.when(F.size(types) > 1, S.STRING).otherwise(seen).alias("unified_type"),
        events.cast("bigint").alias("event_count"),
    )


@dataclass
class RawColumn:
    """One parameter column of the event tables."""

    name: str
    data_type: str
    sources: list[tuple[str, str, str]]  # (parameter, event, registered type)

    def expression(self, params: Column, event_name: Column) -> Column:
        by_rule = defaultdict(list)
        for param, event, data_type in self.sources:
            by_rule[param, data_type].append(event)
        kind = S.SPARK_TYPE[self.data_type]
        values = [
            F.when(event_name.isin(sorted(events)), extract_param(params, param, data_type).try_cast(kind))
            for (param, data_type), events in sorted(by_rule.items())
        ]
        return F.coalesce(*values) if len(values) > 1 else values[0]

    def lost(self, params: Column, event_name: Column) -> Column:
        """Whether the event brings a value that this column's type does not hold."""
        given = F.lit(False)
        for param in sorted({param for param, _, _ in self.sources}):
            value = param_value(params, param)
            some = F.coalesce(*[value[f].cast("string") for f in ("string_value", "int_value", "double_value")])
            events = sorted({event for p, event, _ in self.sources if p == param})
            given = given | (event_name.isin(events) & some.isNotNull())
        return given & self.expression(params, event_name).isNull()

    def type_for(self, event: str) -> str | None:
        types = [extracted_type(p, t) for p, e, t in self.sources if e == event]
        return widest_of(types) if types else None


@dataclass
class FinalColumn:
    """One parameter column of the event-level table."""

    name: str
    data_type: str
    common: list[str] = field(default_factory=list)
    unique: list[tuple[str, str]] = field(default_factory=list)  # (event, raw column)

    def expression(self, event_name: Column) -> Column:
        kind = S.SPARK_TYPE[self.data_type]
        values = [F.when(event_name == e, F.col(quote(c)).try_cast(kind)) for e, c in self.unique]
        values += [F.col(quote(c)).try_cast(kind) for c in self.common]
        return F.coalesce(*values) if len(values) > 1 else values[0]


@dataclass
class ColumnPlan:
    """All parameter columns of one run."""

    raw: list[RawColumn]
    final: list[FinalColumn]
    events: list[str]
    collisions: list[str]

    def raw_types(self) -> dict[str, str]:
        return {c.name: S.SPARK_TYPE[c.data_type] for c in self.raw}

    def final_types(self) -> dict[str, str]:
        return {c.name: S.SPARK_TYPE[c.data_type] for c in self.final}


EVENT_TABLE_FIXED = [
    *S.EVENT_TABLE_HEAD, *S.STANDARD_COLUMNS, "event_name", "batch_id", "event_date"
]


def collect_classes(registry: DataFrame) -> list[dict]:
    """Registered parameters with their classes, by name and event.

    The cluster reduces the registry to one row per rule of a column, with the events that
    share it as a list; that list of columns is all that reaches the driver.
    """
    rule = ["param_name", "data_type", "micro_column_name", "ptype", "unified_type"]
    rules = param_class(registry).groupBy(*rule).agg(
        F.sort_array(F.collect_set("event_name")).alias("events")
    )
    rows = [r.asDict() | {"event_name": e} for r in rules.collect() for e in r["events"]]
    return sorted(rows, key=lambda r: (r["param_name"], r["event_name"]))


def column_plan(registry: DataFrame, slots: list[str] = ()) -> ColumnPlan:
    """Raw and final columns of a registry.

    A fixed column keeps its name: a parameter (or its final name) that equals one, or a
    slot, gets no column and is reported as a collision. Names that differ only in case
    share one column, because column names are not case-sensitive.
    """
    rows = collect_classes(registry)
    taken_raw = {c.lower() for c in EVENT_TABLE_FIXED}
    taken_final = {c.lower() for c in [*S.MICRO_USER_FIXED, *slots]}
    collisions, raw = [], {}
    for row in rows:
        param = row["param_name"]
        if row["ptype"] == "none":
            continue
        if param.lower() in taken_raw:
            collisions.append(param)
            continue
        column = raw.setdefault(param.lower(), RawColumn(param, row["unified_type"], []))
        column.sources.append((param, row["event_name"], row["data_type"]))
    final: dict[str, FinalColumn] = {}
    for row in rows:
        param, event, name = row["param_name"], row["event_name"], row["micro_column_name"]
        if row["ptype"] not in ("unique", "common") or param.lower() not in raw:
            continue
        if name.lower() in taken_final:
            collisions.append(name)
            continue
        source = raw[param.lower()]
        column = final.setdefault(name.lower(), FinalColumn(name, source.data_type))
        column.data_type = widest_of([column.data_type, source.data_type])
        if row["ptype"] == "unique":
            column.unique.append((event, source.name))
        elif source.name not in column.common:
            column.common.append(source.name)
    return ColumnPlan(
        sorted(raw.values(), key=lambda c: c.name),
        sorted(final.values(), key=lambda c: c.name),
        sorted({r["event_name"] for r in rows}),
        sorted(set(collisions)),
    )
