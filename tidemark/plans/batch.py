"""One run: registry, users, event tables, event-level and item-level table, log."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.ids import parse_day, shift_day
from tidemark.operators import columns as C
from tidemark.operators import events as E
from tidemark.operators import evolve as V
from tidemark.operators import identity as I
from tidemark.operators import items as N
from tidemark.operators import micro as M
from tidemark.operators import registry as R
from tidemark.operators.skew import cut_lineage, hot_groups, working_in
from tidemark.plans import carry, control, state
from tidemark.plans.control import schema_drift
from tidemark.plans.incremental import (
    EVENTS_TABLE,
    ITEMS_TABLE,
    build_events,
    build_items,
    merged_types,
    update_events,
    update_items,
)
from tidemark.plans.store import TableStore, days_between
from tidemark.sources import shards

PROCESSOR = "tidemark batch"
VERSION = "0.1.0"
ERROR_CHARS = 500
UTC_NAMES = {"UTC", "Etc/UTC", "Z", "GMT", "+00:00"}
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCANNED_BYTES_PER_PARTITION = 128 << 20
RECOVERY_DAYS = 7
EVENT_TABLES = "event_tables"
RESET_TABLES = [
    "mst_event_params", "mst_duplicate_params_log", "audit_schema_log",
    "log_integrated_columns", "log_audience_membership", "log_user_properties",
    "mst_user_properties", "mst_item_params", "micro_items_table", EVENT_TABLES, carry.ITEMS,
    *state.STATE_TABLES,
]


@dataclass
class BatchConfig:
    start: str
    end: str
    events_path: str
    target: str
    users_path: str | None = None
    reset: bool = False
    incremental: bool = True
    tz: str = "Asia/Tokyo"
    client_id: str = ""
    exclusive_end: bool = False
    include_unregistered: bool = True
    raw_scroll_percent: bool = False  # max_scroll_percent as sent, 90 for 90; a table keeps to one


@dataclass
class Run:
    """State of one run, filled phase by phase."""

    spark: SparkSession
    cfg: BatchConfig
    store: TableStore
    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    began: float = field(default_factory=time.monotonic)
    at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    status: dict[str, str] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    hot_users: object = None
    slots: list = field(default_factory=list)
    plan: C.ColumnPlan | None = None
    seen: DataFrame | None = None

    @property
    def now(self):
        return F.lit(self.at).cast("timestamp")

    @property
    def seconds(self) -> float:
        return float(int(time.monotonic() - self.began))


def phase_0(run: Run, events: DataFrame) -> str:
    """Parameter registries, their logs, schema evolution."""
    cfg, store, spark = run.cfg, run.store, run.spark
    size_shuffles(run)
    run.hot_users = hot_groups(
        shards.widened(events, cfg.start, cfg.end).select(*E.USER), E.USER
    )
    in_range = shards.in_shards(events, cfg.start, cfg.end)
    run.seen = cut_lineage(R.seen_types(in_range))
    raw = R.declare(run.seen)
    R.require_params(raw, cfg.start)
    if cfg.reset:  # only a run that has found its parameters gives up the old state
        for table in RESET_TABLES:
            store.clear(table)
    old = store.read("mst_event_params", S.EVENT_PARAM_REGISTRY)
    registry = cut_lineage(R.build_registry(raw, old, run.now))

    current = store.columns("micro_user_table") or S.MICRO_USER_FIXED
    stored = V.schema_frame(spark, current)
    fixed = [*S.MICRO_USER_FIXED]
    missing = cut_lineage(V.evolve_schema(stored, V.visible_params(registry), fixed))
    diff = cut_lineage(V.reconcile_types(stored, registry, fixed))
    registry = V.apply_sticky(registry, diff)
    store.replace("mst_event_params", registry)

    store.replace("mst_duplicate_params_log", R.duplicate_params(raw, registry))
    store.append("audit_schema_log", R.type_audit(raw), S.SCHEMA_AUDIT)
    added = V.history_rows(missing, F.lit(S.REASON_PARAM_ADDED), run.now)
    reconciled = V.history_rows(V.reconcile_history(diff), F.col("reason"), run.now)
    store.append("mst_schema_history", added.unionByName(reconciled), S.SCHEMA_HISTORY)
    integrated = missing.select(
        F.lit("micro_user_table").alias("source_table"),
        F.col("micro_column_name").alias("integrated_column"),
        F.lit(S.REASON_INTEGRATED).alias("reason"),
        run.now.alias("processed_at"),
    )
    store.append("log_integrated_columns", integrated, S.INTEGRATED_COLUMNS)

    raw_items = cut_lineage(R.observe_item_params(in_range))
    old_items = store.read("mst_item_params", S.ITEM_PARAM_REGISTRY)
    items = cut_lineage(R.item_registry(raw_items, old_items, run.now))
    store.replace("mst_item_params", items)
    store.append("audit_schema_log", R.item_type_audit(raw_items), S.SCHEMA_AUDIT)
    item_columns = store.columns("micro_items_table") or S.MICRO_ITEMS_FIXED
    new_items = V.evolve_schema(V.schema_frame(spark, item_columns), items, [*S.MICRO_ITEMS_FIXED])
    store.append(
        "mst_schema_history",
        V.history_rows(new_items, F.lit(S.REASON_ITEM_PARAM_ADDED), run.now),
        S.SCHEMA_HISTORY,
    )
    return "SUCCESS"


def collision_rows(run: Run, names: list[str]) -> DataFrame:
    rows = [(name, "NAME_COLLISION", "name is taken by a fixed column", None, None) for name in names]
    return run.spark.createDataFrame(rows, S.ddl(S.SCHEMA_AUDIT))


def phase_1(run: Run, events: DataFrame, users: DataFrame | None) -> str:
    """Identity map, slots, user attributes, audiences, user properties."""
    cfg, store, spark = run.cfg, run.store, run.spark
    span = (cfg.start, cfg.end)
    days = state.identity_days(store, events, cfg.events_path, *span)
    store.replace("dim_user_map_180d", I.identity_of(days, cfg.tz, run.now), cluster=E.USER)
    identity = store.read("dim_user_map_180d")
    snapshot = shards.empty(spark, S.USERS) if users is None else users
    store.replace(
        "mst_pseudonymous_properties", I.slot_registry(snapshot, *span, cfg.tz, run.now)
    )
    definitions = store.read("mst_pseudonymous_properties")
    slots, refused = I.slot_columns(definitions, {*S.MICRO_USER_FIXED})
    run.slots = slots
    if refused:
        store.append("audit_schema_log", collision_rows(run, refused), S.SCHEMA_AUDIT)
    attributes = I.user_attributes(snapshot, identity, slots, *span, cfg.tz, run.now)
    store.replace("log_pseudonymous_users", attributes, cluster=["user_pseudo_id"])

    warning = ""
    if users is None:
        warning = "audience_warning: user snapshot not found; user-data export was skipped"
    elif "audiences" not in spark.read.parquet(cfg.users_path).columns:
        warning = "audience_warning: the user snapshot has no audiences field"
    known = store.read("log_audience_membership", S.AUDIENCE_LOG)
    audience = I.audience_log(snapshot, identity, known, *span, run.now)
    store.append("log_audience_membership", audience, S.AUDIENCE_LOG, ["source_table_date"])

    logged = store.read("log_user_properties", S.USER_PROPERTY_LOG)
    hot = hot_groups(shards.in_shards(events, *span), E.USER, F.size("user_properties"))
    settings = I.user_property_log(events, identity, logged, *span, cfg.tz, run.now, hot=hot)
    store.replace("mst_user_properties", state.append_settings(store, settings))
    return f"SUCCESS ({warning})" if warning else "SUCCESS"


def event_tables_schema(plan: C.ColumnPlan) -> dict[str, str]:
    standard = {
        c: "bigint" if c in ("event_timestamp_micros", "is_key_event") else "string"
        for c in S.STANDARD_COLUMNS
    }
    head = {c: t for c, t in S.EVENT_TABLE_HEAD.items() if c != "event_date"}
    return (
        head | standard | plan.raw_types()
        | {"batch_id": "string", "event_name": "string", "event_date": "date"}
    )


def planned_columns(run: Run) -> C.ColumnPlan:
    """Parameter columns of this run; names that get none are logged."""
    plan = C.column_plan(run.store.read("mst_event_params"), [s.column for s in run.slots])
    if plan.collisions:
        run.store.append("audit_schema_log", collision_rows(run, plan.collisions), S.SCHEMA_AUDIT)
    return plan


def phase_2(run: Run, events: DataFrame) -> str:
    """All event tables in one pass, one dataset partitioned by event and day."""
    cfg, store = run.cfg, run.store
    plan = run.plan = planned_columns(run)
    identity = store.read("dim_user_map_180d")
    base = E.base_events(
        events, identity, cfg.start, cfg.end, cfg.tz, cfg.exclusive_end, hot=run.hot_users
    )
    rows = E.flatten_events(base, plan, cfg.tz, run.batch_id, cfg.include_unregistered)
    stored = store.columns(EVENT_TABLES)
    wanted = merged_types(stored, (stored or {}) | event_tables_schema(plan))
    tail = ["batch_id", "event_name", "event_date"]
    wanted = {c: t for c, t in wanted.items() if c not in tail} | {c: wanted[c] for c in tail}
    rows = V.conform(rows, wanted)
    partitions = ["event_date", "event_name"]
    if stored is None:
        store.replace(EVENT_TABLES, rows, partitions, ["user_pseudo_id"], spread=True)
    else:
        store.evolve(EVENT_TABLES, wanted, ["user_pseudo_id"])
        store.overwrite_days(
            EVENT_TABLES,
            rows,
            days_between(parse_day(cfg.start), parse_day(cfg.end)),
            ["user_pseudo_id"],
            spread=True,
        )
    return partial_status(run, events)


def partial_status(run: Run, events: DataFrame) -> str:
    """SUCCESS, or the events that lost values, which the log of failed values counts.

    Only events of which phase 0 saw a wider type than the registered one are read again.
    """
    cfg, store = run.cfg, run.store
    suspects = E.lossy_events(run.seen, store.read("mst_event_params"))
    if not suspects:
        return "SUCCESS"
    read = events.where(F.col("event_name").isin(suspects))
    read = E.events_in_window(read, cfg.start, cfg.end, cfg.tz, cfg.exclusive_end)
    lost = cut_lineage(E.lost_values(read, run.plan))
    by_event = lost.groupBy("event_name").agg(F.sum("lost").alias("n")).orderBy("event_name").collect()
    if not by_event:
        return "SUCCESS"
    rows = lost.withColumns({"batch_id": F.lit(run.batch_id), "executed_at": run.now})
    store.append("log_failed_values", rows, S.FAILED_VALUES)
    failed = ", ".join(f"{row['event_name']}({row['n']})" for row in by_event)
    return f"PARTIAL: failed={failed}"[:ERROR_CHARS]


def phase_3a(run: Run) -> str:
    """Event-level table: whole rebuild from all event-table days, or one range."""
    cfg, store, plan = run.cfg, run.store, run.plan
    tables = store.read(EVENT_TABLES)
    attributes = store.read("log_pseudonymous_users")
    slots = [s.column for s in run.slots]
    stored = store.columns(EVENTS_TABLE)
    first, last = parse_day(cfg.start), parse_day(cfg.end)
    if cfg.incremental and stored is not None and set(S.MICRO_USER_FIXED) <= set(stored):
        update_events(store, tables, attributes, plan, slots, first, last, run.hot_users)
    else:
        in_range = F.col("event_date").between(F.lit(first), F.lit(last))
        source = tables.where(in_range) if cfg.incremental else tables
        build_events(store, source, attributes, plan, slots)
    return "SUCCESS"


def phase_3b(run: Run, events: DataFrame) -> str:
    """Item-level table: replaced as a whole, or one range."""
    cfg, store = run.cfg, run.store
    columns = N.item_columns(store.read("mst_item_params"))
    identity = store.read("dim_user_map_180d")
    hot = hot_groups(shards.widened(events, cfg.start, cfg.end), E.USER, F.size("items"))
    rows = N.explode_items(
        events, identity, columns, cfg.start, cfg.end, cfg.tz, run.batch_id, run.now,
        cfg.exclusive_end, hot=hot,
    )
    wanted = N.items_schema(columns)
    if cfg.incremental and store.exists(ITEMS_TABLE):
        update_items(store, rows, wanted, parse_day(cfg.start), parse_day(cfg.end), hot)
    else:
        build_items(store, rows, wanted, hot)
    return "SUCCESS"


def attempt(run: Run, phase: str, allowed: bool, action) -> None:
    """Run a phase; an error becomes its status and stops the phases after it."""
    if not allowed:
        run.status[phase] = "SKIPPED"
        return
    try:
        run.status[phase] = action()
    except Exception as error:  # noqa: BLE001 - the status carries it
        run.status[phase] = f"FAILED: {str(error)[:ERROR_CHARS]}"


def event_count(run: Run) -> int:
    """Rows of the event-level table, from the sums of its days."""
    if not run.store.exists(carry.USERS):
        return 0
    return run.store.read(carry.USERS).agg(F.sum("events")).first()[0] or 0


def append_run_log(run: Run, total_rows: int) -> None:
    cfg = run.cfg
    values = (
        run.batch_id, run.at, cfg.start, cfg.end, *[run.status[p] for p in PHASES],
        cfg.reset, cfg.incremental, total_rows, run.seconds, VERSION, cfg.client_id,
    )
    row = run.spark.createDataFrame([values], S.ddl(S.RUN_LOG))
    run.store.append("log_batch_execution", row, S.RUN_LOG)


PHASES = ["phase_0", "phase_1", "phase_2", "phase_3a", "phase_3b"]


def summary(run: Run, mode: str) -> DataFrame:
    values = {
        "processor": f"{PROCESSOR} {VERSION}",
        "start_date": run.cfg.start,
        "end_date": run.cfg.end,
        **{f"{p}_status": run.status[p] for p in PHASES},
        "update_mode": mode,
        "total_seconds": run.seconds,
        "warnings": "; ".join(run.warnings),
    }
    kinds = {c: "double" if c == "total_seconds" else "string" for c in values}
    return run.spark.createDataFrame([tuple(values.values())], S.ddl(kinds))


def size_shuffles(run: Run) -> None:
    """Raise the number of shuffle partitions to suit the bytes of the days that are read; AQE
    joins small ones.

    The session's own number is a lower bound, so a larger setting is kept.
    """
    cfg, conf = run.cfg, run.spark.conf
    scanned = shards.bytes_of(run.spark, cfg.events_path, shift_day(cfg.start, -1), cfg.end)
    wanted = scanned // SCANNED_BYTES_PER_PARTITION
    if wanted > int(conf.get(SHUFFLE_PARTITIONS)):
        conf.set(SHUFFLE_PARTITIONS, str(wanted))


def run_batch(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Process the inclusive day range and return a one-row summary.

    A run has a session of its own, so runs side by side do not change each other's settings,
    and a folder of its own for intermediates, which goes when it ends.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in UTC_NAMES:
        raise ValueError("set spark.sql.session.timeZone to UTC")
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("tidemark.") or own.conf.isModifiable(key):
            own.conf.set(key, value)
    if cfg.raw_scroll_percent:
        own.conf.set(M.RAW_SCROLL, "true")
    run = Run(own, cfg, TableStore(own, cfg.target))
    with working_in(own, f"{cfg.target.rstrip('/')}/_work/{run.batch_id}"):
        return _run(run)


def _run(run: Run) -> DataFrame:
    spark, cfg = run.spark, run.cfg
    if cfg.start == cfg.end and not cfg.incremental:
        run.warnings.append(
            "single-day run without incremental mode rebuilds the event-level table"
        )
    try:
        events = shards.if_present(shards.read_events, spark, cfg.events_path)
        filled = events is not None and shards.has_rows(events, cfg.start, cfg.end)
        users = shards.if_present(shards.read_users, spark, cfg.users_path)
    except Exception as error:  # noqa: BLE001 - the status carries it
        run.status = {p: "SKIPPED" for p in PHASES}
        run.status["phase_0"] = f"FAILED: {str(error)[:ERROR_CHARS]}"
        append_run_log(run, 0)
        return summary(run, "ABORTED: source cannot be read")
    if not filled:
        run.status = {p: "SKIPPED: no source data" for p in PHASES}
        run.status["phase_0"] = f"SKIPPED: events of {cfg.start} not found or empty (row_count=0)"
        append_run_log(run, 0)
        return summary(run, "ABORTED: no source data")
    attempt(run, "phase_0", True, lambda: phase_0(run, events))
    attempt(run, "phase_1", run.status["phase_0"] == "SUCCESS", lambda: phase_1(run, events, users))
    ready = run.status["phase_1"].startswith("SUCCESS")
    attempt(run, "phase_2", ready, lambda: phase_2(run, events))
    written = run.status["phase_2"].startswith(("SUCCESS", "PARTIAL"))
    attempt(run, "phase_3a", written, lambda: phase_3a(run))
    attempt(
        run, "phase_3b", run.status["phase_3a"].startswith("SUCCESS"), lambda: phase_3b(run, events)
    )
    append_run_log(run, event_count(run))
    return summary(run, "ACCUMULATIVE" if cfg.incremental else "FULL_REBUILD")


def current_metrics(store: TableStore) -> dict[str, int | None]:
    """Sizes whose change tells of schema drift; None for a missing table."""

    def rows(table: str) -> int | None:
        return store.read(table).count() if store.exists(table) else None

    def width(table: str) -> int | None:
        columns = store.columns(table)
        return None if columns is None else len(columns)

    return {
        "mst_event_params_cnt": rows("mst_event_params"),
        "mst_item_params_cnt": rows("mst_item_params"),
        "micro_user_columns_cnt": width("micro_user_table"),
        "micro_items_columns_cnt": width("micro_items_table"),
    }


def append_snapshot(
    store: TableStore,
    cfg: BatchConfig,
    trigger: str,
    previous: dict | None,
    before: dict,
    after: dict,
    rerun: bool = False,
    created_by: str = PROCESSOR,
) -> None:
    """Snapshot row of one wrapper run with the changes before and during it."""
    values = (
        datetime.now(timezone.utc), trigger, cfg.start, cfg.end, cfg.reset, cfg.incremental,
        ",".join(schema_drift(previous, before)), ",".join(schema_drift(before, after)), rerun,
        *after.values(), cfg.client_id, created_by,
    )
    row = store.spark.createDataFrame([values], S.ddl(S.SNAPSHOT_LOG))
    store.append("log_daily_batch_schema_snapshot", row, S.SNAPSHOT_LOG)


def snapshot_run(
    store: TableStore, cfg: BatchConfig, trigger: str, before: dict, rerun: bool = False
) -> None:
    """Snapshot of a run that has ended, compared with ``before`` (its start) and with the newest
    snapshot in the log."""
    log = store.read("log_daily_batch_schema_snapshot", S.SNAPSHOT_LOG)
    last = control.latest(log, "snapshot_at", ["start_date"]).first()
    metrics = control.COUNT_METRICS + control.WIDTH_METRICS
    previous = {m: last[m] for m in metrics} if last else None
    append_snapshot(store, cfg, trigger, previous, before, current_metrics(store), rerun)


def recovery_list(
    store: TableStore, events_path: str, today: str, look_back: int = RECOVERY_DAYS
) -> list[str]:
    """Days of the last ``look_back`` that runs skipped and whose shards have rows now, in order."""
    cutoff = shift_day(today, -look_back)
    events = shards.if_present(shards.read_events, store.spark, events_path)
    if events is None:
        return []
    counts = shards.shard_counts(shards.in_shards(events, cutoff, today))
    log = store.read("log_batch_execution", S.RUN_LOG)
    days = control.recoverable_days(log, counts, cutoff).orderBy("end_date")
    return [row[0] for row in days.collect()]
