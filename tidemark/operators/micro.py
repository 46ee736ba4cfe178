"""Event-level table: key sessions, assembly, scroll fold, dedup, numbering, slots.

Ordinary users are handled in one partitioning by user: session facts are window
aggregates, so there is no join to shuffle for. Hot users get the same columns from
pre-aggregated joins and segmented windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions import ids
from tidemark.functions.params import to_integer
from tidemark.operators.columns import ColumnPlan
from tidemark.operators.events import SESSION, USER
from tidemark.operators.evolve import conform
from tidemark.operators.ordered import Ordering, segmented, windowed
from tidemark.operators.skew import (
    DETECT,
    HotGroups,
    hot_groups,
    known_or_detected,
    left_join,
    quoted,
)

RAW_SCROLL = "tidemark.rawScrollPercent"
SESSION_ORDER = Ordering(
    group=SESSION,
    order=["event_timestamp_micros", "event_name"],
    number="session_event_no",
    lags={
        "prev_event_name": "event_name",
        "_prev_micros": "event_timestamp_micros",
        "prev_hostname_norm": "hostname_norm",
    },
    leads={"next_hostname_norm": "hostname_norm"},
)
SESSION_KEY = "_session_key"
SIDE = "_side"
USER_ORDER = Ordering(
    group=USER,
    order=["event_timestamp_micros", "event_name", SESSION_KEY],
    number="user_event_no",
)


def with_session_key(rows: DataFrame) -> DataFrame:
    """Session number with -1 for none, as in the dedup key.

    Dedup and user numbering sort by the same column, so the second needs no sort.
    """
    if SESSION_KEY in rows.columns:
        return rows
    return rows.withColumn(SESSION_KEY, F.coalesce("ga_session_id", F.lit(-1).cast("bigint")))


def key_sessions(events: DataFrame) -> DataFrame:
    """Distinct (user, session) with a key event."""
    return events.where(ids.is_key_event_name(F.col("event_name"))).select(*SESSION).distinct()


def replay_urls(events: DataFrame) -> DataFrame:
    """One replay address per (user, session)."""
    starts = events.where(
        (F.col("event_name") == "session_start") & F.col("clarity_play_url").isNotNull()
    )
    return starts.groupBy(*SESSION).agg(F.max("clarity_play_url").alias("session_replay_url"))


def scroll_number(events: DataFrame) -> Column:
    """Scroll value as a whole number: of the share, or with ``tidemark.rawScrollPercent`` of the
    percentage as it was sent."""
    share = F.col("percent_scrolled")
    raw = events.sparkSession.conf.get(RAW_SCROLL, "false").lower() == "true"
    return to_integer(share * 100 if raw else share)


def scroll_depth(events: DataFrame) -> DataFrame:
    """Largest scroll value per page view.

    The value is the stored hundredth rounded to an integer, as in the data model.
    """
    scrolls = events.where((F.col("event_name") == "scroll") & F.col("page_view_id").isNotNull())
    return scrolls.groupBy("page_view_id").agg(
        F.max(scroll_number(events)).alias("page_scroll")
    )


def _with_scroll_source(rows: DataFrame) -> DataFrame:
    if "percent_scrolled" in rows.columns:
        return rows
    return rows.withColumn("percent_scrolled", F.lit(None).cast("double"))


def fold_facts(rows: DataFrame) -> DataFrame:
    """Turn the session and page facts of the assembled columns into final values."""
    page = F.col("event_name") == "page_view"
    return rows.withColumns(
        {
            "is_key_event": F.coalesce(F.col("session_is_key"), F.lit(0)).cast("bigint"),
            "clarity_play_url": F.when(
                F.col("event_name") == "session_start", F.col("clarity_play_url")
            ).otherwise(F.col("session_replay_url")),
            "max_scroll_percent": F.when(page, F.col("page_scroll")),
        }
    ).drop("session_is_key", "session_replay_url", "page_scroll")


def is_row() -> Column:
    """Whether this is an event and not a side row that carries state into a window."""
    return F.col(SIDE).isNull()


def facts_by_window(rows: DataFrame) -> DataFrame:
    """Session and page facts as window aggregates (rows already partitioned by user).

    Side rows bring the replay address of sessions whose start the rows may not cover.
    """
    session = W.partitionBy(*SESSION)
    # Peers by page view id inside the session: one sort serves both windows.
    page = session.orderBy("page_view_id").rangeBetween(W.currentRow, W.currentRow)
    known = F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull()
    event = F.col("event_name")
    depth = F.when(
        (event == "scroll") & F.col("page_view_id").isNotNull(),
        scroll_number(rows),
    )
    hit = ids.is_key_event_name(event) & known
    starts = (event == "session_start") & known
    if SIDE in rows.columns:
        hit, starts = hit & is_row(), starts | (known & ~is_row())
    facts = {
        "session_is_key": F.max(F.when(hit, 1)).over(session),
        "session_replay_url": F.max(F.when(starts, F.col("clarity_play_url"))).over(session),
    }
    return rows.withColumn("page_scroll", F.max(depth).over(page)).withColumns(facts)


def facts_by_join(rows: DataFrame, replay: DataFrame | None = None) -> DataFrame:
    """The same facts from pre-aggregated joins."""
    keys = key_sessions(rows).withColumn("session_is_key", F.lit(1))
    urls = replay_urls(rows) if replay is None else replay
    facts = keys.join(urls, SESSION, "full_outer")
    pages = ["page_view_id"]
    hot_sessions, hot_pages = hot_groups(rows, SESSION), hot_groups(rows, pages)
    with_session = left_join(rows, facts, SESSION, hot=hot_sessions)
    return left_join(with_session, scroll_depth(rows), pages, hot=hot_pages)


def _dedup(rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c != "page_view_id"]
    whole = F.xxhash64(*quoted(rest))
    rows = with_session_key(rows)
    window = W.partitionBy(
        "user_pseudo_id", "event_timestamp_micros", "event_name", SESSION_KEY
    ).orderBy("page_view_id", whole)
    return rows.withColumn("_copy", F.row_number().over(window)).where("_copy = 1").drop("_copy")


def dedup_events(rows: DataFrame) -> DataFrame:
    """One row per (user, microsecond, event, session), the first by page view id.

    Copies of one event are cut down in each map task before any shuffle.
    """
    return _dedup(rows).drop(SESSION_KEY)


def sequence_by_window(rows: DataFrame) -> DataFrame:
    by_user = windowed(with_session_key(rows), USER_ORDER)
    return windowed(by_user, SESSION_ORDER).drop(SESSION_KEY)


def sequence_by_segment(rows: DataFrame, segments: int) -> DataFrame:
    by_user = segmented(with_session_key(rows), USER_ORDER, segments)
    return segmented(by_user, SESSION_ORDER, segments).drop(SESSION_KEY)


def gap_seconds(before: Column) -> Column:
    """Whole seconds since the moment of the session's previous event."""
    return to_integer((F.col("event_timestamp_micros") - before) / 1_000_000)


def is_hop(host_before: Column) -> Column:
    return F.coalesce(host_before != F.col("hostname_norm"), F.lit(False))


def gap_and_hop(rows: DataFrame) -> DataFrame:
    """Seconds since the session's previous event, and whether the host changed."""
    return rows.withColumns(
        {
            "seconds_from_prev_event": gap_seconds(F.col("_prev_micros")),
            "is_cross_domain_hop": is_hop(F.col("prev_hostname_norm")),
        }
    ).drop("_prev_micros")


def sequence(rows: DataFrame, hot=DETECT) -> DataFrame:
    """Numbers, previous event, gap, neighbouring hosts and hops per session and user."""
    hot = known_or_detected(hot, rows, USER)
    if hot is None:
        return gap_and_hop(sequence_by_window(rows.repartition("user_pseudo_id")))
    ordinary, large = hot.split(rows)
    both = sequence_by_window(ordinary.repartition("user_pseudo_id")).unionByName(
        sequence_by_segment(large, hot.segments())
    )
    return gap_and_hop(both)


def with_event_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "event_id",
        ids.event_id(
            F.col("user_pseudo_id"),
            F.col("event_timestamp_micros"),
            F.col("event_name"),
            F.col("ga_session_id"),
        ),
    )


def assemble_events(tables: DataFrame, hot=DETECT) -> DataFrame:
    """Deduplicated events with key-session flag, replay address and folded scroll depth."""
    rows = _with_scroll_source(tables)
    hot = known_or_detected(hot, rows, USER)

    def finish(with_facts: DataFrame) -> DataFrame:
        return dedup_events(fold_facts(with_facts.where(F.col("event_name") != "scroll")))

    if hot is None:
        return finish(facts_by_window(rows.repartition("user_pseudo_id")))
    ordinary, large = hot.split(rows)
    return finish(facts_by_window(ordinary.repartition("user_pseudo_id"))).unionByName(
        finish(facts_by_join(large))
    )


def fill_slots(
    rows: DataFrame, attributes: DataFrame, slots: list[str], hot=DETECT
) -> DataFrame:
    """Slot values and user dates of the user's newest attributes; user id if still unknown."""
    side = attributes.select(
        "user_pseudo_id",
        F.col("user_id").alias("attribute_user_id"),
        *slots,
        *S.USER_DATE_COLUMNS,
    )
    filled = left_join(rows, side, USER, hot=hot)
    return filled.withColumn(
        "user_id", F.coalesce("user_id", "attribute_user_id")
    ).drop("attribute_user_id")


def micro_schema(plan: ColumnPlan, slots: list[str]) -> dict[str, str]:
    """Columns of the event-level table: fixed, then parameters and slots by name, then user dates."""
    dynamic = plan.final_types() | {slot: "string" for slot in slots}
    ordered = {name: dynamic[name] for name in sorted(dynamic)}
    return S.MICRO_USER_HEAD | ordered | S.USER_DATE_COLUMNS | S.BATCH_ID


def typed_dynamic_columns(rows: DataFrame, plan: ColumnPlan) -> DataFrame:
    """Final parameter columns in place of the raw ones."""
    event = F.col("event_name")
    fixed = [c for c in rows.columns if c not in plan.raw_types()]
    return rows.select(*quoted(fixed), *[c.expression(event).alias(c.name) for c in plan.final])


def micro_rows(
    tables: DataFrame,
    plan: ColumnPlan,
    hot: HotGroups | None,
    replay: DataFrame | None = None,
    side: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Deduplicated rows with facts: (rows of ordinary users, rows of hot users).

    ``side`` rows travel with those of ordinary users through the same exchange; ``replay`` has
    the replay addresses for hot users, if the rows do not cover their sessions' starts.
    """
    rows = _with_scroll_source(tables)

    def by_user(ordinary: DataFrame) -> DataFrame:
        if side is not None:
            ordinary = ordinary.unionByName(side, allowMissingColumns=True)
        return facts_by_window(ordinary.repartition(*USER))

    def finish(with_facts: DataFrame) -> DataFrame:
        kept = fold_facts(with_facts.where(F.col("event_name") != "scroll"))
        return _dedup(typed_dynamic_columns(kept, plan))

    if hot is None:
        return finish(by_user(rows)), None
    ordinary, large = hot.split(rows)
    return finish(by_user(ordinary)), finish(facts_by_join(large, replay))


def with_attributes(
    ordinary: DataFrame,
    large: DataFrame | None,
    attributes: DataFrame,
    slots: list[str],
    hot: HotGroups | None,
) -> DataFrame:
    """Both kinds of rows with user attributes and event id."""
    rows = fill_slots(ordinary, attributes, slots, hot=None)
    if large is not None:
        rows = rows.unionByName(fill_slots(large, hot.narrow(attributes), slots, hot=None))
    return with_event_id(rows)


def micro_user(
    tables: DataFrame,
    attributes: DataFrame,
    plan: ColumnPlan,
    slots: list[str],
    hot=DETECT,
) -> DataFrame:
    """The event-level table of the given event-table rows, in its final schema."""
    hot = known_or_detected(hot, tables, USER)
    ordinary, large = micro_rows(tables, plan, hot)
    ordinary = sequence_by_window(ordinary)
    if large is not None:
        large = sequence_by_segment(large, hot.segments())
    complete = with_attributes(ordinary, large, attributes, slots, hot)
    return conform(gap_and_hop(complete), micro_schema(plan, slots))
