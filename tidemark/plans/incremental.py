"""The wide tables as a whole or by day ranges, without reading or rewriting their history.

Numbers of rows before a range do not change when later rows do; only the last earlier row of a
touched session may get another next host. What the new rows need of the history comes from the
carry tables (see :mod:`tidemark.plans.carry`) as *side rows*: one row for each touched user and
session, which travels through the one exchange of the new rows, stands before them in each
window with the carried count as its weight, and is taken out at the end. Of the wide tables only
days that are written again are read: the range, days whose last row of a session changes, and
later days of touched users (or item groups) in a backfill.

Event rows outside the range go through no window: a backfill moves the numbers of a user's and of
a session's later rows by one amount, and only the first later row of a session gets another
previous event. Both amounts and these rows are narrow tables, made from the range as it was
written, and the other days are copied with them; a table version shows all of it at once.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.lattice import widest_of
from tidemark.operators import evolve as V
from tidemark.operators import items as N
from tidemark.operators import micro as M
from tidemark.operators.columns import ColumnPlan
from tidemark.operators.events import SESSION, USER
from tidemark.operators.items import ITEM_GROUP, ITEM_ORDER
from tidemark.operators.micro import SIDE, is_row
from tidemark.operators.ordered import segmented_with_copies
from tidemark.operators.skew import (
    DETECT,
    HotGroups,
    broadcast_if_small,
    cut_lineage,
    hot_groups,
    hot_row_limit,
    is_small,
    known_or_detected,
    left_join,
    null_safe,
    prefixed,
    quoted,
    work_folder,
    working_in,
)
from tidemark.operators.upsert import update_from
from tidemark.plans import carry
from tidemark.plans.carry import ROW_KEY, semi_null_safe
from tidemark.plans.store import Part, TableStore, days_between

EVENTS_TABLE, ITEMS_TABLE = "micro_user_table", "micro_items_table"
USER_CLUSTER = ["user_pseudo_id", "user_id"]
ITEM_CLUSTER = ["user_pseudo_id", "item_id", "event_name"]
SEQUENCE_COLUMNS = [
    "session_event_no", "user_event_no", "prev_event_name", "seconds_from_prev_event",
    "prev_hostname_norm", "next_hostname_norm", "is_cross_domain_hop",
]
SIDE_DDL = "struct<kind: int, carried: bigint>"
OF_SESSION, OF_USER, OF_NEXT = 1, 2, 3
#: Smallest bigint: before all moments, and the session of side rows that belong to a user only.
FIRST = -(2**63)


def merged_types(stored: dict[str, str] | None, wanted: dict[str, str]) -> dict[str, str]:
    """Wanted columns in the wider of stored and wanted type."""
    out = {}
    for name, kind in wanted.items():
        old = (stored or {}).get(name, kind)
        if old != kind and old in S.LOGICAL_TYPE and kind in S.LOGICAL_TYPE:
            kind = S.SPARK_TYPE[widest_of([S.LOGICAL_TYPE[old], S.LOGICAL_TYPE[kind]])]
        out[name] = kind
    return out


def wide_schema(
    stored: dict[str, str], wanted: dict[str, str], head: dict[str, str], tail: dict[str, str]
) -> dict[str, str]:
    """Wanted and stored columns together, inferred ones by name between head and tail."""
    merged = merged_types(stored, stored | wanted)
    middle = sorted(set(merged) - set(head) - set(tail))
    return {c: merged[c] for c in [*head, *middle, *tail]}


def distinct_days(*frames: DataFrame) -> list[date]:
    """Dates present in the frames; at most one row per day comes to the driver."""
    days = set()
    for frame in frames:
        days |= {row[0] for row in frame.select("event_date").distinct().collect()}
    return sorted(d for d in days if d is not None)


def on_days(rows: DataFrame, days: list[date]) -> DataFrame:
    return rows.where(F.col("event_date").isin(days)) if days else rows.where(F.lit(False))


# -- event level -----------------------------------------------------------------------------


def build_events(
    store: TableStore, tables: DataFrame, attributes: DataFrame, plan: ColumnPlan, slots: list[str]
) -> None:
    """The event-level table and its carry tables from all given event-table rows."""
    store.note(carry.PENDING_EVENTS, [])
    rows = M.micro_user(tables, attributes, plan, slots)
    store.replace(EVENTS_TABLE, rows, ["event_date"], USER_CLUSTER, spread=True)
    carry.put_events(store, store.read(EVENTS_TABLE), tables, None)


def mend_events(store: TableStore, tables: DataFrame) -> None:
    """Make sums anew that an interrupted run, or a table of an older version, left out."""
    pending = store.noted(carry.PENDING_EVENTS)
    missing = not (store.exists(carry.USERS) and store.exists(carry.SESSIONS))
    if pending is None and not missing:
        return
    rows = store.read(EVENTS_TABLE)
    if not pending or missing:
        carry.put_events(store, rows, tables, None)
    else:
        days = [date.fromisoformat(day) for day in pending]
        carry.put_events(store, on_days(rows, days), on_days(tables, days), days)


def _side(kind: int, carried: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), carried.cast("bigint").alias("carried")).alias(SIDE)


def side_rows(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Carried state as rows that stand before the new ones of their session or user.

    A session that only brings a replay address is made a scroll row: it reaches the session
    facts and is left out with the scrolls before rows are numbered.
    """
    no_text = F.lit(None).cast("string")
    known = F.col("carried").isNotNull()
    of_session = sessions.select(
        *SESSION,
        F.when(known, F.col("event_timestamp_micros")).otherwise(F.lit(FIRST)).alias("event_timestamp_micros"),
        F.when(known, F.col("event_name")).otherwise(F.lit("scroll")).alias("event_name"),
        "hostname_norm",
        F.col("replay_url").alias("clarity_play_url"),
        _side(OF_SESSION, F.col("carried")),
    )
    of_user = users.select(
        *USER, F.lit(FIRST).alias("ga_session_id"), F.lit(FIRST).alias("event_timestamp_micros"),
        F.lit("").alias("event_name"), no_text.alias("hostname_norm"),
        no_text.alias("clarity_play_url"), _side(OF_USER, F.col("user_carry")),
    )
    return of_session.unionByName(of_user)


def next_rows(firsts: DataFrame) -> DataFrame:
    """The first later row of each session as a row that stands after the new ones."""
    return firsts.select(*ROW_KEY, "hostname_norm", _side(OF_NEXT, F.lit(None)))


def sequence_with_side_rows(rows: DataFrame) -> DataFrame:
    """Numbers and neighbours in the plain windows, going on from the side rows."""
    rows = M.with_session_key(rows)

    def weight(kind: int) -> Column:
        carried = F.when(F.col(SIDE)["kind"] == kind, F.col(SIDE)["carried"]).otherwise(0)
        return F.when(is_row(), 1).otherwise(carried)

    def number(window, kind: int) -> Column:
        return F.sum(weight(kind)).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))

    user = W.partitionBy(*USER).orderBy(*M.USER_ORDER.order)
    spec = M.SESSION_ORDER
    session = W.partitionBy(*SESSION).orderBy(*spec.order)
    columns = {"session_event_no": number(session, OF_SESSION)}
    columns |= {out: F.lag(source).over(session) for out, source in spec.lags.items()}
    columns |= {out: F.lead(source).over(session) for out, source in spec.leads.items()}
    numbered = rows.withColumn("user_event_no", number(user, OF_USER)).withColumns(columns)
    return numbered.drop(M.SESSION_KEY)


def sequence_with_joins(
    rows: DataFrame, users: DataFrame, sessions: DataFrame, hot: HotGroups
) -> DataFrame:
    """The same for hot users by segments, the carried state by joins."""
    last = sessions.where("carried IS NOT NULL").select(
        *SESSION, F.struct(*[c for c in sessions.columns if c not in SESSION]).alias("session_carry")
    )
    numbered = M.sequence_by_segment(rows, hot.segments())
    hot_sessions = hot_groups(rows, SESSION)
    joined = left_join(numbered, users, USER, nulls_match=True, hot=hot)
    joined = left_join(joined, last, SESSION, nulls_match=True, hot=hot_sessions)
    state = F.col("session_carry")
    opens = (F.col("session_event_no") == 1) & state.isNotNull()

    def or_carried(column: str, carried: str) -> Column:
        return F.when(opens, state[carried]).otherwise(F.col(column))

    return joined.withColumns(
        {
            "prev_event_name": or_carried("prev_event_name", "event_name"),
            "_prev_micros": or_carried("_prev_micros", "event_timestamp_micros"),
            "prev_hostname_norm": or_carried("prev_hostname_norm", "hostname_norm"),
            "session_event_no": F.col("session_event_no") + F.coalesce(state["carried"], F.lit(0)),
            "user_event_no": F.col("user_event_no") + F.coalesce(F.col("user_carry"), F.lit(0)),
        }
    ).drop("user_carry", "session_carry")


def fresh_rows(
    source: DataFrame,
    side: DataFrame,
    attributes: DataFrame,
    plan: ColumnPlan,
    slots: list[str],
    unnumbered: dict[str, str],
    hot: HotGroups | None,
    replay: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """New rows but for their numbers: (ordinary users' with the side rows, hot users').

    The ordinary rows stay partitioned by user from here to the last window.
    """
    ordinary, large = M.micro_rows(source, plan, hot, replay, side)
    ordinary = M.with_event_id(M.fill_slots(ordinary, attributes, slots, hot=None))
    ordinary = V.conform(ordinary, unnumbered | {SIDE: SIDE_DDL})
    if large is not None:
        large = M.with_event_id(M.fill_slots(large, hot.narrow(attributes), slots, hot=None))
        large = V.conform(large, unnumbered)
    return ordinary, large


def first_later_rows(later: DataFrame, sessions: DataFrame, bound: int) -> DataFrame:
    """The first row of each of these sessions among later days, with its present number."""
    first = F.min(F.struct("session_event_no", *ROW_KEY[2:], "hostname_norm")).alias("first")
    found = semi_null_safe(later, sessions, SESSION, bound).groupBy(*SESSION).agg(first)
    return cut_lineage(found.select(*SESSION, "first.*"))


def around_range(
    sessions: DataFrame, state: DataFrame, fresh: DataFrame, firsts: DataFrame | None
) -> DataFrame:
    """For each touched session its last row ``before`` the range, the number of its rows in the
    range as written, ``n``, their ``first`` and ``last`` one, and its first row ``after`` it."""
    at = ["session_event_no", *ROW_KEY[2:], "hostname_norm"]
    inside = fresh.groupBy(*SESSION).agg(
        F.count("*").alias("n"), F.min(F.struct(*at)).alias("first"), F.max(F.struct(*at)).alias("last")
    )
    before = state.where("carried IS NOT NULL").select(
        *SESSION, F.struct(*[c for c in state.columns if c not in SESSION]).alias("before")
    )
    out = left_join(sessions, before, SESSION, nulls_match=True, hot=None)
    out = left_join(out, inside, SESSION, nulls_match=True, hot=None)
    if firsts is not None:
        after = firsts.select(*SESSION, F.struct(*at).alias("after"))
        out = left_join(out, after, SESSION, nulls_match=True, hot=None)
    return cut_lineage(out)


def changed_ends(around: DataFrame) -> DataFrame:
    """Last rows before the range whose next host is another one now."""
    before, first = F.col("before"), F.col("first")
    after = F.col("after")["hostname_norm"] if "after" in around.columns else F.lit(None)
    new_next = F.when(first.isNotNull(), first["hostname_norm"]).otherwise(after)
    return around.where(before.isNotNull() & ~before["next_hostname_norm"].eqNullSafe(new_next)).select(
        *SESSION, *[before[c].alias(c) for c in ROW_KEY[2:]],
        before["last_date"].alias("event_date"), new_next.alias("next_hostname_norm"),
    )


def session_moves(around: DataFrame) -> DataFrame:
    """(session, number of its first later row, by how much the later numbers move, and the event
    that is before that row now)."""
    before, last, after = F.col("before"), F.col("last"), F.col("after")
    number = F.coalesce(before["carried"], F.lit(0)) + F.coalesce("n", F.lit(0)) + 1

    def previous(column: str) -> Column:
        return F.when(last.isNotNull(), last[column]).otherwise(before[column])

    return around.where(after.isNotNull()).select(
        *SESSION,
        F.struct(
            after["session_event_no"].alias("opens"), (number - after["session_event_no"]).alias("moved"),
            *[previous(c).alias(c) for c in (*ROW_KEY[2:], "hostname_norm")],
        ).alias("session_move"),
    )


def user_moves(fresh: DataFrame, old: DataFrame) -> DataFrame:
    """(user, user_move): rows of the user in the range now, less those that it had."""
    counts = fresh.select(*USER, F.lit(1).cast("bigint").alias("n")).unionByName(
        old.select(*USER, (-F.col("events")).alias("n"))
    )
    return counts.groupBy(*USER).agg(F.sum("n").alias("user_move")).where("user_move <> 0")


def join_moves(rows: DataFrame, moves: DataFrame, keys: list[str], number: int) -> DataFrame:
    """Rows with the moves of their user or session; only a large side moves the rows."""
    if not is_small(moves, number):
        return left_join(rows, moves, keys, nulls_match=True)
    return left_join(rows, F.broadcast(moves), keys, nulls_match=True, hot=None)


def moved_rows(
    rows: DataFrame, users: DataFrame, n_users: int, sessions: DataFrame, n_sessions: int
) -> DataFrame:
    """Later rows with their new numbers, and the new previous event of each session's first one."""
    joined = join_moves(rows, users, USER, n_users)
    joined = join_moves(joined, sessions, SESSION, n_sessions)
    move = F.col("session_move")
    opens = F.coalesce(F.col("session_event_no") == move["opens"], F.lit(False))

    def opening(column: str, value: Column) -> Column:
        return F.when(opens, value).otherwise(F.col(column))

    return joined.withColumns(
        {
            "prev_event_name": opening("prev_event_name", move["event_name"]),
            "seconds_from_prev_event": opening(
                "seconds_from_prev_event", M.gap_seconds(move["event_timestamp_micros"])
            ),
            "prev_hostname_norm": opening("prev_hostname_norm", move["hostname_norm"]),
            "is_cross_domain_hop": opening("is_cross_domain_hop", M.is_hop(move["hostname_norm"])),
            "session_event_no": F.col("session_event_no") + F.coalesce(move["moved"], F.lit(0)),
            "user_event_no": F.col("user_event_no") + F.coalesce("user_move", F.lit(0)),
        }
    ).select(*quoted(rows.columns))


def update_events(
    store: TableStore,
    tables: DataFrame,
    attributes: DataFrame,
    plan: ColumnPlan,
    slots: list[str],
    start: date,
    end: date,
    hot=DETECT,
) -> None:
    """Event-level rows of ``[start, end]`` made anew from the event-table rows of these days.

    Rows after ``end`` of users that the range touches are numbered anew; those of other users
    are copied if their day is written again. ``hot`` may hold the hot users of the range.
    """
    mend_events(store, tables)
    carry.total_users(store, start)
    wanted = M.micro_schema(plan, slots)
    target = wide_schema(
        store.columns(EVENTS_TABLE), wanted, S.MICRO_USER_HEAD, S.USER_DATE_COLUMNS | S.BATCH_ID
    )
    store.evolve(EVENTS_TABLE, target, USER_CLUSTER)
    history = store.read(EVENTS_TABLE)
    in_range = F.col("event_date").between(F.lit(start), F.lit(end))
    source = tables.where(in_range)

    sums = store.read(carry.SESSIONS)
    sessions = source.select(*SESSION).union(sums.where(in_range).select(*SESSION)).distinct()
    sessions = cut_lineage(sessions)
    n_sessions = sessions.count()
    users = sessions.select(*USER).distinct()
    firsts, later_days = None, [day for day in store.days(EVENTS_TABLE) if day > end]
    if later_days:
        users = cut_lineage(users)
        after = store.read(carry.USERS).where(F.col("event_date") > F.lit(end))
        later_days = distinct_days(semi_null_safe(after, users, USER, n_sessions))
    if later_days:
        firsts = first_later_rows(on_days(history, later_days), sessions, n_sessions)
    hot = known_or_detected(hot, source, USER)

    session_state = carry.session_carry(store, sessions, start, end, n_sessions)
    user_state = carry.user_carry(store, users, start, n_sessions)
    unnumbered = {c: t for c, t in target.items() if c not in SEQUENCE_COLUMNS}
    if hot is None:
        side, replay = side_rows(user_state, session_state), None
        side = side if firsts is None else side.unionByName(next_rows(firsts), allowMissingColumns=True)
    else:
        user_state = cut_lineage(user_state)
        cold_users, hot_users = hot.split(user_state)
        cold_sessions, hot_sessions = hot.split(session_state)
        side, hot_firsts = side_rows(cold_users, cold_sessions), None
        if firsts is not None:
            cold_firsts, hot_firsts = hot.split(firsts)
            side = side.unionByName(next_rows(cold_firsts), allowMissingColumns=True)
        urls = hot_sessions.select(*SESSION, F.col("replay_url").alias("session_replay_url"))
        urls = urls.unionByName(M.replay_urls(hot.split(source)[1]))
        replay = urls.groupBy(*SESSION).agg(F.max("session_replay_url").alias("session_replay_url"))
    ordinary, large = fresh_rows(source, side, attributes, plan, slots, unnumbered, hot, replay)
    rows = M.gap_and_hop(sequence_with_side_rows(ordinary)).where(is_row()).drop(SIDE)
    if large is not None:
        large = large.withColumn(SIDE, F.lit(None).cast(SIDE_DDL))
        if hot_firsts is not None:
            large = large.unionByName(next_rows(hot_firsts), allowMissingColumns=True)
        linked = sequence_with_joins(cut_lineage(large), hot_users, hot_sessions, hot)
        linked = M.gap_and_hop(linked).where(is_row()).drop(SIDE)
        rows = rows.unionByName(linked, allowMissingColumns=True)

    number = store.stage_days(EVENTS_TABLE, rows, USER_CLUSTER, spread=True)
    fresh = store.staged(EVENTS_TABLE, number)
    around = around_range(sessions, session_state, fresh, firsts)
    changed = cut_lineage(changed_ends(around))
    n_changed = changed.count()
    boundary_days, days = distinct_days(changed), days_between(start, end)
    staged, new_next = {number: days}, changed.drop("event_date")
    others, small = [], is_small(new_next, n_changed)
    if boundary_days:
        others.append(
            update_from(
                on_days(history, boundary_days), new_next, ROW_KEY, ["next_hostname_norm"],
                source_rows=n_changed,
            )
        )
    if later_days:
        by_user = cut_lineage(user_moves(fresh, store.read(carry.USERS).where(in_range)))
        by_session = cut_lineage(session_moves(around))
        sizes = by_user.count(), by_session.count()
        others.append(moved_rows(on_days(history, later_days), by_user, sizes[0], by_session, sizes[1]))
        small = small and is_small(by_user, sizes[0]) and is_small(by_session, sizes[1])
    if others:  # copied file by file, but spread by day again where a join has moved the rows
        copies = functools.reduce(DataFrame.unionByName, others)
        copied = store.stage_days(EVENTS_TABLE, copies, USER_CLUSTER, spread=not small, after=number)
        staged[copied] = [*boundary_days, *later_days]
    pending = sorted({day for written in staged.values() for day in written})
    store.note(carry.PENDING_EVENTS, [day.isoformat() for day in pending])
    store.publish_days(EVENTS_TABLE, staged)
    carry.put_events(
        store, on_days(store.read(EVENTS_TABLE), days), on_days(tables, days), days, new_next, boundary_days
    )


# -- item level ------------------------------------------------------------------------------


def in_local_days(at: Column, start: date, end: date) -> Column:
    """Local time within whole days, as bounds that reach the scan; NULL is outside."""
    opens = F.lit(datetime.combine(start, datetime.min.time())).cast("timestamp_ntz")
    closes = F.lit(datetime.combine(end + timedelta(days=1), datetime.min.time())).cast(
        "timestamp_ntz"
    )
    return at.isNotNull() & (at >= opens) & (at < closes)


def finished_items(columns: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """What a store does with numbered item rows after it has spread them."""
    return lambda rows: V.conform(N.with_made_columns(rows), columns)


def build_items(store: TableStore, rows: DataFrame, wanted: dict[str, str], hot=DETECT) -> None:
    """The item-level table and its carry table from exploded rows.

    Many rows are written in parts of whole sessions, so that the shuffle files of one part are the
    most there are at a time.
    """
    spark = rows.sparkSession
    store.note(carry.PENDING_ITEMS, [])
    with working_in(spark, f"{work_folder(spark)}/items-{uuid.uuid4().hex}"):
        rows = cut_lineage(rows.drop(*N.MADE_COLUMNS))
        hot, finish = known_or_detected(hot, rows, USER), finished_items(wanted)
        parts = [
            Part(N.number_items(rows.where(part), hot), True, finish)
            for part in N.session_parts(spark, rows.count())
        ]
        store.replace_in_parts(ITEMS_TABLE, parts, wanted, ["event_date"], ITEM_CLUSTER)
    carry.put_items(store, store.read(ITEMS_TABLE), None)


def mend_items(store: TableStore) -> None:
    pending = store.noted(carry.PENDING_ITEMS)
    if pending is None and store.exists(carry.ITEMS):
        return
    rows = store.read(ITEMS_TABLE)
    if not pending or not store.exists(carry.ITEMS):
        carry.put_items(store, rows, None)
    else:
        days = [date.fromisoformat(day) for day in pending]
        carry.put_items(store, on_days(rows, days), days)


def number_items_after(rows: DataFrame, before: DataFrame, hot: HotGroups | None) -> DataFrame:
    """Item numbers that go on from the carried counts (group, carried).

    The counts of ordinary users' groups are side rows of the same exchange, dealt by session like
    :func:`tidemark.operators.items.number_items`; those of hot users' are a join.
    """
    rows = rows.withColumn("_row", F.xxhash64(*quoted(rows.columns)))
    number, order = ITEM_ORDER.number, ITEM_ORDER.order
    ordinary, large = (rows, None) if hot is None else hot.split(rows)
    cold, warm = (before, None) if hot is None else hot.split(before)
    side = cold.withColumn("event_timestamp_micros", F.lit(FIRST))
    window = W.partitionBy(*ITEM_GROUP).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    both = ordinary.unionByName(side, allowMissingColumns=True).repartition(*SESSION)
    out = both.withColumn(number, F.sum(F.coalesce("carried", F.lit(1))).over(window))
    out = out.where("carried IS NULL").drop("carried", "_row")
    if large is None:
        return out
    counted = segmented_with_copies(
        large, ITEM_GROUP, order, number, hot.segments(), hot_row_limit(rows.sparkSession)
    ).drop("_row")
    joined = left_join(counted, warm, ITEM_GROUP, nulls_match=True)
    joined = joined.withColumn(number, F.col(number) + F.coalesce("carried", F.lit(0)))
    return out.unionByName(joined.drop("carried"))


def item_moves(fresh: DataFrame, removed: DataFrame, after: DataFrame) -> DataFrame:
    """(group, moved): by how much the later numbers of a group move, where it has later rows and
    the range holds another number of its rows now."""
    counts = fresh.select(*ITEM_GROUP, F.lit(1).cast("bigint").alias("n")).unionByName(
        removed.select(*ITEM_GROUP, (-F.col("items")).alias("n"))
    )
    later = after.select(*ITEM_GROUP, F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("later"))
    found = counts.unionByName(later, allowMissingColumns=True).groupBy(*ITEM_GROUP)
    summed = found.agg(F.sum("n").alias("moved"), F.max("later").alias("later"))
    return summed.where("later AND moved <> 0").drop("later")


def moved_items(rows: DataFrame, moves: DataFrame, n_moves: int, end: date) -> DataFrame:
    """Rows of which the later ones have their new numbers."""
    is_later = F.coalesce(F.to_date("event_timestamp") > F.lit(end), F.lit(False))
    moved = F.when(is_later, F.coalesce("moved", F.lit(0))).otherwise(0)
    joined = join_moves(rows, moves, ITEM_GROUP, n_moves)
    return joined.withColumn(ITEM_ORDER.number, F.col(ITEM_ORDER.number) + moved).drop("moved")


def update_items(
    store: TableStore, rows: DataFrame, wanted: dict[str, str], start: date, end: date, hot=DETECT
) -> None:
    """Item rows whose local day lies in the range replaced by ``rows`` (not numbered yet).

    Items are partitioned by the source's day, which may differ from the local day. The numbers of
    a group's later rows move by one amount, so all kept rows of a rewritten day are copied, with it
    added; days without such rows stay. New rows are numbered and written in parts of whole
    sessions. Intermediates go when the days are written.
    """
    spark = rows.sparkSession
    with working_in(spark, f"{work_folder(spark)}/items-{uuid.uuid4().hex}"):
        _update_items(store, rows, wanted, start, end, hot)


def _update_items(
    store: TableStore, rows: DataFrame, wanted: dict[str, str], start: date, end: date, hot
) -> None:
    mend_items(store)
    target = wide_schema(
        store.columns(ITEMS_TABLE), wanted, S.MICRO_ITEMS_HEAD, S.MICRO_ITEMS_TAIL
    )
    store.evolve(ITEMS_TABLE, target, ITEM_CLUSTER)
    taken = {c: t for c, t in target.items() if c not in (ITEM_ORDER.number, *N.MADE_COLUMNS)}
    fresh = cut_lineage(V.conform(rows, taken))
    sums, local = store.read(carry.ITEMS), F.col("local_date")
    removed = sums.where(local.between(F.lit(start), F.lit(end)))
    groups = cut_lineage(
        fresh.select(*ITEM_GROUP).union(removed.select(*ITEM_GROUP)).distinct()
    )
    n_groups = groups.count()
    near = carry.near("ga_session_id", groups)
    before = semi_null_safe(
        sums.where(near & (local < F.lit(start))), groups, ITEM_GROUP, n_groups
    ).groupBy(*ITEM_GROUP).agg(F.sum("items").alias("carried"))
    after = sums.where(near & (local > F.lit(end)))
    moves = cut_lineage(item_moves(fresh, removed, semi_null_safe(after, groups, ITEM_GROUP, n_groups)))
    n_moves = moves.count()
    later_days = distinct_days(semi_null_safe(after, moves, ITEM_GROUP, n_moves)) if n_moves else []
    own_days = distinct_days(fresh, removed)
    days = sorted({*own_days, *later_days})
    if not days:
        return
    finish = finished_items(target)
    hot = known_or_detected(hot, fresh, USER)
    before = cut_lineage(before)
    parts = [
        Part(number_items_after(fresh.where(part), before.where(part), hot), True, finish)
        for part in N.session_parts(store.spark, fresh.count())
    ]
    history, at = on_days(store.read(ITEMS_TABLE), days), F.col("event_timestamp")
    kept = history.where(~F.coalesce(in_local_days(at, start, end), F.lit(False)))
    if n_moves:
        kept = moved_items(kept, moves, n_moves, end)
    # Kept rows are copied file by file, but spread by day again where a join has moved them.
    copies = Part(V.conform(kept, target), spread=bool(n_moves) and not is_small(moves, n_moves))
    staged = store.stage_parts(ITEMS_TABLE, [*parts, copies], ITEM_CLUSTER)
    store.note(carry.PENDING_ITEMS, [day.isoformat() for day in own_days])
    store.publish_days(ITEMS_TABLE, {staged: days})
    carry.put_items(store, on_days(store.read(ITEMS_TABLE), own_days), own_days)
