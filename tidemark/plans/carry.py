"""Carried state of the wide tables: what a day adds to its users, sessions and item groups.

The numbers of a new day's rows go on where the user's, the session's or the item's earlier rows
ended. Instead of the wide history three narrow tables are read, partitioned by day like the
tables that they sum up, so a rewritten day replaces its own sums and a backfill finds the state
before any day:

* ``carry_user_days``: rows of a user on a day. ``carry_user_totals`` sums them up to a day, so
  that a run reads one row for each user and the days since. A day rewritten below it drops it;
  it is made anew once ``TOTAL_AFTER_DAYS`` days have come together.
* ``carry_session_days``: rows, last row and replay address of a session on a day, sorted by the
  session's number. Sessions of a day have close numbers, so the range of the wanted numbers
  skips the files of other times by their footers.
* ``carry_item_days``: rows of a (user, session, item) by source day and local day.

Before a wide day is replaced its date is noted in the store, and the note goes when the sums are
written; a run that finds a note makes these days' sums anew, so an interrupted run repairs itself.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.events import SESSION, USER
from tidemark.operators.items import ITEM_GROUP
from tidemark.operators.skew import broadcast_if_small, cut_lineage, null_safe, prefixed
from tidemark.operators.upsert import update_from
from tidemark.plans.store import TableStore

USERS, USER_TOTALS = "carry_user_days", "carry_user_totals"
SESSIONS, ITEMS = "carry_session_days", "carry_item_days"
EVENT_CARRY = [USERS, USER_TOTALS, SESSIONS]
PENDING_EVENTS, PENDING_ITEMS = "pending_event_days", "pending_item_days"
TOTAL_AFTER_DAYS = 28
ROW_KEY = [*SESSION, "event_timestamp_micros", "event_name"]
LAST_ROW = ["event_timestamp_micros", "event_name", "hostname_norm", "next_hostname_norm"]


def semi_null_safe(rows: DataFrame, keys_of: DataFrame, keys: list[str], bound: int | None = None) -> DataFrame:
    """Rows whose keys are in ``keys_of``, NULL matching NULL; broadcast if ``bound`` allows."""
    side = prefixed(keys_of.select(*keys), keys)
    side = side if bound is None else broadcast_if_small(side, bound)
    return rows.join(side, null_safe(rows, side, keys), "left_semi")


def user_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*USER, "event_date").agg(F.count("*").alias("events"))


def session_days(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Sums of the wide ``rows`` and replay addresses of the event-table rows of the same days."""
    last = F.struct("session_event_no", *LAST_ROW)
    own = rows.select(
        *SESSION, "event_date", F.lit(1).alias("n"), last.alias("last"),
        F.lit(None).cast("string").alias("url"),
    )
    kind = own.schema["last"].dataType
    starts = tables.where("event_name = 'session_start' AND clarity_play_url IS NOT NULL").select(
        *SESSION, "event_date", F.lit(0).alias("n"), F.lit(None).cast(kind).alias("last"),
        F.col("clarity_play_url").alias("url"),
    )
    found = own.unionByName(starts).groupBy(*SESSION, "event_date").agg(
        F.sum("n").alias("events"), F.max("last").alias("last"), F.max("url").alias("replay_url")
    )
    return found.select(
        *SESSION, "events", *[F.col(f"last.{c}").alias(c) for c in LAST_ROW], "replay_url", "event_date"
    )


def item_days(rows: DataFrame) -> DataFrame:
    local = F.to_date("event_timestamp").alias("local_date")
    return rows.groupBy(*ITEM_GROUP, local, "event_date").agg(F.count("*").alias("items")).select(
        *ITEM_GROUP, "local_date", "items", "event_date"
    )


def _put(store: TableStore, table: str, sums: DataFrame, days: list[date] | None, cluster: list[str]) -> None:
    """Sums of these days in place of older ones; of all days if ``days`` is None."""
    if days is None or not store.exists(table):
        store.replace(table, sums, ["event_date"], cluster, spread=True)
    else:
        store.overwrite_days(table, sums, days, cluster, spread=True)


def put_events(
    store: TableStore,
    rows: DataFrame,
    tables: DataFrame,
    days: list[date] | None,
    turned: DataFrame | None = None,
    turned_days: list[date] = (),
) -> None:
    """Write the sums of wide event rows; ``rows`` and ``tables`` hold these days.

    ``turned`` are last rows of sessions on other days (``turned_days``) that got a new next host;
    nothing else of these days' sums changes.
    """
    totals = store.read(USER_TOTALS).first() if store.exists(USER_TOTALS) else None
    if days is None or (totals and totals["until"] >= min(days)):
        store.clear(USER_TOTALS)
    sums = user_days(rows).select(*USER, "events", "event_date")
    _put(store, USERS, sums, days, USER)
    sessions = session_days(rows, tables)
    if turned_days:
        old = store.read(SESSIONS).where(F.col("event_date").isin(turned_days))
        sessions = sessions.unionByName(
            update_from(old, turned, ROW_KEY, ["next_hostname_norm"], source_rows=turned.count())
        )
        days = [*days, *turned_days]
    _put(store, SESSIONS, sessions, days, ["ga_session_id"])
    store.note(PENDING_EVENTS, None)


def put_items(store: TableStore, rows: DataFrame, days: list[date] | None) -> None:
    _put(store, ITEMS, item_days(rows), days, ["ga_session_id"])
    store.note(PENDING_ITEMS, None)


def user_carry(store: TableStore, users: DataFrame, start: date, bound: int | None = None) -> DataFrame:
    """(user, user_carry) before ``start`` of the given users."""
    days = store.read(USERS).where(F.col("event_date") < F.lit(start))
    sums = days.select(*USER, "events")
    if store.exists(USER_TOTALS):
        totals = store.read(USER_TOTALS)
        row = totals.select("until").first()
        if row and row["until"] < start:
            since = days.where(F.col("event_date") > F.lit(row["until"]))
            sums = since.select(*USER, "events").unionByName(totals.select(*USER, "events"))
    return semi_null_safe(sums, users, USER, bound).groupBy(*USER).agg(F.sum("events").alias("user_carry"))


def total_users(store: TableStore, start: date) -> None:
    """Sum the days before ``start`` up if many have come together since the last time."""
    known = [day for day in store.days(USERS) if day < start]
    if not known:
        return
    until, old = max(known), None
    if store.exists(USER_TOTALS):
        row = store.read(USER_TOTALS).select("until").first()
        old = row["until"] if row else None
    fresh = [day for day in known if old is None or day > old]
    if len(fresh) < TOTAL_AFTER_DAYS:
        return
    days = store.read(USERS).where(F.col("event_date").between(F.lit(min(fresh)), F.lit(until)))
    sums = days.select(*USER, "events")
    if old is not None:
        sums = sums.unionByName(store.read(USER_TOTALS).select(*USER, "events"))
    totals = sums.groupBy(*USER).agg(F.sum("events").alias("events"))
    store.replace(USER_TOTALS, totals.withColumn("until", F.lit(until)), cluster=USER)


def near(number: str, sessions: DataFrame):
    """Condition that a session number lies in the range of the wanted ones, or is NULL."""
    low, high = sessions.agg(F.min(number), F.max(number)).first()
    inside = F.col(number).isNull()
    return inside if low is None else inside | F.col(number).between(F.lit(low), F.lit(high))


def session_carry(
    store: TableStore, sessions: DataFrame, start: date, end: date, bound: int | None = None
) -> DataFrame:
    """(session, carried rows, last row and its day before ``start``, replay address outside the range)."""
    day = F.col("event_date")
    outside = store.read(SESSIONS).where((day < F.lit(start)) | (day > F.lit(end)))
    wanted = semi_null_safe(outside.where(near("ga_session_id", sessions)), sessions, SESSION, bound)
    before = (day < F.lit(start)) & (F.col("events") > 0)
    last = F.struct("event_date", *LAST_ROW)
    found = wanted.groupBy(*SESSION).agg(
        F.sum(F.when(before, F.col("events"))).alias("carried"),
        F.max(F.when(before, last)).alias("last"),
        F.max("replay_url").alias("replay_url"),
    )
    return cut_lineage(
        found.select(
            *SESSION, "carried", "replay_url", F.col("last.event_date").alias("last_date"),
            *[F.col(f"last.{c}").alias(c) for c in LAST_ROW],
        )
    )
