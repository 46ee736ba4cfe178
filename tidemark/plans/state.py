"""Identity and property state that a run extends by its own shards and settings.

``carry_identity_days`` holds, by shard, the newest user id of each pseudonymous id; the map of a
look-back range combines these rows and does not scan the events again. A note lists the shards
that are summed up with the size and time of their folders, so a shard that was delivered again is
summed up again.

``carry_properties`` holds sums for each property, ``carry_property_users`` the (property, user)
pairs that were seen; a run adds its new settings to both. A note marks the time between the log
and its state, after which an interrupted run makes the state anew from the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.ids import parse_day, shift_day
from tidemark.operators import identity as I
from tidemark.operators.events import USER
from tidemark.operators.skew import cut_lineage, null_safe, prefixed
from tidemark.plans.store import TableStore
from tidemark.sources import shards
from tidemark.sources.shards import empty

IDENTITY_DAYS, PROPERTIES, PROPERTY_USERS = (
    "carry_identity_days", "carry_properties", "carry_property_users",
)
SUMMED_SHARDS, PENDING_SETTINGS = "summed_identity_shards", "pending_settings"
STATE_TABLES = [IDENTITY_DAYS, PROPERTIES, PROPERTY_USERS]
PROPERTY_LOG = "log_user_properties"


def identity_days(
    store: TableStore, events: DataFrame, path: str, start: str, end: str, days: int = S.LOOKBACK_DAYS
) -> DataFrame:
    """Newest ids by shard of the look-back range; only new and changed shards are scanned."""
    first = shift_day(start, -days)
    marks = shards.marks(store.spark, path, first, end)
    note = store.noted(SUMMED_SHARDS) if store.exists(IDENTITY_DAYS) else None
    known = note["marks"] if note and note["path"] == path else {}
    stale = [shard for shard, mark in marks.items() if known.get(shard) != mark]
    gone = [shard for shard in known if first <= shard <= end and shard not in marks]
    if stale or gone or note is None:
        kept = {shard: mark for shard, mark in known.items() if shard not in {*stale, *gone}}
        sums = I.identity_days(events.where(F.col("shard").isin(stale)))
        if not known:
            store.note(SUMMED_SHARDS, None)
            store.replace(IDENTITY_DAYS, sums, ["event_date"], USER, spread=True)
        else:
            store.note(SUMMED_SHARDS, {"path": path, "marks": kept})
            changed = [parse_day(shard) for shard in [*stale, *gone]]
            store.overwrite_days(IDENTITY_DAYS, sums, changed, USER, spread=True)
        summed = kept | {shard: marks[shard] for shard in stale}
        store.note(SUMMED_SHARDS, {"path": path, "marks": summed})
    inside = F.col("event_date").between(F.lit(parse_day(first)), F.lit(parse_day(end)))
    return store.read(IDENTITY_DAYS).where(inside)


def _merge(store: TableStore, settings: DataFrame, old: DataFrame, users: DataFrame) -> DataFrame:
    keys = ["property_key", "user_pseudo_id"]
    found, side = I.property_users(settings), prefixed(users, keys)
    fresh = cut_lineage(found.join(side, null_safe(found, side, keys), "left_anti"))
    state = cut_lineage(I.merged_properties(old, I.property_sums(settings), fresh))
    store.append(PROPERTY_USERS, fresh, dict(fresh.dtypes))
    return state


def append_settings(store: TableStore, settings: DataFrame) -> DataFrame:
    """Append new settings to the property log and return the summary of the whole log."""
    settings = cut_lineage(settings)
    whole = store.noted(PENDING_SETTINGS) is not None
    whole = whole or not (store.exists(PROPERTIES) and store.exists(PROPERTY_USERS))
    store.note(PENDING_SETTINGS, [])
    store.append(PROPERTY_LOG, settings, S.USER_PROPERTY_LOG, ["set_date"])
    if whole:
        store.clear(PROPERTY_USERS)
        log = store.read(PROPERTY_LOG)
        none = empty(store.spark, {"property_key": "string", "user_pseudo_id": "string"})
        state = _merge(store, log, empty(store.spark, S.PROPERTY_STATE), none)
    else:
        state = _merge(store, settings, store.read(PROPERTIES), store.read(PROPERTY_USERS))
    store.replace(PROPERTIES, state)
    store.note(PENDING_SETTINGS, None)
    return I.summary_of(store.read(PROPERTIES))
