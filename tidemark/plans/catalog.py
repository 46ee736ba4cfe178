"""Registered queries: each operator over whole driver tables, with its SQL twin."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions import ids
from tidemark.functions.params import extract_param, session_id
from tidemark.operators import columns as C
from tidemark.operators import events as E
from tidemark.operators import evolve as V
from tidemark.operators import identity as I
from tidemark.operators import items as N
from tidemark.operators import micro as M
from tidemark.operators import registry as R
from tidemark.operators import upsert as U
from tidemark.operators.skew import (
    DETECT,
    cut_lineage,
    files_go_after_query,
    hot_groups,
    shared_folder,
    work_folder,
    working_in,
)
from tidemark.plans import control as G
from tidemark.plans import incremental as D
from tidemark.plans import state
from tidemark.plans.batch import BatchConfig, current_metrics, run_batch, snapshot_run
from tidemark.plans.store import TableStore, days_between
from tidemark.sources import adapter as A
from tidemark.sources import shards
from tidemark.sources.shards import empty

TZ = "Asia/Tokyo"
MERGED_NAMES = {"view": "page_view", "purchase": "page_view"}

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its own name, with its SQL twin."""

    def add(function):
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def epoch() -> Column:
    return F.timestamp_micros(F.lit(0))


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


# -- shared SQL over the flat tables -------------------------------------------------------

EV = """
k0 AS (
  SELECT event_id, ts, user_id, event_type AS kind, value, epoch_us(ts) AS micros,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events
),
ev AS (
  SELECT *, 'u' || user_id AS u, strftime(ts, '%Y%m%d') AS shard,
    CASE WHEN k % 50 <> 49
      THEN date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) END AS s,
    CASE kind WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'scroll'
      WHEN 'signup' THEN 'session_start' ELSE kind END AS name,
    CASE WHEN kind = 'view' THEN 'page_view' ELSE kind END AS plain_name,
    CASE k % 3 WHEN 0 THEN 'www.a.test' WHEN 1 THEN 'A.test' ELSE 'b.test' END AS hostname,
    CASE k % 3 WHEN 2 THEN 'b.test' ELSE 'a.test' END AS host
  FROM k0
)
"""

IDENTITY = """
idm AS (
  SELECT u, max('m' || user_id) AS mapped_id FROM ev WHERE kind = 'signup' GROUP BY u
)
"""

PAGED = """
paged AS (
  SELECT *, u || '_' || s || '_' || greatest(page_number, 1) AS pv, u || '_' || s AS ps
  FROM (
    SELECT *, count(*) FILTER (WHERE name = 'page_view') OVER (
      PARTITION BY u, s ORDER BY micros
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page_number
    FROM ev)
)
"""

PARAM_ROWS = """
typed AS (
  SELECT DISTINCT {name} AS event_name, unnest(['k', 'value', 'rank', 'page_location'])
      AS param_name, kind FROM ev
  UNION
  SELECT DISTINCT {name}, 'percent_scrolled', kind FROM ev WHERE kind = 'click'
  UNION
  SELECT DISTINCT {name}, unnest(['clarity_project_id', 'clarity_user_id',
      'clarity_session_id']), kind FROM ev WHERE kind = 'signup'
),
raw AS (
  SELECT event_name, param_name,
    CASE param_name WHEN 'k' THEN 'INT64' WHEN 'value' THEN 'FLOAT64'
      WHEN 'percent_scrolled' THEN 'FLOAT64'
      WHEN 'rank' THEN CASE WHEN kind IN ('view', 'click') THEN 'INT64'
        WHEN kind = 'purchase' THEN 'FLOAT64' ELSE 'STRING' END
      ELSE 'STRING' END AS data_type
  FROM typed
),
observed AS (SELECT DISTINCT * FROM raw)
"""


def with_ev(*parts: str) -> str:
    return "WITH " + ",".join([EV, *parts])


RAW_RICH = PARAM_ROWS.format(name="name")
RAW_MERGED = PARAM_ROWS.format(
    name="CASE WHEN kind IN ('view', 'purchase') THEN 'page_view' ELSE kind END"
)
RAW_PLAIN = PARAM_ROWS.format(name="plain_name")
WIDEST = (
    "CASE WHEN count(*) FILTER (WHERE data_type = 'STRING') > 0 THEN 'STRING' "
    "WHEN count(*) FILTER (WHERE data_type = 'FLOAT64') > 0 THEN 'FLOAT64' ELSE 'INT64' END"
)


# The twins name the categories of the data's own names, apart from the library's lists.
EVENT_CATEGORY = """CASE WHEN event_name = 'session_start' THEN 'auto'
    WHEN event_name IN ('page_view', 'scroll', 'click') THEN 'enhanced'
    WHEN event_name IN ('purchase', 'search') THEN 'recommended' ELSE 'custom' END"""
PARAM_CATEGORY = """CASE WHEN param_name = 'page_location' THEN 'auto'
    WHEN param_name IN ('percent_scrolled', 'search_term') THEN 'enhanced'
    WHEN param_name = 'value' THEN 'recommended'
    WHEN param_name LIKE 'clarity%' THEN 'martech' ELSE 'custom' END"""
REPLAY = "https://clarity.microsoft.com/player/prj/"


REGISTRY = f"""
unified AS (
  SELECT event_name, param_name, {WIDEST} AS data_type FROM observed GROUP BY ALL
  UNION
  SELECT 'search', 'search_term', 'STRING'
),
classified AS (
  SELECT *, {EVENT_CATEGORY} AS event_category,
    {PARAM_CATEGORY} AS param_category
  FROM unified
),
registry AS (
  SELECT *, CASE WHEN param_name = 'value'
      OR (param_category = 'custom' AND event_category = 'custom')
    THEN param_name || '__' || event_name ELSE param_name END AS micro_column_name
  FROM classified
)
"""

# -- shared frames -------------------------------------------------------------------------


def whole(rows: DataFrame) -> tuple[str, str]:
    """All days of a sharded frame; the last local day may end one shard later."""
    first, last = rows.agg(F.min("shard"), F.max("shard")).first()
    return (first, ids.shift_day(last, 1)) if first else ("19700101", "19700101")


def rich(spark: SparkSession, sf: str) -> DataFrame:
    return A.web_events(spark, sf, A.RICH_NAMES)


def identity(events: DataFrame) -> DataFrame:
    return I.identity_map(events, *whole(events), TZ, epoch(), days=0)


def hot_users(events: DataFrame):
    """Hot users of the raw events: one narrow count shared by all steps of a query."""
    return hot_groups(events.select("user_pseudo_id"), E.USER)


def flat(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the columns of the numbering operators."""
    events = rich(spark, sf)
    return events.select(
        "source_id",
        "user_pseudo_id",
        session_id(F.col("event_params")).alias("ga_session_id"),
        F.col("event_timestamp").alias("event_timestamp_micros"),
        "event_name",
        ids.hostname_norm(F.col("device.web_info.hostname")).alias("hostname_norm"),
    )


def based(spark: SparkSession, sf: str, hot=DETECT) -> DataFrame:
    events = rich(spark, sf)
    hot = hot_users(events) if hot is DETECT else hot
    return E.base_events(events, identity(events), *whole(events), TZ, hot=hot)


def registered(spark: SparkSession, sf: str, names: dict[str, str] = A.RICH_NAMES) -> DataFrame:
    raw = cut_lineage(R.observe_params(A.web_events(spark, sf, names)))
    return R.build_registry(raw, empty(spark, S.EVENT_PARAM_REGISTRY), epoch())


def tables(spark: SparkSession, sf: str) -> tuple:
    """Event tables, their columns and the hot users."""
    hot = hot_users(rich(spark, sf))
    plan = C.column_plan(registered(spark, sf))
    return E.flatten_events(based(spark, sf, hot), plan, TZ, "run"), plan, hot


# -- page views, numbering, hosts, duplicates, time ----------------------------------------


@query(with_ev(PAGED) + """
SELECT event_id, page_number, ps AS pseudonymous_session_id, pv AS page_view_id FROM paged
""")
def page_view_id(spark, sf):
    rows = based(spark, sf)
    user, session = F.col("user_pseudo_id"), F.col("ga_session_id")
    return rows.select(
        F.col("source_id").alias("event_id"),
        "page_number",
        ids.pseudonymous_session_id(user, session).alias("pseudonymous_session_id"),
        ids.page_view_id(user, session, F.col("page_number")).alias("page_view_id"),
    )


NUMBERED = """
numbered AS (
  SELECT *, row_number() OVER w AS session_event_no,
    row_number() OVER (PARTITION BY u ORDER BY micros, name, s) AS user_event_no,
    lag(name) OVER w AS prev_event_name,
    CAST(round((micros - lag(micros) OVER w) / 1000000.0) AS BIGINT) AS seconds_from_prev_event,
    lag(host) OVER w AS prev_host, lead(host) OVER w AS next_host,
    sha256(u || '|' || micros || '|' || name || '|' || coalesce(s, -1)) AS event_hash
  FROM ev WINDOW w AS (PARTITION BY u, s ORDER BY micros, name)
)
"""


@query(with_ev(NUMBERED) + """
SELECT event_id AS source_id, event_hash AS event_id, session_event_no, user_event_no,
  prev_event_name, seconds_from_prev_event FROM numbered
""")
def event_sequence(spark, sf):
    rows = flat(spark, sf)
    return M.sequence(M.with_event_id(rows), hot_users(rows)).select(
        "source_id",
        "event_id",
        "session_event_no",
        "user_event_no",
        "prev_event_name",
        "seconds_from_prev_event",
    )


@query(with_ev(NUMBERED) + """
SELECT event_id AS source_id, host AS hostname_norm, prev_host AS prev_hostname_norm,
  next_host AS next_hostname_norm,
  prev_host IS NOT NULL AND prev_host <> host AS is_cross_domain_hop FROM numbered
""")
def domain_hops(spark, sf):
    rows = flat(spark, sf)
    return M.sequence(rows, hot_users(rows)).select(
        "source_id", "hostname_norm", "prev_hostname_norm", "next_hostname_norm",
        "is_cross_domain_hop",
    )


@query(with_ev("""
twice AS (
  SELECT u, micros, name, s, 'p1' AS page_view_id FROM ev
  UNION ALL SELECT u, micros, name, s, 'p2' FROM ev
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY u, micros, name, coalesce(s, -1) ORDER BY page_view_id) AS rn FROM twice
)
""") + """
SELECT u AS user_pseudo_id, micros AS event_timestamp_micros, name AS event_name,
  s AS ga_session_id, page_view_id FROM ranked WHERE rn = 1
""")
def dedup_events(spark, sf):
    rows = flat(spark, sf).drop("source_id", "hostname_norm")
    copies = rows.withColumn(
        "page_view_id", F.explode(F.array(F.lit("p1"), F.lit("p2")))
    )
    return M.dedup_events(copies)


@query(with_ev() + """
SELECT event_id, epoch_us(ts + INTERVAL 9 HOUR) AS local_micros,
  CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS local_date,
  ts + INTERVAL 9 HOUR >= TIMESTAMP '2024-01-02 00:00:00'
    AND ts + INTERVAL 9 HOUR <= TIMESTAMP '2024-01-20 23:59:59' AS inside
FROM ev
""")
def local_window(spark, sf):
    at = F.col("event_timestamp")
    local = ids.local_timestamp(at, TZ)
    return rich(spark, sf).select(
        F.col("source_id").alias("event_id"),
        F.unix_micros(local.cast("timestamp")).alias("local_micros"),
        local.cast("date").cast("string").alias("local_date"),
        ids.in_local_window(at, "20240102", "20240120", TZ).alias("inside"),
    )


@query(with_ev() + "SELECT shard, count(*) AS row_count FROM ev GROUP BY shard")
def shard_counts(spark, sf):
    events = rich(spark, sf)
    return shards.shard_counts(shards.in_shards(events, *whole(events)))


# -- registry ------------------------------------------------------------------------------


@query(with_ev(RAW_MERGED) + "SELECT * FROM observed")
def observe_params(spark, sf):
    return R.observe_params(A.web_events(spark, sf, MERGED_NAMES))


@query(with_ev(RAW_MERGED) + f"""
SELECT event_name, param_name, {WIDEST} AS data_type FROM observed GROUP BY ALL
""")
def unify_types(spark, sf):
    return R.unify_types(observe_params(spark, sf), ["event_name", "param_name"])


RANKED_TYPE = "CASE {} WHEN 'STRING' THEN 2 WHEN 'FLOAT64' THEN 1 ELSE 0 END"


@query(
    with_ev(
        RAW_PLAIN.replace("typed", "typed_p").replace("raw AS", "raw_p AS").replace(
            "FROM raw)", "FROM raw_p)"
        ).replace("observed AS", "observed_p AS"),
        RAW_RICH,
        f"""
old_reg AS (
  SELECT event_name, param_name,
    CASE WHEN param_name = 'k' THEN 'FLOAT64' ELSE data_type END AS data_type,
    'old' AS micro_column_name, 1 AS stamp
  FROM (SELECT event_name, param_name, {WIDEST} AS data_type FROM observed_p GROUP BY ALL)
),
new_reg AS (
  SELECT event_name, param_name, {WIDEST} AS data_type, param_name AS micro_column_name, 2 AS stamp
  FROM observed GROUP BY event_name, param_name
)
""",
    )
    + f"""
SELECT event_name, param_name,
  CASE greatest({RANKED_TYPE.format("o.data_type")}, {RANKED_TYPE.format("n.data_type")})
    WHEN 2 THEN 'STRING' WHEN 1 THEN 'FLOAT64' ELSE 'INT64' END AS data_type,
  coalesce(n.micro_column_name, o.micro_column_name) AS micro_column_name,
  coalesce(n.stamp, o.stamp) AS stamp
FROM old_reg o FULL OUTER JOIN new_reg n USING (event_name, param_name)
""")
def upsert_registry(spark, sf):
    keys = ["event_name", "param_name"]
    old = R.unify_types(R.observe_params(A.web_events(spark, sf)), keys).select(
        *keys,
        F.when(F.col("param_name") == "k", S.FLOAT64).otherwise(F.col("data_type")).alias("data_type"),
        F.lit("old").alias("micro_column_name"),
        F.lit(1).alias("stamp"),
    )
    new = R.unify_types(R.observe_params(rich(spark, sf)), keys).select(
        *keys, "data_type", F.col("param_name").alias("micro_column_name"), F.lit(2).alias("stamp")
    )
    return R.upsert_registry(old, new)


@query(with_ev(RAW_RICH, REGISTRY) + """
SELECT event_name, param_name, data_type, event_category, param_category, micro_column_name
FROM registry
""")
def classify_name(spark, sf):
    return registered(spark, sf).drop("created_at")


@query(with_ev(RAW_MERGED, REGISTRY) + """
SELECT o.event_name, o.param_name, count(*) AS duplicate_count,
  string_agg(o.data_type, ',' ORDER BY o.data_type) AS types_found, r.data_type AS resolved_type
FROM observed o JOIN registry r USING (event_name, param_name)
GROUP BY o.event_name, o.param_name, r.data_type HAVING count(*) > 1
""")
def duplicate_params(spark, sf):
    return R.duplicate_params(observe_params(spark, sf), registered(spark, sf, MERGED_NAMES))


@query(with_ev(RAW_RICH) + f"""
SELECT param_name AS column_name, 'TYPE_UNIFIED' AS status, 'values of several types; the widest type of text, float, integer counts' AS reason,
  string_agg(DISTINCT data_type, ',' ORDER BY data_type) AS original_data_types,
  string_agg(DISTINCT event_name, ',' ORDER BY event_name) AS events_involved
FROM observed GROUP BY param_name HAVING count(DISTINCT data_type) > 1
""")
def type_audit(spark, sf):
    return R.type_audit(R.observe_params(rich(spark, sf)))


@query(with_ev() + """
SELECT event_id,
  CASE WHEN kind IN ('view', 'click') THEN CAST(k AS VARCHAR)
    WHEN kind = 'purchase' THEN CAST(value AS VARCHAR) ELSE 'r' || k END AS rank_text,
  CASE WHEN kind IN ('view', 'click') THEN CAST(k AS DOUBLE)
    WHEN kind = 'purchase' THEN value END AS rank_number,
  CAST(round(value) AS BIGINT) AS value_integer,
  CASE WHEN kind = 'click' THEN CAST(k AS DOUBLE) / 100 END AS percent_scrolled
FROM ev
""")
def extract_typed(spark, sf):
    params = F.col("event_params")
    return rich(spark, sf).select(
        F.col("source_id").alias("event_id"),
        extract_param(params, "rank", S.STRING).alias("rank_text"),
        extract_param(params, "rank", S.FLOAT64).alias("rank_number"),
        extract_param(params, "value", S.INT64).alias("value_integer"),
        extract_param(params, "percent_scrolled", S.FLOAT64).alias("percent_scrolled"),
    )


@query(with_ev(RAW_RICH, REGISTRY) + """
, typed2 AS (
  SELECT param_name, CASE WHEN count(DISTINCT t) > 1 THEN 'STRING' ELSE max(t) END AS unified_type
  FROM (SELECT param_name, CASE WHEN param_name LIKE '%percent%' THEN 'FLOAT64' ELSE data_type END
    AS t FROM registry) GROUP BY param_name
)
SELECT param_name, micro_column_name, event_name,
  CASE WHEN param_name = 'value' OR (param_category = 'custom' AND event_category = 'custom')
    THEN 'unique' ELSE 'common' END AS ptype, unified_type,
  (SELECT count(DISTINCT event_name) FROM registry o WHERE o.param_name = registry.param_name)
    AS event_count
FROM registry JOIN typed2 USING (param_name) WHERE param_name NOT LIKE 'clarity%'
""")
def param_class(spark, sf):
    return C.param_class(registered(spark, sf)).where("ptype IN ('unique', 'common')").drop("data_type")


# -- schema evolution ----------------------------------------------------------------------

CURRENT_COLUMNS = """
current_columns AS (
  SELECT DISTINCT CASE kind WHEN 'view' THEN 'rank' WHEN 'click' THEN 'percent_scrolled'
      WHEN 'purchase' THEN 'value__purchase' WHEN 'signup' THEN 'k' ELSE 'rank__error' END
      AS micro_column_name,
    CASE kind WHEN 'view' THEN 'INT64' WHEN 'click' THEN 'STRING'
      WHEN 'purchase' THEN 'INT64' WHEN 'signup' THEN 'FLOAT64' ELSE 'STRING' END AS tbl_type
  FROM ev
)
"""


def current_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A table schema as rows, derived from the event kinds present."""
    kind = F.col("event_name")
    name = (
        F.when(kind == "page_view", "rank").when(kind == "click", "percent_scrolled")
        .when(kind == "purchase", "value__purchase").when(kind == "signup", "k")
        .otherwise("rank__error")
    )
    kind_type = (
        F.when(kind.isin("page_view", "purchase"), S.INT64).when(kind == "signup", S.FLOAT64)
        .otherwise(S.STRING)
    )
    return A.web_events(spark, sf).select(
        name.alias("micro_column_name"), kind_type.alias("tbl_type")
    ).distinct()


@query(with_ev(RAW_RICH, REGISTRY, CURRENT_COLUMNS) + f"""
SELECT micro_column_name, {WIDEST} AS data_type FROM registry
WHERE param_name NOT LIKE 'clarity%'
  AND micro_column_name NOT IN (SELECT micro_column_name FROM current_columns)
GROUP BY micro_column_name
""")
def evolve_schema(spark, sf):
    registry = V.visible_params(registered(spark, sf))
    return V.evolve_schema(current_columns(spark, sf), registry)


RECONCILED = f"""
diff AS (
  SELECT micro_column_name, mst_type, tbl_type,
    CASE greatest({RANKED_TYPE.format("mst_type")}, {RANKED_TYPE.format("tbl_type")})
      WHEN 2 THEN 'STRING' WHEN 1 THEN 'FLOAT64' ELSE 'INT64' END AS unified_type
  FROM (SELECT micro_column_name, {WIDEST} AS mst_type FROM registry GROUP BY ALL)
  JOIN current_columns USING (micro_column_name) WHERE mst_type <> tbl_type
)
"""


@query(with_ev(RAW_RICH, REGISTRY, CURRENT_COLUMNS, RECONCILED) + """
SELECT *, CASE WHEN unified_type = tbl_type THEN 'sticky'
  WHEN unified_type = 'FLOAT64' THEN 'widen' ELSE 'rebuild' END AS action FROM diff
""")
def reconcile_types(spark, sf):
    return V.reconcile_types(current_columns(spark, sf), registered(spark, sf))


@query(with_ev(RAW_RICH, REGISTRY, CURRENT_COLUMNS, RECONCILED) + """
SELECT event_name, param_name, CASE WHEN d.unified_type = d.tbl_type THEN d.tbl_type
  ELSE r.data_type END AS data_type
FROM registry r LEFT JOIN diff d USING (micro_column_name)
""")
def sticky_types(spark, sf):
    registry = registered(spark, sf)
    diff = V.reconcile_types(current_columns(spark, sf), registry)
    return V.apply_sticky(registry, diff).select("event_name", "param_name", "data_type")


# -- identity and users --------------------------------------------------------------------


@query(with_ev() + """
SELECT u AS user_pseudo_id, max('m' || user_id) AS user_id,
  CAST(CAST(max(ts) + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS first_touch_date
FROM ev WHERE kind = 'signup' GROUP BY u
""")
def identity_map(spark, sf):
    return identity(rich(spark, sf)).select("user_pseudo_id", "user_id", text("first_touch_date"))


@query(with_ev() + """
SELECT u AS user_pseudo_id, max('m' || user_id) AS user_id,
  CAST(CAST(max(ts) + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS first_touch_date
FROM ev WHERE kind = 'signup' AND shard BETWEEN '20240113' AND '20240119' GROUP BY u
""")
def identity_look_back(spark, sf):
    """A look-back of seven days over the sums of shards; the second day scans its own shards only."""
    events = rich(spark, sf).select("shard", "event_timestamp", "user_pseudo_id", "user_id")
    with scratch_store(spark) as store:
        path = f"{store.root}/source"
        events.repartition("shard").write.partitionBy("shard").parquet(path)
        stored = shards.read_sharded(spark, path, dict(events.dtypes))
        state.identity_days(store, stored, path, "20240115", "20240115", days=6)
        days = state.identity_days(store, stored, path, "20240119", "20240119", days=6)
        known = I.identity_of(days, TZ, epoch())
        return settled(known.select("user_pseudo_id", "user_id", text("first_touch_date")))


SNAPSHOTS = """
WITH cust AS (
  SELECT c.*, n_name, 1700000000000000 + c_custkey * 1000000 AS base
  FROM customer c JOIN nation ON c_nationkey = n_nationkey
),
evm AS (
  SELECT 'u' || user_id AS u, max('m' || user_id) AS mapped_id FROM events
  WHERE event_type = 'signup' GROUP BY ALL
),
slots AS (
  SELECT 'slot1' AS slot_key, 'market seg' AS user_property_name, max(base) + 1 AS micros FROM cust
  UNION ALL SELECT 'slot2', 'balance', max(base) + 1 FROM cust
),
attributes AS (
  SELECT 'u' || c_custkey AS user_pseudo_id,
    coalesce(mapped_id, CASE WHEN c_custkey % 3 = 0 THEN 'c' || c_custkey END) AS user_id,
    base + 6 AS last_active_micros, base - 4 AS first_touch_micros, n_name AS country,
    CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS balance, c_mktsegment AS market_seg
  FROM cust LEFT JOIN evm ON 'u' || c_custkey = u
)
"""


def snapshots(spark, sf):
    return A.customer_snapshots(spark, sf)


def slot_definitions(spark, sf):
    users = snapshots(spark, sf)
    return I.slot_registry(users, *whole(users), TZ, epoch(), days=0)


def attributes(spark, sf):
    slots, _ = I.slot_columns(slot_definitions(spark, sf), set(S.MICRO_USER_FIXED))
    known = identity(A.web_events(spark, sf))
    users = snapshots(spark, sf)
    frame = I.user_attributes(users, known, slots, *whole(users), TZ, epoch(), days=0)
    return frame, [s.column for s in slots]


@query(SNAPSHOTS + """
SELECT slot_key, user_property_name, micros AS last_set_micros,
  '2024-01-30' AS source_table_date FROM slots
""")
def slot_registry(spark, sf):
    return slot_definitions(spark, sf).select(
        "slot_key", "user_property_name", micros("last_set_timestamp").alias("last_set_micros"),
        text("source_table_date"),
    )


@query(SNAPSHOTS + "SELECT * FROM attributes")
def user_attributes(spark, sf):
    frame, slots = attributes(spark, sf)
    return frame.select(
        "user_pseudo_id", "user_id",
        micros("last_active_timestamp").alias("last_active_micros"),
        micros("first_touch_timestamp").alias("first_touch_micros"),
        "country", *slots,
    )


@query(SNAPSHOTS + """
, memberships AS (
  SELECT d AS shard, 'u' || c_custkey AS user_pseudo_id, c_custkey,
    unnest([c_custkey % 5, 7]) AS aid,
    unnest([1700000000000000 + c_custkey,
      1700000000000000 + c_custkey + CASE d WHEN '20240129' THEN 0 ELSE 1 END]) AS start_micros
  FROM cust, (VALUES ('20240129'), ('20240130')) days(d)
),
old AS (SELECT DISTINCT user_pseudo_id, aid, start_micros FROM memberships WHERE shard = '20240129')
SELECT DISTINCT m.user_pseudo_id, mapped_id AS user_id, CAST(aid AS VARCHAR) AS audience_id,
  'aud' || aid AS audience_name, start_micros, start_micros + 1000000 AS expiry_micros,
  c_custkey % 2 = 0 AS npa, m.user_pseudo_id || '_20240130' AS pseudonymous_session_id
FROM memberships m LEFT JOIN evm ON u = m.user_pseudo_id
WHERE shard = '20240130' AND NOT EXISTS (SELECT 1 FROM old WHERE
  old.user_pseudo_id = m.user_pseudo_id AND old.aid = m.aid AND old.start_micros = m.start_micros)
""")
def audience_log(spark, sf):
    users, known = snapshots(spark, sf), identity(A.web_events(spark, sf))
    nothing = empty(spark, S.AUDIENCE_LOG)
    first_day = I.audience_log(users, known, nothing, "20240129", "20240129", epoch(), days=0)
    fresh = I.audience_log(users, known, first_day, *whole(users), epoch(), days=0)
    return fresh.select(
        "user_pseudo_id", "user_id", "audience_id", "audience_name",
        micros("membership_start_timestamp").alias("start_micros"),
        micros("membership_expiry_timestamp").alias("expiry_micros"),
        "npa", "pseudonymous_session_id",
    )


PROPERTIES = """
settings AS (
  SELECT u, micros, name, s, shard, event_id, 'plan' AS property_key, 't' || (k % 3) AS text_value,
    NULL AS int_value, epoch_us(date_trunc('day', ts)) AS set_micros FROM ev
  UNION ALL
  SELECT u, micros, name, s, shard, event_id, 'visits', NULL, k, micros FROM ev
  WHERE kind = 'purchase'
),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY u, property_key, set_micros
    ORDER BY micros DESC, name, s NULLS FIRST, text_value NULLS FIRST, int_value NULLS FIRST) AS rn
  FROM settings
),
prop_log AS (
  SELECT l.*, mapped_id FROM latest l LEFT JOIN idm USING (u) WHERE rn = 1
)
"""


@query(with_ev(IDENTITY, PROPERTIES) + """
SELECT u AS user_pseudo_id, mapped_id AS user_id, property_key, text_value AS property_value_string,
  int_value AS property_value_int, set_micros,
  CAST(CAST(make_timestamp(set_micros) + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS set_date,
  micros + 9 * 3600000000 AS local_micros, name AS event_name, s AS ga_session_id,
  u || '_' || s AS pseudonymous_session_id
FROM prop_log WHERE NOT EXISTS (
  SELECT 1 FROM latest o WHERE o.rn = 1 AND o.shard <= '20240110' AND o.u = prop_log.u
    AND o.property_key = prop_log.property_key AND o.set_micros = prop_log.set_micros)
""")
def user_property_log(spark, sf):
    events = rich(spark, sf)
    known = identity(events)
    nothing = empty(spark, S.USER_PROPERTY_LOG)
    hot = hot_groups(events, E.USER, F.size("user_properties"))
    early = I.user_property_log(
        events, known, nothing, "20240101", "20240110", TZ, epoch(), hot
    )
    fresh = I.user_property_log(events, known, early, *whole(events), TZ, epoch(), hot)
    return fresh.select(
        "user_pseudo_id", "user_id", "property_key", "property_value_string", "property_value_int",
        micros("set_timestamp").alias("set_micros"), text("set_date"),
        micros("event_timestamp").alias("local_micros"), "event_name", "ga_session_id",
        "pseudonymous_session_id",
    )


@query(with_ev(IDENTITY, PROPERTIES) + """
SELECT property_key, CASE WHEN count(text_value) > 0 THEN 'STRING' ELSE 'INT64' END AS resolved_type,
  count(DISTINCT u) AS unique_users, count(*) AS total_records, min(set_micros) AS first_seen,
  max(set_micros) AS last_seen FROM prop_log GROUP BY property_key
""")
def property_summary(spark, sf):
    events = rich(spark, sf)
    nothing = empty(spark, S.USER_PROPERTY_LOG)
    log = I.user_property_log(
        events, identity(events), nothing, *whole(events), TZ, epoch(),
        hot_groups(events, E.USER, F.size("user_properties")),
    )
    return I.property_summary(log).withColumns(
        {"first_seen": micros("first_seen"), "last_seen": micros("last_seen")}
    )


@query(SQL["property_summary"])
def property_state(spark, sf):
    """The property summary after two runs, of which the second adds its own settings only."""
    events = rich(spark, sf)
    known = identity(events)
    hot = hot_groups(events, E.USER, F.size("user_properties"))
    with scratch_store(spark) as store:
        for start, end in (("20240101", "20240110"), whole(events)):
            log = store.read(state.PROPERTY_LOG, S.USER_PROPERTY_LOG)
            fresh = I.user_property_log(events, known, log, start, end, TZ, epoch(), hot)
            summary = state.append_settings(store, fresh)
        return settled(summary.withColumns(
            {"first_seen": micros("first_seen"), "last_seen": micros("last_seen")}
        ))


# -- event tables --------------------------------------------------------------------------


@query(with_ev(IDENTITY) + """
SELECT event_id, micros AS event_timestamp_micros,
  CASE WHEN k % 2 = 0 THEN 'desktop' ELSE 'mobile' END AS device_category,
  CASE WHEN k % 4 <> 0 THEN 'web' ELSE 'app' END AS browser, 'en' AS device_language,
  hostname, host AS hostname_norm, 'JP' AS country, 'src' AS traffic_source,
  'med' AS traffic_medium, 'csrc' AS collected_source, 'Yes' AS analytics_storage,
  'WEB' AS platform, CASE WHEN k % 7 = 0 THEN 'g' END AS gclid,
  CASE WHEN name = 'purchase' THEN 1 ELSE 0 END AS is_key_event
FROM ev
""")
def standard_columns(spark, sf):
    rows = rich(spark, sf).select("source_id", *E.standard_columns())
    return rows.select(
        F.col("source_id").alias("event_id"), "event_timestamp_micros", "device_category",
        "browser", "device_language", "hostname", "hostname_norm", "country", "traffic_source",
        "traffic_medium", "collected_source", "analytics_storage", "platform", "gclid",
        "is_key_event",
    )


@query(with_ev(IDENTITY, PAGED) + f"""
SELECT event_id, mapped_id AS user_id, mapped_id IS NOT NULL AS is_identified_user,
  CASE WHEN name = 'session_start' AND k % 5 <> 0
    THEN '{REPLAY}' || user_id || '/s' || k END AS clarity_play_url
FROM paged LEFT JOIN idm USING (u)
""")
def replay_url(spark, sf):
    rows = based(spark, sf).select("source_id", *E.event_head(TZ))
    return rows.select(
        F.col("source_id").alias("event_id"), "user_id", "is_identified_user", "clarity_play_url"
    )


@query(with_ev(IDENTITY, PAGED) + """
SELECT u AS user_pseudo_id, s AS ga_session_id, pv AS page_view_id, micros AS event_timestamp_micros,
  CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS event_date, host AS hostname_norm, k,
  k AS rank, value, '/p/' || (k % 10) AS page_location
FROM paged WHERE name = 'page_view'
""")
def event_table(spark, sf):
    rows, plan, _ = tables(spark, sf)
    return E.event_table(rows, plan, "page_view").select(
        "user_pseudo_id", "ga_session_id", "page_view_id", "event_timestamp_micros",
        text("event_date"), "hostname_norm", "k", "rank", "value", "page_location",
    )


# -- event-level table ---------------------------------------------------------------------


@query(with_ev() + """
SELECT DISTINCT u AS user_pseudo_id, s AS ga_session_id FROM ev WHERE name = 'purchase'
""")
def key_sessions(spark, sf):
    return M.key_sessions(flat(spark, sf))


ASSEMBLED = f"""
keyed AS (SELECT DISTINCT u, s FROM ev WHERE name = 'purchase'),
urls AS (
  SELECT u, s, max('{REPLAY}' || user_id || '/s' || k) AS url FROM ev
  WHERE name = 'session_start' AND k % 5 <> 0 GROUP BY u, s
),
depth AS (
  SELECT pv, max(CAST(round(k / 100.0) AS BIGINT)) AS depth FROM paged
  WHERE name = 'scroll' AND pv IS NOT NULL GROUP BY pv
),
assembled AS (
  SELECT p.*, CASE WHEN keyed.s IS NOT NULL THEN 1 ELSE 0 END AS is_key,
    CASE WHEN name = 'session_start' THEN
      CASE WHEN k % 5 <> 0 THEN '{REPLAY}' || user_id || '/s' || k END
      ELSE url END AS play_url,
    CASE WHEN name = 'page_view' THEN depth END AS max_scroll
  FROM paged p LEFT JOIN keyed ON p.u = keyed.u AND p.s = keyed.s
    LEFT JOIN urls ON p.u = urls.u AND p.s = urls.s LEFT JOIN depth ON p.pv = depth.pv
  WHERE name <> 'scroll'
)
"""


@query(with_ev(PAGED, ASSEMBLED) + """
SELECT u AS user_pseudo_id, s AS ga_session_id, micros AS event_timestamp_micros,
  name AS event_name, pv AS page_view_id, is_key AS is_key_event, play_url AS clarity_play_url
FROM assembled
""")
def assemble_events(spark, sf):
    rows, _, hot = tables(spark, sf)
    return M.assemble_events(rows, hot).select(
        "user_pseudo_id", "ga_session_id", "event_timestamp_micros", "event_name", "page_view_id",
        "is_key_event", "clarity_play_url",
    )


@query(with_ev(PAGED, ASSEMBLED) + """
SELECT pv AS page_view_id, micros AS event_timestamp_micros, max_scroll AS max_scroll_percent
FROM assembled WHERE name = 'page_view'
""")
def fold_scroll(spark, sf):
    rows, _, hot = tables(spark, sf)
    return M.assemble_events(rows, hot).where("event_name = 'page_view'").select(
        "page_view_id", "event_timestamp_micros", "max_scroll_percent"
    )


@query(SNAPSHOTS + """
SELECT event_id, 'u' || e.user_id AS user_pseudo_id, a.user_id, last_active_micros,
  first_touch_micros, balance, market_seg
FROM events e LEFT JOIN attributes a ON a.user_pseudo_id = 'u' || e.user_id
""")
def fill_slots(spark, sf):
    frame, slots = attributes(spark, sf)
    rows = flat(spark, sf).select(
        F.col("source_id").alias("event_id"), "user_pseudo_id",
        F.lit(None).cast("string").alias("user_id"),
    )
    return M.fill_slots(rows, frame, slots, hot_users(rows)).select(
        "event_id", "user_pseudo_id", "user_id",
        micros("last_active_timestamp").alias("last_active_micros"),
        micros("first_touch_timestamp").alias("first_touch_micros"), *slots,
    )


MICRO = SNAPSHOTS.replace("WITH cust", "cust") + """
, nums AS (
  SELECT *, row_number() OVER w AS sno,
    row_number() OVER (PARTITION BY u ORDER BY micros, name, s) AS uno, lag(name) OVER w AS prev_name,
    CAST(round((micros - lag(micros) OVER w) / 1000000.0) AS BIGINT) AS gap,
    lag(host) OVER w AS prev_host, lead(host) OVER w AS next_host
  FROM assembled WINDOW w AS (PARTITION BY u, s ORDER BY micros, name)
)
SELECT CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS event_date,
  micros AS event_timestamp_micros, name AS event_name, u AS user_pseudo_id,
  coalesce(idm.mapped_id, a.user_id) AS user_id, idm.mapped_id IS NOT NULL AS is_identified_user,
  s AS ga_session_id, ps AS pseudonymous_session_id, pv AS page_view_id, is_key AS is_key_event,
  sha256(u || '|' || micros || '|' || name || '|' || coalesce(s, -1)) AS event_id,
  sno AS session_event_no, uno AS user_event_no, play_url AS clarity_play_url,
  host AS hostname_norm, prev_host AS prev_hostname_norm, next_host AS next_hostname_norm,
  prev_host IS NOT NULL AND prev_host <> host AS is_cross_domain_hop,
  prev_name AS prev_event_name, gap AS seconds_from_prev_event, max_scroll AS max_scroll_percent,
  balance, market_seg, k,
  CASE WHEN name = 'error' THEN k END AS k__error, '/p/' || (k % 10) AS page_location,
  CASE WHEN name = 'page_view' THEN CAST(k AS VARCHAR) WHEN name = 'purchase'
    THEN CAST(value AS VARCHAR) ELSE 'r' || k END AS rank,
  CASE WHEN name = 'error' THEN 'r' || k END AS rank__error,
  CASE WHEN name = 'purchase' THEN value END AS value__purchase,
  last_active_micros, first_touch_micros
FROM nums LEFT JOIN idm USING (u) LEFT JOIN attributes a ON a.user_pseudo_id = u
"""


@query(with_ev(IDENTITY, PAGED, ASSEMBLED, MICRO))
def micro_user(spark, sf):
    rows, plan, hot = tables(spark, sf)
    frame, slots = attributes(spark, sf)
    built = M.micro_user(rows, frame, plan, slots, hot)
    return built.select(
        text("event_date"), "event_timestamp_micros", "event_name", "user_pseudo_id", "user_id",
        "is_identified_user", "ga_session_id", "pseudonymous_session_id", "page_view_id",
        "is_key_event", "event_id", "session_event_no", "user_event_no", "clarity_play_url",
        "hostname_norm", "prev_hostname_norm", "next_hostname_norm", "is_cross_domain_hop",
        "prev_event_name", "seconds_from_prev_event", "max_scroll_percent", *slots, "k",
        "k__error", "page_location", "rank", "rank__error", "value__purchase",
        micros("last_active_timestamp").alias("last_active_micros"),
        micros("first_touch_timestamp").alias("first_touch_micros"),
    )


@query(with_ev(RAW_RICH) + """
SELECT name AS event_name, 'rank' AS param_name, 'INT64' AS data_type, count(*) AS lost
FROM ev WHERE kind NOT IN ('view', 'click', 'purchase') GROUP BY name
""")
def lost_values(spark, sf):
    """Values lost where a parameter of mixed types is registered as an integer."""
    events = rich(spark, sf)
    narrow = F.when(F.col("param_name") == "rank", S.INT64).otherwise(F.col("data_type"))
    registry = cut_lineage(registered(spark, sf).withColumn("data_type", narrow))
    suspects = E.lossy_events(R.seen_types(events), registry)
    read = events.where(F.col("event_name").isin(suspects))
    return E.lost_values(read, C.column_plan(registry))


# -- incremental days ----------------------------------------------------------------------


@contextlib.contextmanager
def scratch_store(spark: SparkSession) -> Iterator[TableStore]:
    """A table store in the work folder; it goes when its query's result has been written."""
    folder = f"{work_folder(spark)}/tidemark-store-{uuid.uuid4().hex}"
    with working_in(spark, folder):
        yield TableStore(spark, f"{folder}/tables")


def settled(found: DataFrame) -> DataFrame:
    """Rows written beside the scratch store, which goes before the caller reads them."""
    spark = found.sparkSession
    path = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    with files_go_after_query(spark):
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def marked_days(frame: DataFrame, column: str) -> list:
    """The tenth, the 20th and the last day of a frame."""
    first, last = frame.agg(F.min(column), F.max(column)).first()
    return [first + timedelta(days=9), first + timedelta(days=19), last]


@query(with_ev(IDENTITY, PAGED, ASSEMBLED) + """
SELECT CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS event_date, u AS user_pseudo_id,
  s AS ga_session_id, micros AS event_timestamp_micros, name AS event_name, pv AS page_view_id,
  row_number() OVER w AS session_event_no,
  row_number() OVER (PARTITION BY u ORDER BY micros, name, s) AS user_event_no,
  lag(name) OVER w AS prev_event_name,
  CAST(round((micros - lag(micros) OVER w) / 1000000.0) AS BIGINT) AS seconds_from_prev_event,
  host AS hostname_norm, lag(host) OVER w AS prev_hostname_norm, lead(host) OVER w AS next_hostname_norm,
  lag(host) OVER w IS NOT NULL AND lag(host) OVER w <> host AS is_cross_domain_hop
FROM assembled WINDOW w AS (PARTITION BY u, s ORDER BY micros, name)
""")
def incremental_users(spark, sf):
    """The event-level table of 20 days but the tenth, then the later days, then the tenth."""
    rows, plan, hot = tables(spark, sf)
    frame, slots = attributes(spark, sf)
    with scratch_store(spark) as store:
        rows, frame = cut_lineage(rows), cut_lineage(frame)
        gap, until, last = marked_days(rows, "event_date")
        day = F.col("event_date")
        D.build_events(store, rows.where((day <= F.lit(until)) & (day != F.lit(gap))), frame, plan, slots)
        D.update_events(store, rows, frame, plan, slots, until + timedelta(days=1), last, hot)
        D.update_events(store, rows, frame, plan, slots, gap, gap)
        found = store.read(D.EVENTS_TABLE).select(
            text("event_date"), "user_pseudo_id", "ga_session_id", "event_timestamp_micros",
            "event_name", "page_view_id", "hostname_norm", *D.SEQUENCE_COLUMNS,
        )
        return settled(found)


# -- items ---------------------------------------------------------------------------------

ITEMS_SQL = """
lines AS (
  SELECT *, 'u' || l_suppkey AS u, epoch_us(l_shipdate) + l_linenumber AS micros,
    CASE l_returnflag WHEN 'R' THEN 'refund' WHEN 'A' THEN 'add_to_cart' ELSE 'purchase' END AS name
  FROM lineitem
),
item_rows AS (
  SELECT *, 0 AS item_index, 'i' || l_partkey AS item_id, l_extendedprice AS price,
    CAST(trunc(l_quantity) AS BIGINT) AS quantity FROM lines
  UNION ALL
  SELECT *, 1, 'gift' || (l_partkey % 10), l_discount, NULL FROM lines
)
"""


def item_frame(spark, sf, with_identity=True):
    events = A.order_events(spark, sf)
    registry = R.item_registry(
        R.observe_item_params(events), empty(spark, S.ITEM_PARAM_REGISTRY), epoch()
    )
    known = (
        identity(A.web_events(spark, sf)) if with_identity else empty(spark, S.IDENTITY_MAP)
    )
    columns = N.item_columns(registry)
    hot = hot_groups(events, E.USER, F.size("items"))
    rows = N.explode_items(
        events, known, columns, *whole(events), TZ, "run", epoch(), hot=hot
    )
    return rows, columns, hot


@query("WITH " + ITEMS_SQL + """
, evm AS (
  SELECT 'u' || user_id AS u, max('m' || user_id) AS user_id FROM events
  WHERE event_type = 'signup' GROUP BY ALL
)
SELECT micros AS event_timestamp_micros, name AS event_name, r.u AS user_pseudo_id, evm.user_id,
  l_orderkey AS ga_session_id, 't' || l_orderkey AS transaction_id, item_index, item_id, price,
  quantity, price * coalesce(quantity, 1) AS item_subtotal,
  CASE WHEN name = 'purchase' THEN 1 ELSE 0 END AS is_key_event,
  sha256(r.u || '|' || micros || '|' || name || '|' || l_orderkey) AS event_id
FROM item_rows r LEFT JOIN evm ON evm.u = r.u
""")
def explode_items(spark, sf):
    rows, _, hot = item_frame(spark, sf)
    return rows.select(
        "event_timestamp_micros", "event_name", "user_pseudo_id", "user_id", "ga_session_id",
        "transaction_id", "item_index", "item_id", "price", "quantity", "item_subtotal",
        "is_key_event", "event_id",
    )


@query("WITH " + ITEMS_SQL + """
SELECT u AS user_pseudo_id, l_orderkey AS ga_session_id, item_id, micros AS event_timestamp_micros,
  name AS event_name, item_index, row_number() OVER (PARTITION BY u, l_orderkey, item_id
    ORDER BY micros, name, item_index) AS item_event_no
FROM item_rows
""")
def number_items(spark, sf):
    rows, _, hot = item_frame(spark, sf, with_identity=False)
    slim = rows.select(
        "user_pseudo_id", "ga_session_id", "item_id", "event_timestamp_micros", "event_name",
        "item_index",
    )
    return N.number_items(slim, hot)


@query("""
SELECT 'status' AS param_name, CASE WHEN count(l_linestatus) >= 0 THEN 'STRING' END AS data_type,
  'status__items' AS micro_column_name FROM lineitem
UNION ALL SELECT 'tax', CASE WHEN count(l_tax) > 0 THEN 'FLOAT64' END, 'tax__items' FROM lineitem
UNION ALL SELECT 'line', CASE WHEN count(l_linenumber) > 0 THEN 'INT64' END, 'line__items'
  FROM lineitem
UNION ALL SELECT 'mix', CASE WHEN count(*) FILTER (WHERE l_linenumber % 2 = 1) > 0 THEN 'FLOAT64'
  ELSE 'INT64' END, 'mix__items' FROM lineitem
""")
def item_registry(spark, sf):
    raw = R.observe_item_params(A.order_events(spark, sf))
    registry = R.item_registry(raw, empty(spark, S.ITEM_PARAM_REGISTRY), epoch())
    return registry.drop("created_at")


@query(f"""
SELECT 'mix__items' AS column_name, 'TYPE_UNIFIED_ITEMS' AS status,
  'item values of several types; the widest of text, float, integer counts' AS reason,
  string_agg(DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 'INT64' ELSE 'FLOAT64' END, ','
    ORDER BY CASE WHEN l_linenumber % 2 = 0 THEN 'INT64' ELSE 'FLOAT64' END) AS original_data_types,
  'item_params(all_events)' AS events_involved
FROM lineitem HAVING count(DISTINCT l_linenumber % 2) > 1
""")
def item_type_audit(spark, sf):
    return R.item_type_audit(R.observe_item_params(A.order_events(spark, sf)))


@query("WITH " + ITEMS_SQL + """
SELECT micros AS event_timestamp_micros, u AS user_pseudo_id, l_orderkey AS ga_session_id,
  item_index, item_id, l_linenumber AS line__items,
  CASE WHEN l_linenumber % 2 = 1 THEN l_tax END AS mix__items, l_linestatus AS status__items,
  l_tax AS tax__items
FROM item_rows
""")
def item_params(spark, sf):
    rows, columns, hot = item_frame(spark, sf, with_identity=False)
    return rows.select(
        "event_timestamp_micros", "user_pseudo_id", "ga_session_id", "item_index", "item_id",
        *[c.name for c in columns],
    )


@query("WITH " + ITEMS_SQL + """
SELECT u AS user_pseudo_id, l_orderkey AS ga_session_id, item_id, micros AS event_timestamp_micros,
  name AS event_name, item_index, price, quantity, row_number() OVER (
    PARTITION BY u, l_orderkey, item_id ORDER BY micros, name, item_index) AS item_event_no
FROM item_rows
""")
def incremental_items(spark, sf):
    """The item-level table of the first days but a tenth, then the later days, then that tenth.

    The source's day is the first of its quarter here, so that seven years make 28 folders, each
    with days that stay and days that change.
    """
    rows, columns, hot = item_frame(spark, sf, with_identity=False)
    wanted = N.items_schema(columns)
    with scratch_store(spark) as store:
        quarter = F.trunc("event_date", "quarter")
        rows = rows.withColumns({"local": F.to_date("event_timestamp"), "event_date": quarter})
        first, last = rows.agg(F.min("local"), F.max("local")).first()
        cuts = [first + timedelta(days=(last - first).days * part // 10) for part in (3, 4, 7)]
        local, day = F.col("local"), timedelta(days=1)
        gap = local.between(F.lit(cuts[0]), F.lit(cuts[1]))
        plain = rows.where((local <= F.lit(cuts[2])) & ~gap)
        D.build_items(store, plain.drop("local"), wanted, hot)
        late = rows.where(local > F.lit(cuts[2])).drop("local")
        D.update_items(store, late, wanted, cuts[2] + day, last, hot)
        D.update_items(store, rows.where(gap).drop("local"), wanted, cuts[0], cuts[1])
        found = store.read(D.ITEMS_TABLE).select(
            *E.SESSION, "item_id", "event_timestamp_micros", "event_name", "item_index", "price",
            "quantity", "item_event_no",
        )
        return settled(found)


@query("WITH " + ITEMS_SQL + "SELECT DISTINCT name AS event_name FROM item_rows")
def item_events(spark, sf):
    return N.item_events(A.order_events(spark, sf))


@query("WITH " + ITEMS_SQL + """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS event_date, micros AS event_timestamp_micros,
  name AS event_name, u AS user_pseudo_id, l_orderkey AS ga_session_id,
  u || '_' || l_orderkey AS pseudonymous_session_id, item_index, item_id, price, quantity,
  price * coalesce(quantity, 1) AS item_subtotal,
  sha256(u || '|' || micros || '|' || name || '|' || l_orderkey) AS event_id,
  row_number() OVER (PARTITION BY u, l_orderkey, item_id ORDER BY micros, name, item_index)
    AS item_event_no,
  l_linenumber AS line__items, l_linestatus AS status__items, l_tax AS tax__items
FROM item_rows
""")
def micro_items(spark, sf):
    rows, columns, hot = item_frame(spark, sf, with_identity=False)
    numbered = N.number_items(rows.drop(*N.MADE_COLUMNS), hot)
    built = V.conform(N.with_made_columns(numbered), N.items_schema(columns))
    return built.select(
        text("event_date"), "event_timestamp_micros", "event_name", "user_pseudo_id",
        "ga_session_id", "pseudonymous_session_id", "item_index", "item_id", "price", "quantity",
        "item_subtotal", "event_id", "item_event_no", "line__items", "status__items", "tax__items",
    )


# -- keyed table changes -------------------------------------------------------------------


@query("""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, 'old' AS version FROM events
WHERE CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'
UNION ALL
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR), 'new' FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-12'
""")
def range_replace(spark, sf):
    rows = A.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("event_date"))
    first, last = ids.parse_day("20240105"), ids.parse_day("20240112")
    inside = F.col("event_date").between(F.lit(ids.parse_day("20240106")), F.lit(last))
    with scratch_store(spark) as store:
        old = rows.select("event_id", F.lit("old").alias("version"), "event_date")
        store.replace("versions", old, ["event_date"])
        new = rows.where(inside).withColumn("version", F.lit("new"))
        store.overwrite_days("versions", new, days_between(first, last), spread=True)
        found = store.read("versions")
        return settled(found.withColumn("event_date", F.col("event_date").cast("string")))


@query("""
WITH spend AS (
  SELECT user_id AS c_custkey, count(*) AS n, max(value) AS top FROM events GROUP BY user_id
)
SELECT c_custkey, c.c_mktsegment, coalesce(n, 0) AS n,
  CASE WHEN s.c_custkey IS NULL THEN c_acctbal WHEN c.c_custkey IS NULL THEN top
    ELSE greatest(c_acctbal, top) END AS balance
FROM customer c FULL OUTER JOIN spend s USING (c_custkey)
""")
def upsert_by_key(spark, sf):
    old = A.table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.lit(0).cast("bigint").alias("n"),
        F.col("c_acctbal").alias("balance"),
    )
    new = A.table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.max("value").alias("balance")
    )
    rule = {"balance": F.greatest("o.balance", "n.balance")}
    return U.upsert_by_key(old, new, ["c_custkey"], rule)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey)
""")
def append_if_new(spark, sf):
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    seen = A.table(spark, sf, "events").select(F.col("user_id").alias("o_custkey"))
    return U.append_if_new(orders, seen, ["o_custkey"])


@query("""
WITH spend AS (SELECT user_id, max(value) AS top FROM events GROUP BY user_id)
SELECT o_orderkey, o_custkey, CASE WHEN s.user_id IS NOT NULL AND o_orderstatus = 'O' THEN top
  ELSE o_totalprice END AS o_totalprice
FROM orders LEFT JOIN spend s ON s.user_id = o_custkey
""")
def update_from(spark, sf):
    orders = A.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    spend = A.table(spark, sf, "events").groupBy(F.col("user_id").alias("o_custkey")).agg(
        F.max("value").alias("o_totalprice")
    )
    updated = U.update_from(
        orders, spend, ["o_custkey"], ["o_totalprice"], only=F.col("o_orderstatus") == "O"
    )
    return updated.drop("o_orderstatus")


# -- run control ---------------------------------------------------------------------------

RUNS_SQL = """
runs AS (
  SELECT user_id, strftime(ts, '%Y%m%d') AS end_date,
    CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'SKIPPED: not found'
      ELSE 'SUCCESS' END AS phase_0_status, count(*) AS total_rows
  FROM events GROUP BY ALL
)
"""


def runs(spark, sf):
    """A run log derived from the events: one run per user and day, skipped on any error."""
    errors = F.count_if(F.col("event_type") == "error")
    return A.table(spark, sf, "events").groupBy(
        "user_id", F.date_format("ts", "yyyyMMdd").alias("end_date")
    ).agg(
        F.when(errors > 0, "SKIPPED: not found").otherwise("SUCCESS").alias("phase_0_status"),
        F.count("*").alias("total_rows"),
    )


@query("WITH " + RUNS_SQL + """
SELECT phase_0_status, count(*) AS runs, sum(total_rows) AS total_rows, min(end_date) AS first_day,
  max(end_date) AS last_day FROM runs GROUP BY phase_0_status
""")
def run_log(spark, sf):
    return G.run_status_summary(runs(spark, sf))


@query("WITH " + RUNS_SQL + """
SELECT DISTINCT end_date FROM runs r WHERE phase_0_status LIKE 'SKIPPED%' AND end_date >= '20240110'
  AND EXISTS (SELECT 1 FROM events e WHERE strftime(e.ts, '%Y%m%d') = r.end_date AND e.value > 200)
  AND NOT EXISTS (SELECT 1 FROM runs o WHERE o.end_date = r.end_date AND o.total_rows > 5
    AND o.phase_0_status = 'SUCCESS')
""")
def run_log_recovery(spark, sf):
    events = A.web_events(spark, sf)
    log = runs(spark, sf)
    counts = shards.shard_counts(
        events.where(extract_param(F.col("event_params"), "value", S.FLOAT64) > 200)
    )
    only_large = log.where("phase_0_status LIKE 'SKIPPED%' OR total_rows > 5")
    return G.recoverable_days(only_large, counts, "20240110")


@query(with_ev(RAW_RICH, REGISTRY, PAGED, ASSEMBLED) + """
, local AS (SELECT *, CAST(ts + INTERVAL 9 HOUR AS DATE) AS day FROM assembled),
ends AS (
  SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM ev
),
metrics AS (
  SELECT (SELECT count(*) FROM registry) AS mst_event_params_cnt,
    (SELECT count(*) FROM local, ends WHERE day < last) AS before,
    (SELECT count(*) FROM local, ends WHERE day <= last) AS after
)
SELECT strftime(CASE nr WHEN 1 THEN first WHEN 2 THEN last ELSE last + INTERVAL 3 DAY END, '%Y%m%d')
    AS start_date, nr > 1 AS is_incremental,
  CASE nr WHEN 3 THEN 'SKIPPED' ELSE 'SUCCESS' END AS status,
  CASE nr WHEN 1 THEN before WHEN 2 THEN after ELSE 0 END AS total_rows, mst_event_params_cnt,
  CASE nr WHEN 1 THEN 'mst_event_params_cnt,mst_item_params_cnt,micro_user_columns_cnt,micro_items_columns_cnt'
    ELSE '' END AS post_change_fields
FROM metrics, ends, (VALUES (1), (2), (3)) AS runs(nr)
""")
def logged_runs(spark, sf):
    """What three runs leave in the run log and in the snapshot log: all days but the last, the last
    day on top, and a day without source."""
    events = rich(spark, sf).drop("source_id")
    with scratch_store(spark) as store:
        path = f"{store.root}/../source"
        events.repartition("shard").write.partitionBy("shard").parquet(path)
        first, last = events.agg(F.min("shard"), F.max("shard")).first()
        spans = [(first, ids.shift_day(last, -1)), (last, last)]
        spans.append((ids.shift_day(last, 3),) * 2)
        for number, (start, end) in enumerate(spans):
            cfg = BatchConfig(
                start, end, path, store.root, incremental=number > 0, exclusive_end=True
            )
            before = current_metrics(store)
            run_batch(spark, cfg)
            snapshot_run(store, cfg, "manual", before)
        log, changes = store.read("log_batch_execution"), store.read("log_daily_batch_schema_snapshot")
        found = log.join(changes, "start_date").select(
            "start_date", log["is_incremental"],
            F.regexp_extract("phase_0_status", r"^[A-Z]+", 0).alias("status"), "total_rows",
            "mst_event_params_cnt", "post_change_fields",
        )
        return settled(found)


@query("""
WITH daily AS (
  SELECT strftime(ts, '%Y%m%d') AS day, count(DISTINCT user_id) AS a, count(DISTINCT event_type) AS b,
    count(*) AS c, count(*) FILTER (WHERE event_type = 'view') AS d FROM events GROUP BY ALL
),
pairs AS (
  SELECT *, lag(a) OVER w AS pa, lag(b) OVER w AS pb, lag(c) OVER w AS pc, lag(d) OVER w AS pd,
    lag(day) OVER w AS pday FROM daily WINDOW w AS (ORDER BY day)
)
SELECT day, CASE WHEN pday IS NULL THEN '' ELSE concat_ws(',',
    CASE WHEN pa <> a THEN 'mst_event_params_cnt' END, CASE WHEN pb <> b THEN 'mst_item_params_cnt' END,
    CASE WHEN c < pc THEN 'micro_user_columns_cnt' END, CASE WHEN d < pd THEN 'micro_items_columns_cnt' END)
  END AS changed_fields
FROM pairs
""")
def schema_drift(spark, sf):
    daily = A.table(spark, sf, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(
        F.count_distinct("user_id").alias("mst_event_params_cnt"),
        F.count_distinct("event_type").alias("mst_item_params_cnt"),
        F.count("*").alias("micro_user_columns_cnt"),
        F.count_if(F.col("event_type") == "view").alias("micro_items_columns_cnt"),
    )
    return G.drift_over_snapshots(daily, "day").select("day", "changed_fields")


@query("""
SELECT strftime(max(ts), '%Y%m%d') AS day, arg_max(event_id, (ts, event_id)) AS event_id FROM events
""")
def latest_snapshot(spark, sf):
    rows = A.table(spark, sf, "events").select("ts", "event_id")
    return G.latest(rows, "ts", ["event_id"]).select(
        F.date_format("ts", "yyyyMMdd").alias("day"), "event_id"
    )
