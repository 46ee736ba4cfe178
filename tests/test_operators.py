"""Operators on hand rows: the corner cases of the data model."""

import random
import time
from datetime import date

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import fixtures as X
from tidemark import schema as S
from tidemark.functions import ids
from tidemark.functions.lattice import widest_of
from tidemark.functions.params import extract_param, session_id, to_integer
from tidemark.operators import columns as C
from tidemark.operators import events as E
from tidemark.operators import evolve as V
from tidemark.operators import identity as I
from tidemark.operators import items as N
from tidemark.operators import micro as M
from tidemark.operators import ordered as O
from tidemark.operators import registry as R
from tidemark.operators import upsert as U
from tidemark.operators.skew import cut_lineage, left_join, working_in
from tidemark.plans import catalog
from tidemark.plans import control as G
from tidemark.plans import incremental as D
from tidemark.plans import state as ST
from tidemark.plans.store import TableStore
from tidemark.sources import shards

TZ = "Asia/Tokyo"
DAY = ("20260501", "20260501")
MINUTE = 60_000_000
types = st.sampled_from([S.INT64, S.FLOAT64, S.STRING])


def now():
    return F.timestamp_micros(F.lit(0))


def values(frame, *columns):
    return [tuple(row) for row in frame.select(*columns).collect()]


@given(st.lists(types, min_size=1), st.lists(types, min_size=1), types)
def test_lattice_laws(left, right, one):
    assert widest_of(left + right) == widest_of(right + left)
    assert widest_of([widest_of(left), *right]) == widest_of([*left, widest_of(right)])
    assert widest_of([one, one]) == one


def test_rounding_goes_away_from_zero(spark):
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-2.5,), (0.9,)], "x double")
    assert [r[0] for r in values(rows, to_integer(F.col("x")))] == [1, 2, 3, -1, -3, 1]


def test_extraction_follows_type_and_takes_first_match(spark):
    rows = X.events_frame(spark, [
        X.event(1, "e", params=[("p", X.value(text="t")), ("p", X.value(integer=5))]),
        X.event(2, "e", params=[("p", X.value(integer=5))]),
        X.event(3, "e", params=[("p", X.value(number=2.5))]),
        X.event(4, "e", params=[("p", X.value(floating=2.5))]),
        X.event(5, "e"),
    ]).orderBy("event_timestamp")
    params = F.col("event_params")
    got = values(rows, *[extract_param(params, "p", t) for t in (S.STRING, S.FLOAT64, S.INT64)])
    assert got == [("t", None, None), ("5", 5.0, 5), ("2.5", 2.5, 3), (None,) * 3, (None,) * 3]
    percent = X.events_frame(spark, [X.event(1, "e", params=[("percent_x", X.value(integer=90))])])
    assert values(percent, extract_param(params, "percent_x", S.INT64)) == [(0.9,)]


def test_session_number_from_text(spark):
    rows = X.events_frame(spark, [
        X.event(1, "e", session=None, params=[("ga_session_id", X.value(text="17"))]),
        X.event(2, "e", session=None, params=[("ga_session_id", X.value(text="no number"))]),
        X.event(3, "e", session=None),
    ])
    assert values(rows, session_id(F.col("event_params"))) == [(17,), (None,), (None,)]


def test_window_ends_at_the_last_whole_second(spark):
    end = X.DAY1 + 10 * 3_600_000_000 - 1_000_000  # 23:59:59 local
    rows = spark.createDataFrame([(end,), (end + 1,), (end + 1_000_000,), (end - 86_399_000_000,)], "m bigint")
    inside = ids.in_local_window(F.col("m"), *DAY, TZ)
    whole = ids.in_local_window(F.col("m"), *DAY, TZ, exclusive_end=True)
    assert values(rows, inside, whole) == [
        (True, True), (False, True), (False, False), (True, True)]


def registry_of(spark, rows):
    raw = R.observe_params(X.events_frame(spark, rows))
    return R.build_registry(raw, shards.empty(spark, S.EVENT_PARAM_REGISTRY), now())


def test_registry_rules(spark):
    text = X.value(text="x")
    rows = [
        X.event(1, "lead", params=[("value", X.value(integer=1)), ("color", text), ("only_float", X.value(floating=1.0))]),
        X.event(1, "page_view", params=[("color", text), ("clarity_user_id", text), ("debug_mode", text)]),
        X.event(1, "fetch_user_data", params=[("color", text)]),
    ]
    got = {(r.event_name, r.param_name): (r.data_type, r.micro_column_name, r.event_category, r.param_category)
           for r in registry_of(spark, rows).collect()}
    assert got == {
        ("lead", "value"): (S.FLOAT64, "value__lead", "custom", "recommended"),
        ("lead", "color"): (S.STRING, "color__lead", "custom", "custom"),
        ("lead", "only_float"): (S.STRING, "only_float__lead", "custom", "custom"),
        ("page_view", "color"): (S.STRING, "color", "enhanced", "custom"),
        ("page_view", "clarity_user_id"): (S.STRING, "clarity_user_id", "enhanced", "martech"),
        ("search", "search_term"): (S.STRING, "search_term", "recommended", "enhanced"),
    }


def test_duplicate_log_keeps_equal_types_and_unknown(spark):
    rows = [X.event(1, "e", params=[("price", X.value(integer=1))]),
            X.event(2, "e", params=[("price", X.value(text="2"))])]
    raw = R.observe_params(X.events_frame(spark, rows))
    log = R.duplicate_params(raw, shards.empty(spark, S.EVENT_PARAM_REGISTRY))
    assert values(log, "param_name", "duplicate_count", "types_found", "resolved_type") == [
        ("price", 2, "FLOAT64,FLOAT64", "UNKNOWN")]


def test_categories_stay_once_set(spark):
    old = spark.createDataFrame(
        [("click", "color", S.INT64, "color", "mine", "own", None)], S.ddl(S.EVENT_PARAM_REGISTRY))
    raw = R.observe_params(X.events_frame(spark, [X.event(1, "click", params=[("color", X.value(number=1.0))])]))
    row = R.build_registry(raw, old, now()).where("event_name = 'click'").first()
    assert (row.data_type, row.event_category, row.param_category) == (S.FLOAT64, "mine", "own")


def test_column_plan_collisions_and_case(spark):
    text = X.value(text="x")
    rows = [X.event(1, "page_view", params=[("region", text), ("Tone", text), ("tone", X.value(integer=1))]),
            X.event(1, "session_start", params=[("clarity_project_id", text), ("batch_no", text)])]
    plan = C.column_plan(registry_of(spark, rows), ["tier"])
    assert plan.collisions == ["region"]
    assert [(c.name, c.data_type) for c in plan.raw if c.name.lower() == "tone"] == [("Tone", S.STRING)]
    assert [c.name for c in plan.raw] == ["Tone", "clarity_project_id", "search_term"]
    assert [c.name for c in plan.final] == ["Tone", "search_term"]


def test_plan_and_classes_share_one_rule(spark):
    number = X.value(integer=1)
    rows = [X.event(1, "page_view", params=[("Tone", number), ("batch_n", number), ("percent_x", number)]),
            X.event(1, "lead", params=[("tone", X.value(text="x")), ("gclid", number), ("clarity_x", number)]),
            X.event(1, "session_start", params=[("clarity_x", number)])]
    got = {(r.event_name, r.param_name): (r.ptype, r.unified_type) for r in C.param_class(registry_of(spark, rows)).collect()}
    assert got == {
        ("page_view", "Tone"): ("common", S.STRING), ("lead", "tone"): ("unique", S.STRING),
        ("page_view", "percent_x"): ("common", S.FLOAT64), ("session_start", "clarity_x"): ("replay", S.INT64),
        ("search", "search_term"): ("common", S.STRING),
    } | {k: v for k, v in got.items() if v[0] == "none"}
    assert {k[1] for k, v in got.items() if v == ("none", None)} <= {"batch_n", "gclid", "clarity_x"}


def test_mixed_int_and_float_over_events_is_text(spark):
    rows = [X.event(1, "page_view", params=[("n", X.value(integer=1))]),
            X.event(1, "click", params=[("n", X.value(number=1.5))])]
    assert [(c.name, c.data_type) for c in C.column_plan(registry_of(spark, rows)).final] == [
        ("n", S.STRING), ("search_term", S.STRING)]


def flatten(spark, rows, user_ids=()):
    events = X.events_frame(spark, rows)
    plan = C.column_plan(registry_of(spark, rows))
    known = spark.createDataFrame([(u, i, None, None) for u, i in user_ids], S.ddl(S.IDENTITY_MAP))
    base = E.base_events(events, known, *DAY, TZ)
    return E.flatten_events(base, plan, TZ, "b"), plan


def micro(spark, rows, slots=()):
    tables, plan = flatten(spark, rows)
    names = [n for n in slots]
    attributes = shards.empty(spark, S.USER_ATTRIBUTES_HEAD | {n: "string" for n in names} | S.USER_ATTRIBUTES_TAIL)
    return M.micro_user(tables, attributes, plan, names)


def test_page_views_of_one_moment_are_peers(spark):
    at = X.DAY1
    rows = [X.event(at, "click"), X.event(at, "page_view"), X.event(at + MINUTE, "click"),
            X.event(at + MINUTE, "page_view"), X.event(at, "click", session=None)]
    tables, _ = flatten(spark, rows)
    got = sorted(values(tables, "event_name", "page_view_id"), key=str)
    assert got == [("click", "a_1_1"), ("click", "a_1_2"), ("click", None), ("page_view", "a_1_1"),
                   ("page_view", "a_1_2")]


def test_scroll_fold_and_duplicates(spark):
    at = X.DAY1

    def scroll(seconds, percent):
        return X.event(at + seconds * 1_000_000, "scroll", params=[("percent_scrolled", X.value(integer=percent))])

    rows = [X.event(at, "page_view"), X.event(at, "page_view"), scroll(1, 25), scroll(2, 90),
            X.event(at + MINUTE, "page_view"), X.event(at + 2 * MINUTE, "click")]
    got = values(micro(spark, rows).orderBy("event_timestamp_micros"), "event_name", "page_view_id",
                 "max_scroll_percent", "session_event_no")
    assert got == [("page_view", "a_1_2", 1, 1), ("page_view", "a_1_3", None, 2), ("click", "a_1_3", None, 3)]
    spark.conf.set(M.RAW_SCROLL, "true")
    try:
        raw = values(micro(spark, rows).orderBy("event_timestamp_micros"), "max_scroll_percent")
        hot = M.scroll_depth(flatten(spark, [*rows, scroll(3, 29)])[0]).collect()
    finally:
        spark.conf.unset(M.RAW_SCROLL)
    assert [r[0] if isinstance(r, tuple) else r for r in raw] == [90, None, None]
    assert [r.page_scroll for r in hot] == [90]


def test_key_sessions_and_flags(spark):
    rows = [X.event(X.DAY1, "CV_x", session=1), X.event(X.DAY1, "cv_x", session=2), X.event(X.DAY1, "click", session=3),
            X.event(X.DAY1, "purchase", session=None)]
    tables, _ = flatten(spark, rows)
    assert dict(values(tables, "event_name", "is_key_event")) == {"CV_x": 1, "cv_x": 0, "click": 0, "purchase": 1}
    assert dict(values(micro(spark, rows), "event_name", "is_key_event")) == {
        "CV_x": 1, "cv_x": 1, "click": 0, "purchase": 0}


def test_hops_skip_unknown_hosts(spark):
    rows = [X.event(X.DAY1 + i * MINUTE, "click", host=h) for i, h in
            enumerate(["www.A.test", None, "b.test", "B.test", "a.test"])]
    got = values(micro(spark, rows).orderBy("event_timestamp_micros"), "hostname_norm", "prev_hostname_norm",
                 "next_hostname_norm", "is_cross_domain_hop")
    assert got == [("a.test", None, None, False), (None, "a.test", "b.test", False),
                   ("b.test", None, "b.test", False), ("b.test", "b.test", "a.test", False),
                   ("a.test", "b.test", None, True)]


def test_sessionless_rows_are_numbered_per_user(spark):
    rows = [X.event(X.DAY1 + i * MINUTE, "click", user=u, session=None) for i, u in enumerate("abab")]
    got = values(micro(spark, rows), "user_pseudo_id", "session_event_no", "user_event_no", "pseudonymous_session_id")
    assert sorted(got) == [("a", 1, 1, None), ("a", 2, 2, None), ("b", 1, 1, None), ("b", 2, 2, None)]


def test_replay_address_needs_all_parts_and_reaches_the_session(spark):
    def parts(*names):
        return [(f"clarity_{n}_id", X.value(text=n[0])) for n in names]

    rows = [X.event(X.DAY1, "session_start", session=1, params=parts("project", "user", "session")),
            X.event(X.DAY1 + 1, "click", session=1),
            X.event(X.DAY1, "session_start", session=2, params=parts("project", "user")),
            X.event(X.DAY1 + 1, "click", session=2), X.event(X.DAY1, "click", session=3)]
    got = sorted(values(micro(spark, rows), "ga_session_id", "event_name", "clarity_play_url"), key=str)
    url = S.REPLAY_PREFIX + "p/u/s"
    assert got == [(1, "click", url), (1, "session_start", url), (2, "click", None), (2, "session_start", None),
                   (3, "click", None)]


def test_common_column_also_filled_for_custom_events(spark):
    rows = [X.event(X.DAY1, "click", params=[("tone", X.value(text="x"))]),
            X.event(X.DAY1 + 1, "lead", params=[("tone", X.value(text="y"))])]
    got = values(micro(spark, rows).orderBy("event_name"), "tone", "tone__lead")
    assert got == [("x", None), ("y", "y")]


def test_event_table_types_are_its_own(spark):
    rows = [X.event(X.DAY1, "click", params=[("n", X.value(integer=1))]),
            X.event(X.DAY1, "page_view", params=[("n", X.value(number=1.5))])]
    tables, plan = flatten(spark, rows)
    assert dict(tables.dtypes)["n"] == "string"
    for name, kind, want in (("click", "bigint", 1), ("page_view", "double", 1.5)):
        own = E.event_table(tables, plan, name)
        assert dict(own.dtypes)["n"] == kind and own.first()["n"] == want
        assert "clarity_play_url" not in own.columns


def test_identity_and_slots(spark):
    events = X.events_frame(spark, [
        X.event(5, "e", "a", user_id="old"), X.event(9, "e", "a", user_id="new1"), X.event(9, "e", "a", user_id="new2"),
        X.event(99, "e", "a", user_id=""), X.event(9, "e", "b", user_id="late", shard="20260601"),
        X.event(9, "e", "c", user_id="early", shard="20250101")])
    assert values(I.identity_map(events, *DAY, TZ, now()), "user_pseudo_id", "user_id") == [("a", "new2")]
    users = X.users_frame(spark, [
        X.user("a", "snap", 5, 1, [("s1", "tier level", 5, "low"), ("s1", "tier level", 6, "lower"), ("s2", "tier-level", 9, "z"),
                                   ("s3", "country", 9, "q")]),
        X.user("b", "snap", 5, 1, [], shard="20260430")])
    slots, refused = I.slot_columns(I.slot_registry(users, *DAY, TZ, now()), set(S.MICRO_USER_FIXED))
    assert [(s.key, s.column) for s in slots] == [("s2", "tier_level")] and sorted(refused) == ["s1", "s3"]
    known = I.identity_map(events, *DAY, TZ, now())
    frame = I.user_attributes(users, known, [I.Slot("s1", "tier"), *slots], *DAY, TZ, now())
    assert sorted(values(frame, "user_pseudo_id", "user_id", "tier", "tier_level"), key=str) == [
        ("a", "new2", "lower", "z"), ("b", "snap", None, None)]


def test_audience_in_two_shards_comes_once(spark):
    member = [(7, "aud", 100, 200, True)]
    users = X.users_frame(spark, [X.user("a", None, 5, 1, [], s, member) for s in ("20260430", "20260501")])
    known, nothing = shards.empty(spark, S.IDENTITY_MAP), shards.empty(spark, S.AUDIENCE_LOG)
    log = I.audience_log(users, known, nothing, *DAY, now())
    assert values(log, "audience_id", "pseudonymous_session_id") == [("7", "a_20260501")]
    assert I.audience_log(users, known, log, *DAY, now()).count() == 0


def test_items(spark):
    text = [("kind", X.value(text="k")), ("n", X.value(integer=4))]
    row = X.event(X.DAY1, "purchase", items=[X.item("x", 2.0, 3, text), X.item("x", 5.0)])
    events = X.events_frame(spark, [row, X.event(X.DAY1, "click", items=[]), X.event(X.DAY1, "view_item")])
    registry = R.item_registry(R.observe_item_params(events), shards.empty(spark, S.ITEM_PARAM_REGISTRY), now())
    known = spark.createDataFrame([("a", "member", None, None)], S.ddl(S.IDENTITY_MAP))
    rows = N.explode_items(events, known, N.item_columns(registry), *DAY, TZ, "b", now())
    got = values(N.number_items(rows).orderBy("item_index"), "item_index", "item_subtotal", "kind__items", "n__items",
                 "user_id", "item_event_no")
    assert got == [(0, 6.0, "k", 4, "member", 1), (1, 5.0, None, None, "member", 2)]
    assert values(N.item_events(events), "event_name") == [("purchase",)]


def test_upsert_keeps_columns_the_new_side_lacks(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, x string, y int")
    new = spark.createDataFrame([(2, None), (3, "c")], "id int, x string")
    got = sorted(values(U.upsert_by_key(old, new, ["id"]), "id", "x", "y"))
    assert got == [(1, "a", 5), (2, None, 6), (3, "c", None)]
    absent = spark.createDataFrame([(3, "z"), (1, "z")], "id int, x string")
    assert sorted(values(U.insert_if_absent(old, absent, ["id"]), "id", "x")) == [(1, "a"), (2, "b"), (3, "z")]


def test_conform_adds_casts_and_orders(spark):
    rows = spark.createDataFrame([(1, 2)], "b bigint, a bigint")
    out = V.conform(rows, {"a": "string", "c": "double", "b": "double"})
    assert out.dtypes == [("a", "string"), ("c", "double"), ("b", "double")]
    assert tuple(out.first()) == ("2", None, 1.0)


def random_rows(seed):
    """Groups of very different size, NULL keys, equal moments, whole copies."""
    rng = random.Random(seed)
    users = ["a"] * 40 + [None] * 25 + list("bcdefgh")
    return [(rng.choice(users), rng.choice([1, 1, 1, None]), rng.randrange(60), rng.choice("xyz"), rng.randrange(3))
            for _ in range(400)]


SHAPE = "u string, s int, t bigint, e string, h int"


@pytest.mark.parametrize("group", [["u"], ["u", "s"]])
def test_segments_equal_plain_windows(spark, group):
    rows = spark.createDataFrame(random_rows(1), SHAPE).dropDuplicates(["u", "s", "t", "e"])
    spec = O.Ordering(group, ["t", "e", "s"], "no", {"pe": "e", "ph": "h"}, {"nh": "h"})
    plain = sorted(map(str, O.windowed(rows, spec).collect()))
    for segments in (2, 7, 40):
        assert sorted(map(str, O.segmented(rows, spec, segments).collect())) == plain
    spark.conf.set("tidemark.hotRows", "30")
    try:
        assert sorted(map(str, O.ordered_columns(rows, spec).collect())) == plain
    finally:
        spark.conf.unset("tidemark.hotRows")


def test_segmented_running_count_equals_plain(spark):
    rows = spark.createDataFrame(random_rows(2), SHAPE)
    args = (["u", "s"], "t", F.col("e") == "x", "n")
    plain = sorted(map(str, O.windowed_running_count(rows, *args).collect()))
    spark.conf.set("tidemark.hotRows", "4")
    try:
        assert sorted(map(str, O.segmented_running_count(rows, *args, 9).collect())) == plain
    finally:
        spark.conf.unset("tidemark.hotRows")


def test_whole_copies_are_numbered_in_chunks(spark):
    rows = spark.createDataFrame(random_rows(3), SHAPE)
    spec = O.Ordering(["u", "s"], ["t", "e", "h"], "no")
    plain = sorted(map(str, O.windowed(rows, spec).collect()))
    got = O.segmented_with_copies(rows, spec.group, spec.order, "no", 6, 2)
    assert sorted(map(str, got.collect())) == plain


def test_rank_filter_and_dedup_limit_before_the_shuffle(spark):
    rows = spark.createDataFrame(random_rows(4), SHAPE)
    frames = [
        O.newest(rows, ["u"], ["t", "e"]),
        M.dedup_events(rows.withColumnsRenamed({"u": "user_pseudo_id", "s": "ga_session_id",
                                                "t": "event_timestamp_micros", "e": "event_name", "h": "page_view_id"})),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")


def test_event_level_plan_shuffles_events_once(spark):
    rows = [X.event(X.DAY1, "page_view", params=[("n", X.value(integer=1))])]
    tables, plan = flatten(spark, rows)
    narrow = spark.createDataFrame(tables.collect(), tables.schema)
    attributes = shards.empty(spark, S.USER_ATTRIBUTES_HEAD | S.USER_ATTRIBUTES_TAIL)
    built = M.micro_user(narrow, attributes, plan, [], hot=None)
    text = built._jdf.queryExecution().executedPlan().toString()
    sides = text.count("Exchange hashpartitioning")
    assert sides <= 2, text  # the events, and the attributes unless broadcast
    assert "BatchEvalPython" not in text and "ArrowEval" not in text


def test_drift_and_recovery(spark):
    one = dict(mst_event_params_cnt=1, mst_item_params_cnt=1, micro_user_columns_cnt=5, micro_items_columns_cnt=5)
    assert G.schema_drift(None, one) == []
    grown = one | dict(mst_event_params_cnt=2, micro_user_columns_cnt=6, micro_items_columns_cnt=4)
    assert G.schema_drift(one, grown) == ["mst_event_params_cnt", "micro_items_columns_cnt"]
    assert G.schema_drift(one, one | dict(micro_user_columns_cnt=None)) == ["micro_user_columns_cnt"]
    log = spark.createDataFrame(
        [("1", "SKIPPED: x"), ("2", "SKIPPED: x"), ("2", "SKIPPED: y"), ("3", "SKIPPED: x"), ("3", "SUCCESS"), ("4", "SKIPPED: x")],
        "end_date string, phase_0_status string")
    counts = spark.createDataFrame([("1", 5), ("2", 5), ("3", 5), ("4", 0)], "shard string, row_count int")
    assert values(G.recoverable_days(log, counts, "2"), "end_date") == [("2",)]


def test_store_versions_and_days(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, "2026-05-01"), (2, "2026-05-02")], "x bigint, d string").select(
        "x", F.col("d").cast("date").alias("event_date"))
    store.replace("t", rows, ["event_date"])
    with pytest.raises(Exception):
        store.replace("t", rows.withColumn("x", F.raise_error(F.lit("lost"))), ["event_date"])
    assert store.read("t").count() == 2
    old = store.read("t")
    first, last = ids.parse_day("20260501"), ids.parse_day("20260502")
    moved = old.where("event_date = '2026-05-01'").withColumn("x", F.col("x") + 10)
    store.overwrite_days("t", moved, [first, last])
    assert values(store.read("t"), "x") == [(11,)]
    store.evolve("t", {"x": "double", "y": "string", "event_date": "date"})
    assert values(store.read("t"), "x", "y") == [(11.0, None)]
    store.clear("t")
    assert not store.exists("t") and store.read("t", {"x": "int"}).count() == 0


def test_widened_days_keep_their_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))

    def put(rows, kind):
        frame = spark.createDataFrame(rows, f"x {kind}, n string, d string").select(
            "x", "n", F.col("d").cast("date").alias("event_date"))
        return frame

    store.replace("t", put([(1, "a", "2026-05-01"), (2, "b", "2026-05-02"), (3, "c", "2026-05-03")], "bigint"),
                  ["event_date", "n"])
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    day = {"n": "string", "event_date": "date"}
    store.evolve("t", {"x": "double"} | day)
    third, second = ids.parse_day("20260503"), ids.parse_day("20260502")
    store.overwrite_days("t", put([(3.5, "z", "2026-05-03")], "double"), [third])
    store.evolve("t", {"x": "string", "y": "double"} | day)
    assert {f: f.stat().st_mtime_ns for f in files if f.exists()} == {
        f: t for f, t in files.items() if "2026-05-03" not in str(f)}
    got = sorted(values(store.read("t"), "x", "y", "n"))
    assert got == [("1.0", None, "a"), ("2.0", None, "b"), ("3.5", None, "z")]
    pruned = store.read("t").where(F.col("event_date") == F.lit(second))
    assert values(pruned, "x") == [("2.0",)]
    # a replaced day moves to the newest types, a day without rows goes
    store.overwrite_days("t", pruned.withColumn("x", F.lit("text")), [second, third])
    assert sorted(values(store.read("t"), "x", "n")) == [("1.0", "a"), ("text", "b")]
    assert store.meta("t")["days"] == {"2026-05-02": 2, "2026-05-03": 2}
    assert not list((tmp_path / "t" / "t").rglob("__write__=1"))
    store.replace("t", store.read("t"), ["event_date", "n"])
    store.replace("t", store.read("t"), ["event_date", "n"])
    assert sorted(values(store.read("t"), "x")) == [("1.0",), ("text",)]
    assert len(list((tmp_path / "t" / "t").glob("v*"))) == 2


def test_days_are_replaced_at_once_and_without_listings(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "t"))
    rows = spark.sql(
        "SELECT id AS x, CONCAT('n', id % 40) AS n, DATE_ADD(DATE'2026-05-01', CAST(id % 5 AS INT)) AS event_date "
        "FROM RANGE(400)"
    )
    store.replace("t", rows, ["event_date", "n"])
    second = ids.parse_day("20260502")
    listed = []
    names = TableStore._names
    monkeypatch.setattr(TableStore, "_names", lambda self, *parts: listed.append(parts) or names(self, *parts))
    kept = store.read("t").where(F.col("event_date") == F.lit(second)).where("x < 100")
    fails = kept.withColumn("x", F.when(F.col("x") < 90, F.col("x")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception):
        store.overwrite_days("t", fails, [second])
    assert store.read("t").count() == 400  # what the failed write left is not read
    reader = store.read("t")
    monkeypatch.setattr(TableStore, "_delete", lambda self, *parts: None)  # a run that ends before it tidies up
    store.overwrite_days("t", kept, [second])
    assert reader.count() == 400  # an open reader sees the table as it was
    assert store.read("t").count() == 340 and len(store.days("t")) == 5
    assert not any("n=" in "/".join(parts) for parts in listed)  # no folder below a day is listed
    assert len({parts for parts in listed if "event_date" in str(parts)}) == 0
    plan = store.read("t").where(F.col("event_date") == F.lit(second))._jdf.queryExecution().executedPlan().toString()
    assert "__write__" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def spoil(folder):
    """Make every file below a folder unreadable without a change of its folder's time."""
    for file in folder.rglob("*.parquet"):
        size = file.stat().st_size
        with open(file, "r+b") as stream:
            stream.write(b"?" * size)


def test_second_day_scans_its_own_shards_only(spark, tmp_path):
    events = [X.event(X.DAY1 + i * 86_400_000_000, "page_view", f"u{i % 2}", shard=f"2026050{i + 1}",
                      user_id=f"m{i}") for i in range(4)]
    X.write_sharded(X.events_frame(spark, events), tmp_path / "events")
    path, store = str(tmp_path / "events"), TableStore(spark, str(tmp_path / "out"))
    read = shards.read_events(spark, path)
    found = ST.identity_days(store, read, path, "20260503", "20260503")
    assert sorted(values(I.identity_of(found, TZ, now()), "user_pseudo_id", "user_id")) == [("u0", "m2"), ("u1", "m1")]
    for i in (1, 2, 3):
        spoil(tmp_path / "events" / f"shard=2026050{i}")
    found = ST.identity_days(store, read, path, "20260504", "20260504")
    assert sorted(values(I.identity_of(found, TZ, now()), "user_pseudo_id", "user_id")) == [("u0", "m2"), ("u1", "m3")]
    found = ST.identity_days(store, read, path, "20260504", "20260504", days=1)
    assert sorted(values(found, "user_id")) == [("m2",), ("m3",)]
    # a shard that is delivered again is summed up again, one that is gone counts no more
    again = X.events_frame(spark, [X.event(X.DAY1 + 86_400_000_000, "page_view", "u9", shard="20260502", user_id="new")])
    again.drop("shard").coalesce(1).write.mode("overwrite").parquet(f"{path}/shard=20260502")
    found = ST.identity_days(store, shards.read_events(spark, path), path, "20260504", "20260504")
    assert sorted(values(found, "user_id")) == [("m0",), ("m2",), ("m3",), ("new",)]


def test_property_state_equals_the_whole_log(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "out"))
    kind = ", ".join(f"{c} {t}" for c, t in S.USER_PROPERTY_LOG.items())

    def settings(rows):
        named = [{"user_pseudo_id": u, "property_key": k, "property_value_string": s, "property_value_int": n}
                 for u, k, s, n in rows]
        return spark.createDataFrame([tuple(r.get(c) for c in S.USER_PROPERTY_LOG) for r in named], kind)

    runs = [[("a", "p", None, 1), ("b", "p", None, None), (None, "q", None, None)], [],
            [("a", "p", "x", None), ("c", "p", None, 2), ("a", "q", None, 5), ("a", "q", None, 6)]]
    for rows in runs[:2]:
        ST.append_settings(store, settings(rows))
    store.note(ST.PENDING_SETTINGS, [])  # as an interrupted run leaves it
    ST.append_settings(store, settings([]))
    got = ST.append_settings(store, settings(runs[2])).collect()
    want = I.property_summary(store.read("log_user_properties")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {(r.property_key, r.resolved_type, r.unique_users, r.total_records) for r in got} == {
        ("p", "STRING", 3, 4), ("q", "INT64", 1, 3)}


def test_range_plan_shuffles_new_rows_once(spark):
    """Replay addresses and carried numbers come as side rows, so no join moves the rows again."""
    rows = [X.event(X.DAY1, "page_view", params=[("n", X.value(integer=1))])]
    tables, plan = flatten(spark, rows)
    narrow = spark.createDataFrame(tables.collect(), tables.schema)
    attributes = shards.empty(spark, S.USER_ATTRIBUTES_HEAD | S.USER_ATTRIBUTES_TAIL)
    users = spark.createDataFrame([("a", 7)], "user_pseudo_id string, user_carry bigint")
    sessions = spark.createDataFrame(
        [("a", 1, 3, "url", None, X.DAY1 - 60_000_000, "search", "h", None)],
        "user_pseudo_id string, ga_session_id bigint, carried bigint, replay_url string, last_date date, "
        "event_timestamp_micros bigint, event_name string, hostname_norm string, next_hostname_norm string")
    unnumbered = {c: t for c, t in M.micro_schema(plan, []).items() if c not in D.SEQUENCE_COLUMNS}
    fresh, _ = D.fresh_rows(narrow, D.side_rows(users, sessions), attributes, plan, [], unnumbered, None)
    built = M.gap_and_hop(D.sequence_with_side_rows(fresh))
    text = built._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 2, text  # the rows, and the attributes
    (row,) = built.where(M.is_row()).collect()
    assert (row.session_event_no, row.user_event_no, row.prev_event_name, row.seconds_from_prev_event,
            row.clarity_play_url, row.is_key_event) == (4, 8, "search", 60, "url", 0)


@pytest.mark.parametrize("limit", [{}, {"tidemark.broadcastRows": "0"}, {"tidemark.hotRows": "12"}])
def test_backfill_copies_other_days_as_they_lie(spark, tmp_path, monkeypatch, limit):
    """Days outside the range are copied with narrow changes: no exchange of their wide rows."""
    rows = []
    for day in range(4):
        for i in range(5):
            for user in ("a", "b", None) if (day, i) != (2, 0) else ("a",):
                # a session over all days, one without a number, and one of each day
                session = [1, None, 10 + day, 1, 10 + day][i] if user != "b" else 1
                at = X.DAY1 + day * 86_400_000_000 + i * 60_000_000
                rows.append(X.event(at, "page_view" if i % 2 else "search", user, session,
                                    f"2026050{day + 1}", host=f"h{(day + i) % 2}.test"))
    rows.append(X.event(X.DAY1 + 3_600_000_000, "search", "c", 7))  # not touched by the range
    plan, nobody = C.column_plan(registry_of(spark, rows)), shards.empty(spark, S.IDENTITY_MAP)
    base = E.base_events(X.events_frame(spark, rows), nobody, "20260501", "20260504", TZ)
    tables = E.flatten_events(base, plan, TZ, "b")
    tables = spark.createDataFrame(tables.collect(), tables.schema)
    attributes = shards.empty(spark, S.USER_ATTRIBUTES_HEAD | S.USER_ATTRIBUTES_TAIL)
    days = sorted(row[0] for row in tables.select("event_date").distinct().collect())
    gap = days[1]
    store, whole = (TableStore(spark, str(tmp_path / name)) for name in ("part", "whole"))
    D.build_events(whole, tables, attributes, plan, [])
    D.build_events(store, tables.where(F.col("event_date") != F.lit(gap)), attributes, plan, [])
    written, writer = [], TableStore._writer

    def record(self, frame, partitions, cluster, spread):
        if "session_event_no" in frame.columns and "micro_user_table" in str(frame.inputFiles()):
            written.append((spread, frame._jdf.queryExecution().executedPlan().toString()))
        return writer(self, frame, partitions, cluster, spread)

    monkeypatch.setattr(TableStore, "_writer", record)
    for key, value in limit.items():
        spark.conf.set(key, value)
    try:
        D.update_events(store, tables, attributes, plan, [], gap, gap)
    finally:
        for key in limit:
            spark.conf.unset(key)
    for table in ("micro_user_table", "carry_user_days", "carry_session_days"):
        got, want = (sorted(map(str, s.read(table).collect())) for s in (store, whole))
        assert got == want, table
    assert len(written) == 1
    if "tidemark.broadcastRows" not in limit:
        assert not written[0][0] and "Exchange hashpartitioning" not in written[0][1]


def plan_text(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_snapshots_are_sorted_as_plain_columns(spark):
    users = shards.empty(spark, S.USERS).unionByName(spark.createDataFrame([], S.ddl(S.USERS)))
    known = spark.createDataFrame([], S.ddl(S.IDENTITY_MAP))
    frame = I.user_attributes(users, known, [I.Slot("s1", "tier")], *DAY, TZ, now())
    above, below = plan_text(frame).split("Window [", 1)
    assert "lambda" in below and "lambda" not in above and "user_properties" not in above


def test_event_fields_of_items_are_taken_below_the_explode(spark):
    events = X.events_frame(spark, [X.event(X.DAY1, "purchase", items=[X.item("i1"), X.item("i2")])])
    rows = N.explode_items(
        events, shards.empty(spark, S.IDENTITY_MAP), [], *DAY, TZ, "b", now(), hot=None
    )
    above, below = plan_text(rows.drop("event_id")).split("Generate posexplode", 1)
    assert "AS ga_session_id" in below and "AS ga_session_id" not in above
    assert sorted(values(rows, "item_index", "item_id")) == [(0, "i1"), (1, "i2")]


def test_item_types_of_empty_and_null_arrays(spark):
    kind = "array<struct<item_params: array<struct<key: string, value: struct<string_value: string, "
    kind += "int_value: bigint, float_value: double, double_value: double>>>>>"
    pair = ("p", (None, 1, None, None))
    rows = [(None,), ([],), ([(None,), ([],), ([pair, (None, None), None],), None],)]
    events = spark.createDataFrame(rows, f"items {kind}")
    seen = R.observe_item_params(events)
    assert sorted(values(seen, "param_name", "data_type"), key=str) == [("p", S.INT64), (None, S.STRING)]
    assert "size(" not in plan_text(seen)


def test_an_empty_table_costs_no_shuffle(spark):
    rows = spark.range(5).select(F.col("id").cast("string").alias("user_pseudo_id"))
    known = shards.empty(spark, S.IDENTITY_MAP)
    assert [(f.name, f.dataType.simpleString()) for f in known.schema] == [*S.IDENTITY_MAP.items()]
    joined = left_join(rows, known.select("user_pseudo_id", "user_id"), ["user_pseudo_id"], hot=None)
    assert "Join" not in plan_text(joined)
    assert sorted(values(joined, "user_pseudo_id", "user_id")) == [(str(n), None) for n in range(5)]


def test_shuffle_files_go_with_their_write(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        names = {files.apply(n).getName() for n in range(files.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    cut = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(100):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    assert cut.count() == 7


def test_an_item_update_leaves_no_intermediates(spark, tmp_path):
    item = X.item("i1", price=1.0)
    events = X.events_frame(spark, [X.event(X.DAY1, "purchase", items=[item])])
    store = TableStore(spark, f"file://{tmp_path}/tables")
    rows = N.explode_items(events, shards.empty(spark, S.IDENTITY_MAP), [], *DAY, TZ, "b", now())
    wanted = N.items_schema([])
    with working_in(spark, f"file://{tmp_path}/work"):
        D.build_items(store, rows, wanted, None)
        built = set(tmp_path.glob("work/*"))
        D.update_items(store, rows, wanted, *[date(2026, 5, 1)] * 2, None)
        left = {path.name for path in set(tmp_path.glob("work/*")) - built if any(path.iterdir())}
        assert left == set()
    assert values(store.read(D.ITEMS_TABLE), "item_id", "item_event_no") == [("i1", 1)]


def test_items_of_known_users_are_dealt_by_session(spark):
    rows = [("a", n % 3, f"i{n % 2}", n, "purchase", 0) for n in range(12)]
    rows += [(None, None, None, n, "purchase", 0) for n in range(3)]
    names = ["user_pseudo_id", "ga_session_id", "item_id", "event_timestamp_micros", "event_name", "item_index"]
    frame = spark.createDataFrame(rows, "%s string, %s bigint, %s string, %s bigint, %s string, %s bigint" % tuple(names))
    dealt, found = N.number_items(frame, None), N.number_items(frame)
    assert sorted(map(str, values(dealt, *dealt.columns))) == sorted(map(str, values(found, *dealt.columns)))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(user_pseudo_id" in plan
    assert "item_id" not in plan.split("hashpartitioning(")[1].split(")")[0]


def write_lineitem(spark, folder, lines=40):
    """A lineitem table with sessions over many days, also without a user or an order."""
    spark.sql(f"""
        SELECT IF(id % 7 = 6, NULL, id % 5) AS l_orderkey, id % 4 AS l_partkey,
          IF(id % 11 = 10, NULL, id % 3) AS l_suppkey, CAST(id % 3 AS INT) AS l_linenumber,
          CAST(id AS DOUBLE) AS l_quantity, CAST(id * 1.5 AS DOUBLE) AS l_extendedprice, 0.5D AS l_discount,
          0.25D AS l_tax, IF(id % 2 = 0, 'A', 'N') AS l_returnflag, 'O' AS l_linestatus,
          DATE'2026-01-01' + MAKE_DT_INTERVAL(CAST(id * 9 AS INT)) AS l_shipdate
        FROM RANGE({lines})""").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("limit", ["20", "1000000"])
def test_items_are_moved_without_what_their_rows_tell(spark, tmp_path, limit):
    """The hashed event id and its like are made after the exchange, with the same result."""
    folder = write_lineitem(spark, tmp_path)
    spark.conf.set("tidemark.hotRows", limit)
    try:
        rows, columns, hot = catalog.item_frame(spark, folder, with_identity=False)
        assert (hot is None) == (limit != "20")
        want = V.conform(N.number_items(rows, hot), N.items_schema(columns))
        got = catalog.micro_items(spark, folder)
        same = [c for c in got.columns if c != "event_date"]
        assert sorted(map(str, values(got, *same))) == sorted(map(str, values(want, *same)))
        if hot is None:
            below = plan_text(got).split("RepartitionByExpression")[1]
            assert "sha2" not in below and "item_subtotal" not in below
    finally:
        spark.conf.unset("tidemark.hotRows")


@pytest.mark.parametrize("limit", [
    {}, {"tidemark.partRows": "9"}, {"tidemark.broadcastRows": "0"}, {"tidemark.partRows": "9", "tidemark.hotRows": "15"}])
def test_item_updates_go_in_parts_and_copy_other_rows_as_they_lie(spark, tmp_path, monkeypatch, limit):
    """New rows are shuffled part by part; rows outside the range are copied with moved numbers."""
    folder = write_lineitem(spark, tmp_path, 60)
    rows, columns, _ = catalog.item_frame(spark, folder, with_identity=False)
    wanted, local = N.items_schema(columns), F.to_date("event_timestamp")
    rows = rows.withColumn("event_date", F.trunc("event_date", "month"))  # days that stay beside days that change
    first, end = date(2026, 4, 10), date(2026, 9, 20)
    inside = local.between(F.lit(first), F.lit(end))
    store, whole = (TableStore(spark, str(tmp_path / name)) for name in ("part", "whole"))
    D.build_items(whole, rows, wanted, None)
    written, write = [], TableStore._write_parts

    def record(self, parts, partitions, cluster, *place):
        if place[0] == D.ITEMS_TABLE:
            written.append([(p.spread, p.rows._jdf.queryExecution().executedPlan().toString()) for p in parts])
        return write(self, parts, partitions, cluster, *place)

    monkeypatch.setattr(TableStore, "_write_parts", record)
    for key, value in limit.items():
        spark.conf.set(key, value)
    try:
        wrong = rows.where(inside & (F.col("item_index") == 0)).limit(7)  # the range holds other rows first
        D.build_items(store, rows.where(~inside).unionByName(wrong), wanted)
        D.update_items(store, rows.where(inside), wanted, first, end)
    finally:
        for key in limit:
            spark.conf.unset(key)
    for table in (D.ITEMS_TABLE, "carry_item_days"):
        got, want = (sorted(map(str, s.read(table).collect())) for s in (store, whole))
        assert got == want, table
    built, (*fresh, copies) = written
    assert (len(built) > 1) == (len(fresh) > 1) == ("tidemark.partRows" in limit)
    assert all(spread and "sha2" not in plan for spread, plan in [*built, *fresh])
    if "tidemark.broadcastRows" not in limit:
        assert not copies[0] and "Exchange hashpartitioning" not in copies[1]
