"""Whole runs: the sample data set, incremental days, evolution, failures."""

import shutil

import pytest
from pyspark.sql import functions as F

from tests import fixtures as X
from tests.test_operators import spoil
from tidemark.operators.skew import hot_groups
from tidemark.plans.batch import (
    BatchConfig,
    append_snapshot,
    current_metrics,
    recovery_list,
    run_batch,
    snapshot_run,
)
from tidemark.plans.store import TableStore
from tidemark.sources.shards import bytes_of


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """Tiny inputs spend their time compiling; skip that here (other tests compile)."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")


def config(tmp_path, start, end, **more):
    given = dict(events_path=str(tmp_path / "events"), users_path=str(tmp_path / "users"),
                 target=str(tmp_path / "out"))
    return BatchConfig(start, end, **(given | more))


def all_good(row):
    kept = [row[f"{p}_status"] for p in ("phase_0", "phase_2", "phase_3a", "phase_3b")]
    return [s.partition(":")[0].replace("PARTIAL", "SUCCESS") for s in kept] == ["SUCCESS"] * 4


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sample")
    X.write_sharded(X.events_frame(spark, X.sample_events()), root / "events")
    X.write_sharded(X.users_frame(spark, X.sample_users()), root / "users", drop=["audiences"])
    cfg = config(root, "20260501", "20260502", reset=True, incremental=False)
    return run_batch(spark, cfg).first(), TableStore(spark, cfg.target)


def test_sample_status(sample):
    row, _ = sample
    assert all_good(row), row
    assert row["phase_1_status"].startswith("SUCCESS (audience_warning")
    assert row["update_mode"] == "FULL_REBUILD"


def test_sample_event_rows(sample):
    rows = sample[1].read("micro_user_table").orderBy("event_timestamp_micros").collect()
    assert len(rows) == 4 and len(rows[0]) == 57
    got = [
        (str(r.event_date), str(r.event_timestamp)[11:], r.page_view_id, r.user_id,
         r.is_identified_user, r.is_key_event, r.session_event_no, r.user_event_no,
         r.prev_event_name, r.seconds_from_prev_event, r.customer_type) for r in rows
    ]
    one, two = "anon_user_001_10001_1", "anon_user_002_20001_1"
    member = "sample_member_001"
    assert got == [
        ("2026-05-01", "14:00:00", one, member, False, 1, 1, 1, None, None, "sample_member"),
        ("2026-05-01", "14:01:00", one, member, False, 1, 2, 2, "session_start", 60, "sample_member"),
        ("2026-05-01", "14:05:00", one, member, False, 1, 3, 3, "page_view", 240, "sample_member"),
        ("2026-05-02", "14:00:00", two, None, False, 0, 1, 1, None, None, "sample_visitor"),
    ]
    assert [r.event_id for r in rows] == [
        "f7a78c72a9a4d25655d3d71032b64c34f8a4a0e469257ce9f74ff0c8eaed1352",
        "57c08028061211e341ed2fd2d21a69db259f40bfa2d833edbc3df8f42ed5a989",
        "a3b7d2974144fda74f0b3c561151ae5b6127fe4c48fa017f781bb8af10c7181b",
        "757a11590f0b60b6131586716a2e83561bc9621f4aa343d9c82ca76609d2a109",
    ]
    host = "example.test"
    assert [r.prev_hostname_norm for r in rows] == [None, host, host, None]
    assert [r.next_hostname_norm for r in rows] == [host, host, None, None]
    assert not any(r.is_cross_domain_hop for r in rows)
    for column in ("clarity_play_url", "gclid", "max_scroll_percent", "search_term"):
        assert [r[column] for r in rows] == [None] * 4


def test_sample_item_row(sample):
    (row,) = sample[1].read("micro_items_table").collect()
    want = dict(
        item_index=0, item_event_no=1, item_id="sample_item_001", price=1200.0, quantity=1,
        item_subtotal=1200.0, ecommerce_total_value=1200.0, transaction_id="sample_tx_001",
        sample_item_type__items="subscription", is_key_event=1, user_id=None,
        is_identified_user=False,
        event_id="a3b7d2974144fda74f0b3c561151ae5b6127fe4c48fa017f781bb8af10c7181b",
    )
    assert {k: row[k] for k in want} == want


def test_sample_row_counts(sample):
    store = sample[1]
    want = {
        "mst_event_params": 10, "mst_duplicate_params_log": 0, "audit_schema_log": 0,
        "mst_item_params": 1, "mst_schema_history": 6, "log_integrated_columns": 5,
        "dim_user_map_180d": 0, "mst_pseudonymous_properties": 1, "log_pseudonymous_users": 2,
        "log_audience_membership": 0, "log_user_properties": 4, "mst_user_properties": 1,
        "log_batch_execution": 1,
    }
    assert {t: store.read(t).count() for t in want} == want
    assert store.read("log_batch_execution").first()["total_rows"] == 4
    summary = store.read("mst_user_properties").first()
    assert (summary.resolved_type, summary.unique_users, summary.total_records) == ("STRING", 2, 4)


def day_rows(day_index, shard, users=6):
    """A day's events: crossing sessions, scrolls, copies, host changes, NULL sessions."""
    start = X.DAY1 + day_index * 86_400_000_000
    rows = []
    for u in range(users):
        for i in range(9):
            name = ["session_start", "page_view", "scroll", "page_view", "cv_lead", "search",
                    "page_view", "scroll", "purchase"][i]
            if name == "purchase" and u % 2:
                name = "page_view"
            params = [("depth", X.value(integer=i)), ("score", X.value(number=i / 2))]
            if name == "scroll":
                params.append(("percent_scrolled", X.value(integer=30 + 30 * (i % 2 + u % 2))))
            session = None if u == 5 else 100 + u + (day_index if u % 3 else 0)
            items = [X.item(f"i{i % 2}", 2.5, 2), X.item("i9", 1.0)] if name == "purchase" else []
            rows.append(
                X.event(start + u * 7_000_000 + i * 61_500_000, name, f"u{u}", session, shard,
                        params, [X.prop(start)], items, f"www.{'AB'[(u + i) % 2]}.test",
                        f"m{u}" if u == 1 and i == 0 else None)
            )
    return rows + rows[3:5]


SHARDS = ["20260501", "20260502", "20260503"]


@pytest.fixture(scope="module")
def three_days(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("days")
    rows = [r for i, shard in enumerate(SHARDS) for r in day_rows(i, shard)]
    X.write_sharded(X.events_frame(spark, rows), root / "events")
    users = [
        X.user(f"u{u}", None, X.DAY1, X.DAY1, [("s1", "tier level", X.DAY1, f"t{u}")],
               audiences=[(u, "aud", X.DAY1, None, True)]) for u in range(4)
    ]
    X.write_sharded(X.users_frame(spark, users), root / "users")
    return root


VOLATILE = ["updated_at", "batch_id", "created_at"]


def content(store, table):
    frame = store.read(table)
    kept = [c for c in sorted(frame.columns) if c not in VOLATILE]
    return sorted(map(str, frame.select(*kept).collect()))


def same(left, right, table):
    a, b = content(left, table), content(right, table)
    assert len(a) == len(b)
    assert [x for x, y in zip(a, b) if x != y] == []


def run_days(spark, root, name, days, **more):
    cfg = None
    for day in days:
        cfg = config(root, day, day, **({"target": str(root / name)} | more))
        row = run_batch(spark, cfg).first()
        assert all_good(row), row
    return TableStore(spark, cfg.target)


def build(spark, root, name, **more):
    cfg = config(root, SHARDS[0], SHARDS[-1], incremental=False, target=str(root / name), **more)
    row = run_batch(spark, cfg).first()
    assert all_good(row), row
    return TableStore(spark, cfg.target)


# per-run values: page numbers restart, key sessions and identities are those of the run's days
RESTARTING = ["page_view_id", "max_scroll_percent", "is_key_event", "user_id",
              "is_identified_user"]


def numbered(store):
    frame = store.read("micro_user_table").drop(*VOLATILE, *RESTARTING)
    return sorted(map(str, frame.collect()))


def test_days_equal_full_build(spark, three_days):
    """Sessions that cross days differ only where the page number restarts per run."""
    full = build(spark, three_days, "full")
    daily = run_days(spark, three_days, "daily", SHARDS)
    same(full, daily, "micro_items_table")
    for table in ("mst_event_params", "log_user_properties", "log_audience_membership",
                  "mst_user_properties", "dim_user_map_180d"):
        same(full, daily, table)
    assert numbered(full) == numbered(daily)
    assert full.read("micro_user_table").agg(F.max("user_event_no")).first()[0] == 21

    before = {t: content(daily, t) for t in ("micro_user_table", "micro_items_table")}
    again = run_days(spark, three_days, "daily", [SHARDS[1]])
    for table, rows in before.items():
        assert content(again, table) == rows
    runs = again.read("log_batch_execution")
    assert runs.count() == 4


def test_a_day_reads_no_history(spark, three_days, tmp_path):
    """With the first day's wide rows, event tables and events unreadable, the third day still runs."""
    shutil.copytree(three_days / "daily", tmp_path / "out")
    before = TableStore(spark, str(three_days / "daily"))
    for table in ("micro_user_table", "micro_items_table", "event_tables"):
        days = list((tmp_path / "out" / table).rglob("event_date=2026-05-01"))
        assert days
        for day in days:
            spoil(day)
    store = run_days(spark, three_days, "x", [SHARDS[2]], target=str(tmp_path / "out"))
    late = F.col("event_date") > F.lit("2026-05-01").cast("date")
    for table in ("micro_user_table", "micro_items_table"):
        old, new = (s.read(table).where(late).drop(*VOLATILE) for s in (before, store))
        assert sorted(map(str, old.collect())) == sorted(map(str, new.collect()))
    runs = store.read("log_batch_execution").orderBy(F.col("executed_at").desc()).first()
    assert runs["total_rows"] == before.read("micro_user_table").count()


def test_hot_users_change_nothing(spark, three_days):
    """With every user hot, the daily runs give what the ordinary daily runs gave."""
    plain = TableStore(spark, str(three_days / "daily"))
    spark.conf.set("tidemark.hotRows", "10")
    try:
        hot = run_days(spark, three_days, "hot", SHARDS)
    finally:
        spark.conf.unset("tidemark.hotRows")
    for table in ("micro_user_table", "micro_items_table", "event_tables", "log_user_properties"):
        same(plain, hot, table)


def test_removed_day_vanishes(spark, tmp_path):
    """A re-run over a day whose events are gone empties it and relinks its neighbours."""
    rows = [r for i, shard in enumerate(SHARDS) for r in day_rows(i, shard)]
    X.write_sharded(X.events_frame(spark, rows), tmp_path / "events")
    more = dict(users_path=None)
    build(spark, tmp_path, "out", **more)
    gone = [r for r in rows if not (r[0] == SHARDS[1] and r[4] != "u3")]
    X.write_sharded(X.events_frame(spark, gone), tmp_path / "events2")
    more["events_path"] = str(tmp_path / "events2")
    changed = run_days(spark, tmp_path, "out", [SHARDS[1]], **more)
    expected = build(spark, tmp_path, "fresh", **more)
    same(changed, expected, "micro_items_table")
    assert numbered(changed) == numbered(expected)
    days = [s.read("event_tables").groupBy("event_date", "event_name").count().collect()
            for s in (changed, expected)]
    assert sorted(map(str, days[0])) == sorted(map(str, days[1]))


def test_types_widen_over_runs(spark, tmp_path):
    def day(i, shard, value):
        start = X.DAY1 + i * 86_400_000_000
        return [X.event(start, "page_view", "u", 1, shard, [("grade", value)] +
                        ([("fresh", X.value(text="x"))] if i else []))]

    rows = day(0, SHARDS[0], X.value(integer=3)) + day(1, SHARDS[1], X.value(number=2.5)) + day(
        2, SHARDS[2], X.value(text="high"))
    X.write_sharded(X.events_frame(spark, rows), tmp_path / "events")
    kinds = []
    for shard in SHARDS:
        store = run_days(spark, tmp_path, "out", [shard], users_path=None)
        kinds.append(store.columns("micro_user_table")["grade"])
    assert kinds == ["bigint", "double", "string"]
    got = store.read("micro_user_table").orderBy("event_timestamp_micros").select("grade", "fresh")
    assert [tuple(r) for r in got.collect()] == [("3.0", None), ("2.5", "x"), ("high", "x")]
    reasons = [r.reason for r in store.read("mst_schema_history").where("column_name = 'grade'").collect()]
    assert sum("integers became floating-point" in r for r in reasons) == 1
    assert sum("FLOAT64 became text" in r for r in reasons) == 1


def test_lost_values_are_counted_by_event(spark, tmp_path):
    """Of three events one brings values that its registered type does not hold."""
    good, odd = X.value(integer=3), X.value(number=1e300)
    rows = [X.event(X.DAY1, "page_view", "u", 1, SHARDS[0], [("level", good)]),
            X.event(X.DAY1 + 1, "level_up", "u", 1, SHARDS[0], [("level", odd)]),
            X.event(X.DAY1 + 2, "level_up", "u", 1, SHARDS[0], [("level", good)]),
            X.event(X.DAY1 + 3, "search", "u", 1, SHARDS[0], [("search_term", X.value(text="t"))])]
    X.write_sharded(X.events_frame(spark, rows), tmp_path / "events")
    cfg = config(tmp_path, SHARDS[0], SHARDS[0], users_path=None)
    row = run_batch(spark, cfg).first()
    assert row["phase_2_status"] == "PARTIAL: failed=level_up(1)"
    assert row["phase_3a_status"] == row["phase_3b_status"] == "SUCCESS"
    store = TableStore(spark, cfg.target)
    (lost,) = store.read("log_failed_values").collect()
    assert (lost.event_name, lost.param_name, lost.data_type, lost.lost) == ("level_up", "level", "INT64", 1)
    assert store.read("micro_user_table").count() == 4


def test_odd_values_and_names_stop_nothing(spark, tmp_path):
    def day(i, shard):
        start = X.DAY1 + i * 86_400_000_000
        odd = [("level", X.value(number=1e300)), ("score", X.value(number=float("nan"))),
               ("quantity", X.value(number=-1e19)), ("a.b", X.value(text="dot")),
               ("tick`y", X.value(text="tick")), ("Grade", X.value(text="x")),
               ("is_key_event", X.value(text="mine"))]
        return [X.event(start, "page_view", "u", 1, shard, odd),
                X.event(start + 5, "scroll", "u", 1, shard, [("grade", X.value(text="y"))])]

    rows = [r for i, shard in enumerate(SHARDS) for r in day(i, shard)]
    X.write_sharded(X.events_frame(spark, rows), tmp_path / "events")
    store = run_days(spark, tmp_path, "out", SHARDS, users_path=None)
    got = store.read("micro_user_table").where("event_name = 'page_view'").collect()
    assert len(got) == len(SHARDS)
    for r in got:
        assert (r["a.b"], r["tick`y"], r["level"], r["score"]) == ("dot", "tick", None, None)
        assert r["is_key_event"] in (0, 1, False, True)
    logged = [r.column_name for r in store.read("mst_schema_history").collect()]
    assert len(logged) == len(set(logged)) and "is_key_event" not in logged
    assert sum(name.lower() == "grade" for name in logged) == 1


def test_two_runs_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    X.write_sharded(X.events_frame(spark, X.sample_events()), tmp_path / "events")
    X.write_sharded(X.users_frame(spark, X.sample_users()), tmp_path / "users")
    configs = [config(tmp_path, "20260501", "20260502", target=str(tmp_path / name), incremental=False)
               for name in ("one", "two")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(lambda c: run_batch(spark, c).first(), configs))
    assert all(all_good(row) for row in found)
    for c in configs:
        assert TableStore(spark, c.target).read("micro_user_table").count() == 4
        assert not list((tmp_path / "one" / "_work").glob("*"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_reset_without_parameters_keeps_the_state(spark, tmp_path):
    X.write_sharded(X.events_frame(spark, X.sample_events()), tmp_path / "events")
    assert all_good(run_batch(spark, config(tmp_path, "20260501", "20260502", users_path=None)).first())
    X.write_sharded(X.events_frame(spark, [X.event(X.DAY1, "page_view", session=None)]), tmp_path / "bare")
    bare = config(tmp_path, "20260501", "20260501", events_path=str(tmp_path / "bare"), reset=True)
    assert run_batch(spark, bare).first()["phase_0_status"].startswith("FAILED")
    store = TableStore(spark, str(tmp_path / "out"))
    assert store.read("mst_event_params").count() > 0 and store.exists("event_tables")
    assert store.read("log_batch_execution").count() == 2


def test_shuffle_size_follows_the_days_read(spark, tmp_path):
    rows = [X.event(X.DAY1 + i, "page_view", shard=f"2026050{d}") for d in range(1, 10) for i in range(5)]
    X.write_sharded(X.events_frame(spark, rows), tmp_path / "events")
    path = str(tmp_path / "events")
    whole, one = bytes_of(spark, path, "20260501", "20260509"), bytes_of(spark, path, "20260503", "20260503")
    assert 0.1 < one / whole < 0.13 and bytes_of(spark, path, "20250101", "20250102") == 0


def test_hot_after_explode_only(spark):
    rows = [X.event(X.DAY1 + i, "purchase", f"u{i % 3}", items=[X.item("i1")] * (30 if i % 3 else 1))
            for i in range(9)]
    events = X.events_frame(spark, rows)
    spark.conf.set("tidemark.hotRows", "20")
    try:
        assert hot_groups(events, ["user_pseudo_id"]) is None
        found = hot_groups(events, ["user_pseudo_id"], F.size("items"))
        assert {r[0] for r in found.frame.select("user_pseudo_id").collect()} == {"u1", "u2"}
    finally:
        spark.conf.unset("tidemark.hotRows")


def test_raw_scroll_percent(spark, tmp_path):
    rows = [X.event(X.DAY1, "page_view"),
            X.event(X.DAY1 + 1_000_000, "scroll", params=[("percent_scrolled", X.value(integer=90))])]
    X.write_sharded(X.events_frame(spark, rows), tmp_path / "events")
    cfg = config(tmp_path, "20260501", "20260501", users_path=None, raw_scroll_percent=True)
    assert all_good(run_batch(spark, cfg).first())
    found = TableStore(spark, cfg.target).read("micro_user_table").collect()
    assert [r.max_scroll_percent for r in found] == [90]


def test_missing_source_is_skipped(spark, tmp_path):
    row = run_batch(spark, config(tmp_path, "20260501", "20260501")).first()
    assert row["phase_0_status"].startswith("SKIPPED") and row["update_mode"].startswith("ABORTED")
    store = TableStore(spark, str(tmp_path / "out"))
    assert store.read("log_batch_execution").first()["total_rows"] == 0


def test_events_without_params_fail(spark, tmp_path):
    X.write_sharded(X.events_frame(spark, [X.event(X.DAY1, "page_view")]), tmp_path / "events")
    row = run_batch(spark, config(tmp_path, "20260501", "20260501")).first()
    assert row["phase_0_status"].startswith("FAILED") and row["phase_3a_status"] == "SKIPPED"


def test_snapshot_log(spark, sample, tmp_path):
    store = TableStore(spark, str(tmp_path / "out"))
    empty = current_metrics(store)
    assert set(empty.values()) == {None}
    after = current_metrics(sample[1])
    assert after["micro_user_columns_cnt"] == 57 and after["mst_event_params_cnt"] == 10
    append_snapshot(store, config(tmp_path, "20260501", "20260501"), "daily", None, empty, after)
    row = store.read("log_daily_batch_schema_snapshot").first()
    assert row.pre_change_fields == "" and len(row.post_change_fields.split(",")) == 4


def test_snapshots_are_read_back_and_skipped_days_recovered(spark, tmp_path):
    events = str(tmp_path / "events")
    store = TableStore(spark, str(tmp_path / "out"))
    for day in ("20260502", "20260501", "20260420"):  # nothing there yet
        run_batch(spark, config(tmp_path, day, day, users_path=None))
    assert recovery_list(store, events, "20260503") == []
    X.write_sharded(X.events_frame(spark, X.sample_events()), tmp_path / "events")
    assert recovery_list(store, events, "20260503") == ["20260501", "20260502"]
    cfg = config(tmp_path, "20260501", "20260501", users_path=None)
    before = current_metrics(store)
    assert all_good(run_batch(spark, cfg).first())
    snapshot_run(store, cfg, "daily", before)
    assert recovery_list(store, events, "20260503") == ["20260502"]
    snapshot_run(store, cfg, "daily", current_metrics(store))
    rows = store.read("log_daily_batch_schema_snapshot").orderBy("snapshot_at").collect()
    assert [(r.pre_change_fields, r.post_change_fields == "") for r in rows] == [("", False), ("", True)]
    assert "mst_event_params_cnt" in rows[0].post_change_fields
