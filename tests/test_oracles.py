"""Every registered query against its SQL twin on DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog

SF = "/root/testdata/sf0.01"
SMALL_SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def duck():
    return connect(SF)


@pytest.fixture(scope="session")
def small_duck():
    return connect(SMALL_SF)


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def assert_equal_to_sql(name, spark, duck, folder=SF):
    frame = entry.queries()[name](spark, folder)
    got = [tuple(row) for row in frame.collect()]
    cursor = duck.execute(entry.oracle_sql()[name])
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(frame.columns) == sorted(want_names)
    assert len(got) > 0
    left, right = rows_by_name(frame.columns, got), rows_by_name(want_names, want)
    assert len(left) == len(right)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    assert not different, f"{sorted(frame.columns)}: {len(different)} rows, first {different[0]}"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(name, spark, duck):
    assert_equal_to_sql(name, spark, duck)


HOT_AWARE = {
    # about half of the users, and of the suppliers, count as hot at these limits
    "page_view_id": 66, "event_sequence": 66, "domain_hops": 66, "event_table": 66,
    "assemble_events": 66, "fold_scroll": 66, "fill_slots": 66, "micro_user": 66,
    "user_property_log": 66, "audience_log": 1, "explode_items": 600, "number_items": 600,
    "micro_items": 600,
}


@pytest.mark.parametrize("name", sorted(HOT_AWARE))
def test_hot_groups_change_nothing(name, spark, small_duck):
    spark.conf.set("tidemark.hotRows", str(HOT_AWARE[name]))
    try:
        assert_equal_to_sql(name, spark, small_duck, SMALL_SF)
    finally:
        spark.conf.unset("tidemark.hotRows")


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
