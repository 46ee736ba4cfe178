"""Rows with repeated ids, rows that repeat, and awkward column names lose nothing."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, exact_dedup, near_dedup, sharding, substring_dedup, toxicity

LONG = " ".join(f"w{i}" for i in range(60))
NEAR = LONG + " more"
ROWS = [(5, "a b c"), (5, "d e f"), (9, "a b c"), (9, "a b c"), (None, "d e f"), (7, LONG), (8, NEAR),
        (8, "unique text of a repeated id"), (None, "alone")]


@pytest.fixture(scope="module")
def repeated(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize(("keep", "want"), [
    ("largest", [(9, "a b c"), (5, "d e f")]), ("smallest", [(5, "a b c"), (5, "d e f")])])
def test_exact_keeps_one_row_of_each_text(repeated, keep, want):
    got = [tuple(r) for r in exact_dedup.deduplicate(repeated, keep).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [*want, *ROWS[5:]]))


def test_near_keeps_every_unique_text(repeated):
    got = [tuple(r) for r in near_dedup.deduplicate(repeated).collect()]
    texts = sorted(t for _, t in got)
    assert len(texts) == len(set(texts)) == 5
    assert {"a b c", "d e f", "alone", "unique text of a repeated id"} < set(texts)


def test_toxic_rows_go_one_by_one(spark):
    rows = [(i, f"nice calm words number {i % 7}" + (" scumwort" if i % 2 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    more = [(2, "nice calm words scumwort"), (3, "nice calm words")]
    docs = spark.createDataFrame(rows + more, "doc_id long, text string")
    got = {tuple(r) for r in toxicity.reject(docs, labels).collect()}
    assert got == {r for r in rows + more if "scumwort" not in r[1]}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, LONG if i % 2 else f"text {i}") for i in range(6)]
    names = ["__gone__", "__id__", "__marks__", "__n_words__", "__block__", "__hit_words__", "_row", "_gone"]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({n: F.lit(n) for n in names})
    inner = F.struct(F.lit(1).alias("a b"), F.lit("x").alias("c-d"), F.lit("y").alias("e`f"))
    frame = frame.withColumn("s", inner).withColumn("i", F.lit(1))
    return frame.withColumnsRenamed({"i": "tick`s"})


@pytest.mark.parametrize("name", ["exact", "near", "toxic", "documents", "spans", "strip", "shard"])
def test_awkward_columns_pass_through(spark, odd, name):
    items = spark.createDataFrame([("q", "text 2")], "item_id string, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    run = {
        "exact": lambda: exact_dedup.deduplicate(odd), "near": lambda: near_dedup.deduplicate(odd),
        "toxic": lambda: toxicity.reject(odd, labels),
        "documents": lambda: decontamination.remove_documents(odd, items),
        "spans": lambda: decontamination.remove_spans(odd, items),
        "strip": lambda: substring_dedup.deduplicate(odd), "shard": lambda: sharding.shard(odd, 3),
    }[name]
    got = run()
    assert set(odd.columns) <= set(got.columns)
    rows = got.collect()
    if name == "toxic":  # without a labelled sample every score is one half, which is rejected
        return
    assert {r["__block__"] for r in rows} == {"__block__"} and {r["tick`s"] for r in rows} == {1}
    assert {r["s"]["a b"] for r in rows} == {1} and {r["s"]["e`f"] for r in rows} == {"y"}
    assert len(rows) == {"exact": 4, "near": 4, "documents": 5}.get(name, 6)
