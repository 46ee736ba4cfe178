"""Exact dedup, repeated passages, near copies."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import exact_dedup, near_dedup, substring_dedup, suffix_array_dedup
from tidemark.llm.work import connected, with_rank


@pytest.mark.parametrize("short_hash", [False, True])
def test_exact(docs, rows, short_hash):
    hashed = {"hashed": lambda c: F.substring(F.md5(c), 1, 1)} if short_hash else {}
    for keep, chosen in (("largest", max), ("smallest", min)):
        same = {}
        for doc, text in rows:
            same.setdefault(text or "", []).append(doc)
        got = {r.doc_id: tuple(r)[1:] for r in exact_dedup.groups(docs, keep, **hashed).collect()}
        assert got == {
            doc: (chosen(same[text or ""]), len(same[text or ""]), doc == chosen(same[text or ""]),
                  brute.sha(text or ""))
            for doc, text in rows
        }


def test_exact_null_and_repeated_ids(spark):
    rows = [(None, "x"), (1, "x"), (1, "x"), (None, "y"), (2, "z")]
    found = exact_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()) == Counter(
        [(None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True), (None, None, 1, True), (2, 2, 1, True)]
    )


def test_deduplicate_passes_columns_through(clashing):
    kept = exact_dedup.deduplicate(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len({r.text or "" for r in clashing.collect()})


@pytest.mark.parametrize("operator, length, gram, options", [
    (substring_dedup, 20, 6, {}), (substring_dedup, 20, 6, {"most_variants": 2}),
    (suffix_array_dedup, 50, 16, {}), (suffix_array_dedup, 20, 6, {"most_variants": 2}),
    (suffix_array_dedup, 5, 5, {}), (substring_dedup, 3, 1, {}),
])
def test_repeats(docs, rows, operator, length, gram, options):
    want = brute.repeats(rows, length)
    assert sum(n for _, n, _ in want.values()) > 500
    got = {r.doc_id: (r.n_words, r.n_removed, r.text)
           for r in operator.deduplicate(docs, length, gram, **options).collect()}
    assert got == want


def test_repeats_with_null_and_repeated_ids(spark, passage):
    text = lambda k: f"{k} {passage}"
    rows = [(5, text("a")), (5, text("b")), (5, text("b")), (None, text("c")), (None, None)]
    found = substring_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # the null id is first; twins are judged alike
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in found) == [
        (0, 0, 0), (0, 71, 0), (5, 71, 70), (5, 71, 70), (5, 71, 70)
    ]


def test_repeats_keep_clashing_columns(clashing):
    found = suffix_array_dedup.deduplicate(clashing)
    assert set(found.columns) == {*clashing.columns, "n_removed"}
    assert found.select("`x.y`").distinct().count() == 1 and found.count() == clashing.count()


def test_remove_reference(spark, docs, rows, passage):
    reference = spark.createDataFrame([(passage,), (None,)], "text string")
    got = {r.doc_id: r.text for r in substring_dedup.remove_reference(docs, reference).collect()}
    for doc, text in rows:
        words = brute.SPACE.findall(text or "")
        assert got[doc] == " ".join(words).replace(passage, "").replace("  ", " ").strip()


def test_automaton_gives_matching_statistics():
    rng = random.Random(1)
    for _ in range(200):
        texts = [[rng.choice("ab").encode() for _ in range(rng.randrange(12))] for _ in range(4)]
        automaton = substring_dedup.SuffixAutomaton()
        for text in texts[:-1]:
            automaton.add(text)
        inside = {tuple(t[i:j]) for t in texts[:-1] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        probe = texts[-1]
        want = [max((n for n in range(1, e + 1) if tuple(probe[e - n : e]) in inside), default=0)
                for e in range(1, len(probe) + 1)]
        assert list(automaton.statistics(probe)) == want


@pytest.mark.parametrize("node_rows", [512, 4])
def test_near(docs, rows, node_rows):
    want = {d: (n, c, d == c) for d, (n, c) in brute.components(rows).items()}
    assert sum(not k for _, _, k in want.values()) > 40
    got = {r.doc_id: tuple(r)[1:] for r in near_dedup.components(docs, node_rows=node_rows).collect()}
    assert got == want


def test_near_chain_and_borderline(spark):
    # neighbours share 96 of 100 words in order, ends of the chain are not linked
    words = [f"v{i}" for i in range(260)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(40)]
    rows += [(100, " ".join(f"u{i}" for i in range(11))), (101, " ".join(f"u{i}" for i in range(12))[0:])]
    rows += [(200, " ".join(f"z{i}" for i in range(14))), (201, " ".join(f"z{i}" for i in range(17)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.components(docs).collect()}
    assert got == brute.components(rows)


def test_near_null_and_repeated_ids(spark, rows):
    text = rows[60][1]
    given = [(None, text), (9, text), (9, text + " end"), (3, text), (4, None), (4, "")]
    found = near_dedup.components(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(
        [(None, None, True), (9, 3, False), (9, 3, False), (3, 3, True), (4, 4, True), (4, 4, True)]
    )


def test_near_passes_columns_through(clashing):
    assert near_dedup.deduplicate(clashing).columns == clashing.columns


def test_empty_tables(empty):
    assert exact_dedup.groups(empty).count() == 0
    assert substring_dedup.report(empty).count() == 0
    assert suffix_array_dedup.report(empty).count() == 0
    assert near_dedup.components(empty).count() == 0
    assert near_dedup.deduplicate(empty).columns == empty.columns


def test_connected(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(500, 500)]
    parent = {n: n for e in edges for n in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}


def test_rank_has_no_gaps(spark, monkeypatch):
    from tidemark.llm import work

    monkeypatch.setattr(work, "RANK_BLOCK_ROWS", 40)
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    found = with_rank(rows.withColumn("g", F.when(F.col("g") > 0, 1)), "g", ["id"], "r").collect()
    for g in (None, 1):
        ranks = sorted(r.r for r in found if r.g == g)
        assert ranks == list(range(len(ranks)))
