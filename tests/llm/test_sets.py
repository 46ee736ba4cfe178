"""Resampling, Merkle manifest, mixing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.conftest import SF
from tests.test_oracles import assert_equal_to_sql, connect
from tidemark.llm import merkle, mixing, resampling
from tidemark.llm.work import table


def by_text(rows):
    return sorted(map(str, rows))


# -- resampling ------------------------------------------------------------------------------


def test_matrix_crcs():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = rng.integers(0, 4000, 700)
    lengths = rng.choice([0, 1, 2, 7, 8, 31, 900], 700)
    want = [zlib.crc32(data[s : s + n]) for s, n in zip(starts, lengths)]
    assert resampling.slice_crcs(data, starts, lengths).tolist() == want


def test_resampling(spark, rows, passage):
    given = [*rows, (7000, rows[12][1]), (30, rows[17][1]), (30, rows[17][1]), (None, passage), (None, passage)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    texts = [passage, None, "", "The Kiesel, NAÏVE été", passage.upper()]
    target = spark.createDataFrame([(t,) for t in texts], "text string")
    want = brute.resampling(given, texts, percent=30)
    got = [tuple(r) for r in resampling.ranked(docs, target, percent=30).collect()]
    assert by_text(got) == by_text(want)
    drawn = {r[0] for r in want if r[4]}
    assert len(drawn) > 5
    assert {r.doc_id for r in resampling.resample(docs, target, percent=30).collect()} == drawn


def test_resampling_cases(spark, docs, empty, clashing, passage):
    target = spark.createDataFrame([(passage,)], "text string")
    nothing = target.limit(0)
    assert resampling.ranked(empty, target).collect() == []
    assert resampling.resample(empty, target).collect() == []
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    alone = [tuple(r) for r in resampling.ranked(docs, nothing).collect()]
    assert by_text(alone) == by_text(brute.resampling(rows, []))
    odd = clashing.withColumnsRenamed({"a": "found", "b": "a`b", "hash": "score"})
    kept = resampling.resample(odd, target, percent=50)
    assert kept.columns == odd.columns and 0 < kept.count() < odd.count()


@pytest.mark.parametrize("name", ["op11_resampling", "op12_merkle_manifest"])
def test_twins_on_small_tables(name, spark):
    assert_equal_to_sql(name, spark, connect(SF), SF)


# -- Merkle manifest -------------------------------------------------------------------------

LEAVES = "doc_id long, source string, lang string, n_chars long, text string"


def leaves_of(langs):
    rng = random.Random(3)
    rows = []
    for lang, n in langs.items():
        for _ in range(n):
            text = rng.choice([None, "", "x:1-", "straße 😀", "word " * rng.randrange(40)])
            n_chars = rng.choice([None, 0, 17, -1])
            rows.append((rng.randrange(10**6), rng.choice(["s", None, "2:a"]), lang, n_chars, text))
    rows += [rows[0], (rows[0][0], "other", rows[0][2], 5, "same id"), (None, None, "en", None, None)]
    return rows


@pytest.mark.parametrize(
    ("fanout", "block"), [(2, 4096), (2, 2), (2, 4), (3, 3), (4, 16)],
    ids=lambda v: str(v),
)
def test_merkle(spark, monkeypatch, fanout, block):
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", block)
    sizes = {None: 1, "en": 83, "de": 32, "fr": 17, "é": 2, "Z": 3, "zh": 1, "": 5}
    rows = leaves_of(sizes)
    docs = spark.createDataFrame(rows, LEAVES).repartition(4)
    got = [tuple(r) for r in merkle.verify(docs, fanout).collect()]
    assert by_text(got) == by_text(brute.merkle(rows, fanout))
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_merkle_one_leaf_and_none(spark, empty):
    row = (5, "s", "en", 3, "abc")
    one = merkle.manifest(spark.createDataFrame([row], LEAVES)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified
    assert one.proof_sha256 == brute.sha("")
    assert merkle.verify(spark.createDataFrame([], LEAVES)).collect() == []


def test_merkle_extra_columns(spark):
    rows = leaves_of({"en": 9, "de": 4})
    names = ["tree", "leaf", "other", "place", "block", "path", "node", "_part", "x.y"]
    wide = spark.createDataFrame(
        [(*r, *[1] * len(names)) for r in rows], LEAVES + "".join(f", `{n}` int" for n in names)
    )
    assert by_text(tuple(r) for r in merkle.verify(wide).collect()) == by_text(brute.merkle(rows))


# -- mixing ----------------------------------------------------------------------------------


def test_permutation():
    for n in (1, 2, 3, 10, 257, 4096):
        x, sizes = np.arange(n), np.full(n, n)
        key = mixing.keys(42, np.full(n, 3), np.full(n, 1))
        there = mixing.permute(x, sizes, key)
        assert sorted(there) == list(range(n))
        assert (mixing.permute(there, sizes, key, inverse=True) == x).all()
        if n == 4096:
            assert (there == x).sum() < 10  # about one place stays by chance
            other = mixing.permute(x, sizes, mixing.keys(42, np.full(n, 3), np.full(n, 2)))
            assert (there == other).sum() < 10


def mixed_rows():
    rng = random.Random(9)
    sizes = {"big": 300, "b": 40, "c": 3, "é": 5, "d": 25, None: 4, "none": 2, "tail": 60}
    rows, doc = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 40))]
            rows.append((doc, source, "\t ".join(words) if source != "none" else rng.choice([None, " "])))
            doc += 1
    rows.append((doc, "big", " ".join(f"long{i}" for i in range(3000))))
    rows += [rows[0], (rows[1][0], "b", "same id in another source"), (None, "b", "no id"), (doc + 1, "big", "")]
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    rows = mixed_rows()
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)


@pytest.mark.parametrize("block", [7, 64, 100_000])
def test_mixing_report(mixed, block):
    rows, docs = mixed
    got = mixing.report(docs, block_words=block).collect()
    again = mixing.report(docs.repartition(3), block_words=block).collect()
    assert by_text(got) == by_text(again)
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(brute.SPACE.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute.targets([sizes[s] for s in names], [i % 3 + 1 for i in range(len(names))])
    assert any(w == 3 * sizes[s] > 0 for w, s in zip(want, names))  # some source is at its limit
    assert any(w < 3 * sizes[s] for w, s in zip(want, names))
    by_size = defaultdict(set)
    for r in got:
        by_size[r.source_size].add((r.target, r.taken, r.size))
    assert Counter(r.size for r in got) == Counter(len(brute.SPACE.findall(t or "")) for _, _, t in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert len(target) == len({sizes[s] for s in names}) == len(names)  # sizes differ, so they name sources
    for s, w in zip(names, want):
        assert target[sizes[s]] == pytest.approx(w, rel=1e-12)
        assert abs(taken[sizes[s]] - w) <= 0.5


def test_mixture_holds_the_words_that_the_report_counts(mixed):
    rows, docs = mixed
    mixture = mixing.mixture(docs, block_words=16, shards=5).collect()
    report = mixing.report(docs, block_words=16, shards=5).collect()
    assert sum(r.used for r in mixture) == sum(r.taken for r in report)
    texts = defaultdict(list)
    for doc, source, text in rows:
        texts[doc, source].append(brute.SPACE.findall(text or ""))
    for r in mixture:
        words = r.text.split(" ")
        assert len(words) == r.used
        assert any(w[r.from_word : r.from_word + r.used] == words for w in texts[r.doc_id, r.source])
    assert {r.shard for r in mixture} == set(range(5))
    in_slot = Counter()
    for r in mixture:
        in_slot[r.source, r["pass"], r.block] += r.used
    assert max(in_slot.values()) == 16


def test_mixing_cases(spark, empty, clashing):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.report(none).collect() == [] and mixing.mixture(none).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "a", " ")], none.schema)
    assert [tuple(r)[1:] for r in mixing.report(blank).collect()] == [(0, 0, 0.0, 0)] * 2
    wide = clashing.withColumnsRenamed({"a": "source", "b": "number", "hash": "target", "rid": "_part"})
    wide = wide.withColumn("source", wide["doc_id"].cast("string").substr(1, 1))
    assert sum(r.taken for r in mixing.report(wide).collect()) > 0


def test_mixing_by_named_weights(spark):
    docs = spark.createDataFrame(
        [(i, "ab"[i % 2], " ".join(["w"] * 50)) for i in range(200)], "doc_id long, source string, text string"
    )
    weights = spark.createDataFrame([("a", 3.0)], "source string, weight double")
    got = mixing.report(docs, source_weights=weights).collect()
    assert {(r.doc_id % 2, r.target) for r in got} == {(0, 10_000.0), (1, 0.0)}
    assert sum(r.taken for r in got) == 10_000
