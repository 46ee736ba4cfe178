"""Token files, packing, and the whole pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SF
from tidemark.llm import packing, token_files, tokens
from tidemark.llm.work import table


def test_encoding_by_words_is_exact(rows, ids_of):
    odd = ["don't I'll 'Twas x's", "ẞ ŒUVRE œ Σίσυφος ς", "étude é ﬁ", "<|endoftext|> a<|startoftext|>b",
           "1234 12.5% a1b2", "\x1ca\x1fb\x85c d", "日本語 テスト", "#$%&*()---... \"q\"", "İstanbul",
           "a\rb\x0bc\x0cd", "naïve-ly (x)", "ÀÉ÷× ß", "don’t"]
    rng = random.Random(4)
    signs = "abÉß .,'’-1\n\t\x1c <|>ſİ́"
    odd += ["".join(rng.choice(signs) for _ in range(12)) for _ in range(2000)]
    texts = [t or "" for _, t in rows] + odd
    found = tokens.encoded(pa.array(texts), tokens.default_vocabulary())
    assert all(f.tolist() == ids_of(t) for f, t in zip(found, texts, strict=True))


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, top in ((0, 0), (1, 0), (1, 10**12), (5000, 10), (9000, 10**9), (300, 2**40)):
        values = np.sort(rng.integers(0, top + 1, n))
        made = token_files.EliasFano.of(values)
        again = token_files.EliasFano.read(made.shape(), b"".join(made.parts()))
        assert again.select(0, n).tolist() == values.tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert again.select(a, b).tolist() == values[a:b].tolist()
        if n >= 300:
            bits = 8 * sum(map(len, made.parts()))
            assert bits <= n * (3 + max(0, np.log2(top / n))) * 1.05 + 2 * 4096


def check_files(got, rows, ids_of):
    start = 0
    assert [r.doc_id for r in got] == [d for d, _ in rows]
    for r, (_, text) in zip(got, rows, strict=True):
        ids = [*ids_of(text), 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), brute.crc_of_ids(ids))
        start += len(ids)


def test_files_round_trip(docs, rows, ids_of):
    got = sorted(token_files.round_trip(docs).collect(), key=lambda r: r.start)
    check_files(got, sorted(rows), ids_of)


def test_files_with_null_and_repeated_ids(spark, ids_of, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "READ_DOCS", 3)
    rows = [(None, "b"), (None, "a"), (-5, "x y"), (7, "a"), (7, "a"), (7, "c d e"), (10**15, None)]
    frame = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    manifest = token_files.write(frame, str(tmp_path))
    got = sorted(token_files.read(spark, str(tmp_path), manifest, with_ids=True).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    check_files(got, ordered, ids_of)
    assert [r.ids for r in got] == [[*ids_of(t), 1] for _, t in ordered]


def check_packing(got, rows, ids_of, capacity=2048):
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for doc, text in rows:
        ids = [*ids_of(text), 0]
        assert sorted(by_doc.pop(doc)) == [
            (k, s, len(ids[s : s + capacity]), brute.crc_of_ids(ids[s : s + capacity]))
            for k, s in enumerate(range(0, len(ids), capacity))
        ]
    assert not by_doc
    in_sequence = {}
    for r in got:
        in_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in in_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(in_sequence)


@pytest.mark.parametrize("capacity", [2048, 100, 3])
def test_packing(docs, rows, ids_of, capacity):
    n = check_packing(packing.report(docs, capacity).collect(), rows, ids_of, capacity)
    assert n == len(best_fit([len(ids_of(t)) + 1 for _, t in rows], capacity))


def best_fit(lengths, capacity):
    """Best-fit decreasing, one document at a time."""
    pieces = [min(capacity, n - s) for n in lengths for s in range(0, n, capacity)]
    gaps = []
    for piece in sorted(pieces, reverse=True):
        fits = [g for g in gaps if g >= piece]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - piece)
        else:
            gaps.append(capacity - piece)
    return gaps


def test_plan_is_best_fit_decreasing():
    rng = random.Random(8)
    for _ in range(60):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used = {}
        for length, _, ranks, first, offset in packing.plan(counts, 64):
            for i in range(ranks):
                used.setdefault(first + i, []).append((offset, length))
        assert len(used) == len(best_fit(lengths, 64))
        assert sorted(n for places in used.values() for _, n in places) == sorted(lengths)


def test_sequences_hold_the_documents(spark, rows, ids_of):
    few = rows[:30]
    frame = spark.createDataFrame(few, "doc_id long, text string")
    got = packing.sequences(frame, capacity=200).collect()
    want = sum(len(ids_of(t)) + 1 for _, t in few)
    assert sum(len(r.ids) for r in got) == want and all(len(r.ids) <= 200 for r in got)


def test_empty(empty):
    assert token_files.round_trip(empty).count() == 0
    assert packing.report(empty).count() == 0


def test_pipeline_equals_brute_force(spark, ids_of):
    docs = table(spark, SF, "documents")
    kept = docs
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = {r.doc_id: r.text for r in kept.collect()}
        frame = stage(spark, kept, SF)
        assert frame.columns == columns
        after = {r.doc_id for r in frame.collect()}
        if name == "exact_dedup":
            want = {max(d for d, t in rows.items() if t == text) for text in set(rows.values())}
        elif name == "near_dedup":
            want = {d for d, (_, c) in brute.components(list(rows.items())).items() if c == d}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            want = {d for d, (_, n, _) in brute.contamination(list(rows.items()), items).items() if not n}
        else:
            want = after
            assert 0.8 * len(rows) < len(after) <= len(rows)
        assert after == want, name
        kept = docs.where(docs.doc_id.isin(list(after)))
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    check_packing(corpus_pipeline.run(spark, SF).collect(), rows, ids_of)
