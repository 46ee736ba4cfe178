"""Benchmark decontamination: a broadcast set of normalised test n-grams against all documents.

Words are runs of digits, letters a-z (A-Z folded) and characters beyond ASCII. A test item
gives every window of ``size`` consecutive words; a shorter item, if it has words, is one
window. The windows' hashes go to the executors; documents are scanned once, a window whose
hash is found is compared word by word, and the words inside it are hit.

Distinct windows are numbered in a table and broadcast without their items. A benchmark of more
than ``max_windows`` windows, or ``MAX_BYTES`` of them, is taken in blocks of about that many,
cut by a hash of the window's words. A block is collected, broadcast and scanned, its hits are
written with the rows and its broadcast is destroyed before the next block is collected. So the
driver and a task hold one block, whatever the benchmark. Which items a hit window belongs to is a
join of written tables afterwards; only :func:`contamination` and :func:`report` need it.

Defined cases: a null or empty text has no words and no hits; an item without words, or
without text, has no window; an item without id marks words but is not named; rows with equal
ids are separate documents; equal items are all named; other columns pass through
:func:`remove_spans` and :func:`remove_documents` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.work import aside, columns, cut, ddl, drop, map_arrow

WORDS_OF_WINDOW = 10
MAX_WINDOWS = 1_000_000
MAX_BYTES = 256 << 20
_TABLE_BITS = 22


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(item, words) of every window of the items (item_id, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [None if x is None else str(x) for x in batch.column("item_id").to_pylist()]
        names: list[str | None] = []
        texts: list[bytes] = []
        for run in W.split(batch.column("text"), "alnum", fold=True):
            data = run.data.tobytes()
            for i in range(len(run)):
                a, b = run.offsets[i], run.offsets[i + 1]
                found = [data[run.starts[j] : run.ends[j]] for j in range(a, b)]
                for j in range(max(1, len(found) - size + 1) if found else 0):
                    names.append(ids[run.first_row + i])
                    texts.append(b" ".join(found[j : j + size]))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["item", "words"]
        )

    return map_arrow(items.select("item_id", "text"), work, "item string, words binary")


class Windows:
    """Windows of one block by number of words, each with its number; small enough to broadcast."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.numbers = {bytes(text): number for number, text in rows}
        by_size: dict[int, list[bytes]] = {}
        for text in self.numbers:
            by_size.setdefault(text.count(b" ") + 1, []).append(text)
        self.tables: dict[int, np.ndarray] = {}
        for size, texts in by_size.items():
            column = pa.array([t.decode() for t in texts], pa.string())
            hashes = np.concatenate(
                [W.range_hashes(r.hashes(), r.offsets[:-1], r.offsets[1:]) for r in W.split(column)]
            )
            present = np.zeros(1 << _TABLE_BITS, bool)
            present[hashes >> W.U64(64 - _TABLE_BITS)] = True
            self.tables[size] = present

    def hits(self, run: W.Words) -> Iterator[tuple[int, int, int]]:
        """(first word, words, number) of every window that occurs in the run."""
        h, room, data = run.hashes(), run.room(), None
        for size, present in self.tables.items():
            starts = np.flatnonzero(room >= size)
            if not len(starts):
                continue
            found = W.range_hashes(h, starts, starts + size)
            for i in starts[present[found >> W.U64(64 - _TABLE_BITS)]]:
                data = run.data.tobytes() if data is None else data
                key = b" ".join(data[run.starts[j] : run.ends[j]] for j in range(i, i + size))
                if key in self.numbers:
                    yield int(i), size, self.numbers[key]


def _blocks(numbered: DataFrame, max_windows: int) -> Iterator[Windows]:
    """The table (window, words) in blocks, each collected when it is asked for."""
    n, size = numbered.agg(F.count(F.lit(1)), F.sum(F.length("words"))).first()
    blocks = max(1, -(-n // max_windows), -(-(size or 0) // MAX_BYTES))
    for k in range(blocks):
        part = numbered.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        yield Windows([(r.window, r.words) for r in part.collect()])


def _scan(docs: DataFrame, shared) -> DataFrame:
    """docs with the words, hit words and hit windows of one block."""
    keep = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, hit, found = [], [], []
        for run in W.split(batch.column("text"), "alnum", fold=True):
            marks = np.zeros(run.offsets[-1] + 1, bool)
            windows_of: dict[int, set[int]] = {}
            for at, size, window in shared.value.hits(run):
                marks[at : at + size] = True
                row = int(np.searchsorted(run.offsets, at, "right")) - 1
                windows_of.setdefault(row, set()).add(window)
            for i in range(len(run)):
                a, b = run.offsets[i], run.offsets[i + 1]
                n.append(b - a)
                hit.append(np.flatnonzero(marks[a:b]).tolist() if i in windows_of else [])
                found.append(sorted(windows_of.get(i, ())))
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in keep), pa.array(n, pa.int64()),
                pa.array(hit, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.int64())),
            ],
            [*keep, "__n_words__", "__hit_words__", "__hit_windows__"],
        )

    return map_arrow(
        docs, work,
        f"{ddl(docs)}, __n_words__ long, __hit_words__ array<int>, __hit_windows__ array<long>",
    )


def _add(rows: DataFrame, shared) -> DataFrame:
    """Add one more block's hits to the result of earlier blocks."""
    names = rows.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = [set(x) for x in batch.column("__hit_words__").to_pylist()]
        windows = [set(x) for x in batch.column("__hit_windows__").to_pylist()]
        for run in W.split(batch.column("text"), "alnum", fold=True):
            for at, size, window in shared.value.hits(run):
                row = int(np.searchsorted(run.offsets, at, "right")) - 1
                first = at - int(run.offsets[row])
                hit[run.first_row + row].update(range(first, first + size))
                windows[run.first_row + row].add(window)
        fresh = {
            "__hit_words__": pa.array([sorted(x) for x in hit], pa.list_(pa.int32())),
            "__hit_windows__": pa.array([sorted(x) for x in windows], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(
            [fresh.get(c, batch.column(c)) for c in names], names
        )

    return map_arrow(rows, work, ddl(rows))


def hits(
    docs: DataFrame, items: DataFrame, size: int = WORDS_OF_WINDOW, max_windows: int = MAX_WINDOWS
) -> tuple[DataFrame, DataFrame]:
    """(docs with __n_words__, __hit_words__ (numbers of the hit words) and __hit_windows__ of each
    document, the table (window, item)). With one block the documents are read when the result is."""
    spark = docs.sparkSession
    windows = cut(item_windows(items, size).distinct(), "windows")
    number = F.monotonically_increasing_id().alias("window")
    numbered = cut(windows.select("words").distinct().select(number, "words"), "numbers")
    named = windows.where("item IS NOT NULL").join(numbered, "words").select("window", "item")
    out = shared = written = None
    for block in _blocks(numbered, max_windows):
        if out is not None:
            before, written = written, cut(out, "hits")
            shared.destroy()
            if before is not None:
                drop(before)
        shared = spark.sparkContext.broadcast(block)
        out = _scan(docs, shared) if written is None else _add(written, shared)
    return out, cut(named, "items")


def with_items(rows: DataFrame, named: DataFrame) -> DataFrame:
    """rows with __hit_items__, the sorted items of their __hit_windows__.

    Rows and (window, item) are written tables, so the join splits a window that many documents and
    items share; a document's pairs are united in the map tasks first.
    """
    rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "hits")
    pairs = rows.select("_row", F.explode("__hit_windows__").alias("window")).join(named, "window")
    found = pairs.groupBy(F.col("_row").alias("_hit_row")).agg(
        F.sort_array(F.collect_set("item")).alias("__hit_items__")
    )
    none = F.array().cast("array<string>")
    return (
        rows.join(found, F.col("_row") == F.col("_hit_row"), "left")
        .withColumn("__hit_items__", F.coalesce("__hit_items__", none))
        .drop("_row", "_hit_row")
    )


@aside
def contamination(
    docs: DataFrame, items: DataFrame, size: int = WORDS_OF_WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """docs with __n_words__, __hit_words__ (numbers of the hit words) and __hit_items__ of each
    document."""
    return with_items(*hits(docs, items, size, max_windows)).drop("__hit_windows__")


@aside
def remove_documents(docs: DataFrame, items: DataFrame, size: int = WORDS_OF_WINDOW) -> DataFrame:
    """Documents without any hit, as they were."""
    found, _ = hits(docs, items, size)
    return found.where(F.size("__hit_words__") == 0).select(columns(docs.columns))


@aside
def remove_spans(docs: DataFrame, items: DataFrame, size: int = WORDS_OF_WINDOW) -> DataFrame:
    """All documents; the bytes from the first to the last word of each hit run are cut out."""
    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        hits = batch.column("__hit_words__").to_pylist()
        for run in W.split(batch.column("text"), "alnum", fold=True):
            for i in range(len(run)):
                marked = hits[run.first_row + i]
                if not marked:
                    continue
                raw, base, out, done = texts[run.first_row + i].encode(), run.bounds[i], [], 0
                runs = np.split(marked, np.flatnonzero(np.diff(marked) > 1) + 1)
                for r in runs:
                    a = run.starts[run.offsets[i] + r[0]] - base
                    out.append(raw[done:a])
                    done = run.ends[run.offsets[i] + r[-1]] - base
                texts[run.first_row + i] = b"".join([*out, raw[done:]]).decode()
        fresh = {"text": pa.array(texts, pa.string())}
        return pa.RecordBatch.from_arrays(
            [fresh.get(c, batch.column(c)) for c in names], names
        )

    return map_arrow(hits(docs, items, size)[0], work, ddl(docs))


def report(docs: DataFrame, items: DataFrame, size: int = WORDS_OF_WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found, named = hits(docs.select("doc_id", "text"), items, size)
    n_hit = F.size("__hit_words__").cast("long").alias("n_hit")
    narrow = found.select("doc_id", F.col("__n_words__").alias("n_words"), n_hit, "__hit_windows__")
    return with_items(narrow, named).select(
        "doc_id", "n_words", "n_hit", F.size("__hit_items__").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "__hit_items__"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
