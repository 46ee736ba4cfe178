"""Word passages that also occur earlier: where to look, what meets, and what is removed.

A window is ``length`` consecutive words of a document. It repeats if the same words also start
earlier, in a smaller doc_id or further up. Every word that a repeating window covers goes.

Each window has an anchor, its leftmost smallest ``gram``-word hash (a minimiser), which
depends on its words alone; so equal windows have equal anchors. Neighbouring windows with one
anchor are a segment. Then

1. anchors that occur once in all documents are dropped: their windows are unique;
2. equal segments are one variant, kept with its first place; further copies repeat whole,
   whatever their number;
3. variants that share an anchor meet in one task, in order of their first places, and a
   ``compare`` function finds which of a variant's windows an earlier variant has: the two
   operators differ here (suffix automata, suffix arrays). An anchor of very many variants (a
   common passage in changing surroundings) is dealt out by single windows instead, whose
   first place is an aggregate;
4. the marks go back to the documents.

Texts move twice (to cut out variants, to remove words); else only hashes and places do. Equal
hashes of 64 bits stand for equal segments; variants are compared by their words.

Defined cases: null text has no words; texts shorter than a window are kept whole; a null
doc_id comes before all others; rows with equal ids come in order of a hash of their words, and
rows that repeat both id and words are judged alike (neither is the earlier one); kept words
are joined by one blank; other columns pass through :func:`strip` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.work import aside, columns, cut, ddl, drop, map_arrow, map_batches, whole_groups

#: An anchor with more variants is dealt out by single windows.
MOST_VARIANTS = 10_000
Compare = Callable[[pa.RecordBatch, int, int], np.ndarray]


def _leftmost_smallest(g: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the leftmost smallest of g[i : i + width]."""
    at, reach = np.arange(len(g)), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = at[:-step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        reach += step
    return at


def text_keys(run: W.Words, h: np.ndarray) -> np.ndarray:
    """31 bits of each document's words, which order rows with equal ids."""
    return (W.range_hashes(h, run.offsets[:-1], run.offsets[1:]) >> W.U64(33)).astype(np.int64)


def segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, variant, doc_id, at, shape) of all segments. ``at`` is the text key and the first
    word; ``shape`` the number of windows and the anchor's place in the segment."""
    width = length - gram + 1
    if not 0 < width < 64:
        raise ValueError("a window must have 1 to 63 places for its anchor")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = []
        for run in W.split(batch.column("text"), "space"):
            h = run.hashes()
            begin = np.flatnonzero(run.room() >= length)
            if not len(begin):
                continue
            g = W.window_hashes(h, gram)
            anchor = _leftmost_smallest(g, width)[begin]
            new = np.r_[True, (np.diff(begin) > 1) | (np.diff(anchor) != 0)]
            first = np.flatnonzero(new)
            n = np.diff(np.r_[first, len(begin)])
            start, at = begin[first], anchor[first]
            doc = np.searchsorted(run.offsets, start, "right") - 1
            place = (text_keys(run, h)[doc] << 32) | (start - run.offsets[doc])
            variant = W.range_hashes(h, start, start + n - 1 + length)
            parts.append((g[at], variant, doc + run.first_row, place, (n << 8) | (at - start)))
        if not parts:
            return None
        a, v, doc, place, shape = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a.view(np.int64)), pa.array(v.view(np.int64)),
                batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)),
                pa.array(place), pa.array(shape.astype(np.int32)),
            ],
            ["anchor", "variant", "doc_id", "at", "shape"],
        )

    return map_arrow(
        docs.select("doc_id", "text"), work,
        "anchor long, variant long, doc_id long, at long, shape int",
    )


def _contents(docs: DataFrame, picked: DataFrame, length: int) -> DataFrame:
    """picked with the words of each variant, cut from the document of its first place."""
    wanted = picked.groupBy(F.col("doc_id").alias("__id__")).agg(
        F.collect_list(F.struct("anchor", "variant", "at", "shape", "variants")).alias("wanted")
    )  # a list is at most as long as its document
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("__id__"))).drop("__id__")
    names = ["anchor", "variant", "at", "shape", "variants"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        wanted = batch.column("wanted")
        flat, bounds = wanted.flatten(), np.asarray(wanted.offsets) - wanted.offsets[0].as_py()
        at, shape = flat.field("at").to_numpy(), flat.field("shape").to_numpy()
        keep, words, owner = [], [], []
        for run in W.split(batch.column("text"), "space"):
            keys = text_keys(run, run.hashes())
            data = run.data.tobytes()
            for i in range(len(run)):
                row = run.first_row + i
                found = data[run.bounds[i] : run.bounds[i + 1]].split()
                for k in range(bounds[row], bounds[row + 1]):
                    if at[k] >> 32 == keys[i]:
                        start = at[k] & 0xFFFFFFFF
                        keep.append(k)
                        owner.append(row)
                        words.append(b" ".join(found[start : start + (shape[k] >> 8) - 1 + length]))
        if not keep:
            return None
        taken = pa.array(keep)
        return pa.RecordBatch.from_arrays(
            [
                *(flat.field(c).take(taken) for c in names),
                batch.column("doc_id").take(pa.array(owner)), pa.array(words, pa.binary()),
            ],
            [*names, "doc_id", "words"],
        )

    # equal rows of documents give equal variants
    return map_arrow(
        rows, work,
        "anchor long, variant long, at long, shape int, variants long, doc_id long, words binary",
    )


def _compared(rows: DataFrame, length: int, gram: int, compare: Compare) -> DataFrame:
    """(anchor, variant, mask): which windows of a variant an earlier one of its anchor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "anchor"):
            mask = compare(part, length, gram)
            some = pa.array(np.flatnonzero(mask))
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [part.column("anchor").take(some), part.column("variant").take(some),
                     pa.array(mask).take(some)],
                    ["anchor", "variant", "mask"],
                )

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "at")
    return map_batches(ordered, run, "anchor long, variant long, mask long")


def _compared_by_window(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors of very many variants, window by window."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows_, place, words = [], [], []
        for i, (text, shape) in enumerate(zip(
            batch.column("words").to_pylist(), batch.column("shape").to_pylist(), strict=True
        )):
            found = text.split(b" ")
            for k in range(shape >> 8):
                rows_.append(i)
                place.append(k)
                words.append(b" ".join(found[k : k + length]))
        taken = pa.array(rows_)
        columns = [batch.column(c).take(taken) for c in ("anchor", "variant", "doc_id", "at")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(place, pa.int32()), pa.array(words, pa.binary())],
            ["anchor", "variant", "doc_id", "at", "k", "words"],
        )

    windows = map_arrow(
        rows, work, "anchor long, variant long, doc_id long, at long, k int, words binary"
    ).withColumn("place", F.struct("doc_id", F.col("at") + F.col("k")))
    first = windows.groupBy("words").agg(F.min("place").alias("first"))
    late = windows.join(first, "words").where("place <> first")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k"))
    return late.groupBy("anchor", "variant").agg(F.bit_or(bit).alias("mask"))


def marks(
    docs: DataFrame, length: int, gram: int, compare: Compare, most_variants: int = MOST_VARIANTS
) -> DataFrame:
    """(__id__, __marks__): for each document with any, the segments and masks of repeating windows."""
    key = ["anchor", "variant"]
    rows = segments(docs, length, gram)
    # each side of a join that meets hot anchors is a table or a scan, so Spark can split them
    shared = cut(
        rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "shared"
    )
    rows = cut(rows.join(shared, "anchor"), "segments")
    drop(shared)
    firsts = cut(
        rows.groupBy(*key).agg(F.min(F.struct("doc_id", "at", "shape")).alias("first")), "firsts"
    )
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    picked = firsts.join(several, "anchor").select(*key, "first.*", "variants")
    contents = cut(_contents(docs, picked, length).dropDuplicates([*key]), "variants")
    masks = _compared(contents.where(F.col("variants") <= most_variants), length, gram, compare).union(
        _compared_by_window(contents.where(F.col("variants") > most_variants), length)
    )
    masks = cut(masks, "masks")
    drop(contents)
    is_first = F.struct("doc_id", "at").eqNullSafe(F.struct("first.doc_id", "first.at"))
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("shape", 8)) - 1
    copies = rows.join(firsts, key).where(~is_first).select(
        F.col("doc_id").alias("__id__"), "at", whole.alias("mask")
    )
    marked = copies.union(firsts.join(masks, key).select("first.doc_id", "first.at", "mask"))
    return marked.groupBy("__id__").agg(F.collect_list(F.struct("at", "mask")).alias("__marks__"))


@aside
def strip(
    docs: DataFrame, length: int, gram: int, compare: Compare, most_variants: int = MOST_VARIANTS
) -> DataFrame:
    """docs with ``text`` cut down to the kept words, n_words and n_removed."""
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    found = cut(marks(docs, length, gram, compare, most_variants), "marks")
    rows = docs.select(columns(names)).join(found, F.col("doc_id").eqNullSafe(F.col("__id__")), "left").drop("__id__")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("__marks__")
        flat, bounds = lists.flatten(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        at, mask = flat.field("at").to_numpy(), flat.field("mask").to_numpy()
        texts, n, removed = [], [], []
        for run in W.split(batch.column("text"), "space"):
            data, keys = run.data.tobytes(), None
            for i in range(len(run)):
                row = run.first_row + i
                words = data[run.bounds[i] : run.bounds[i + 1]].split()
                n.append(len(words))
                own = slice(bounds[row], bounds[row + 1])
                if bounds[row] < bounds[row + 1]:
                    keys = text_keys(run, run.hashes()) if keys is None else keys
                    places = at[own][at[own] >> 32 == keys[i]] & 0xFFFFFFFF
                    bits = mask[own][at[own] >> 32 == keys[i]]
                    turn = np.zeros(len(words) + 1, np.int64)
                    for k in range(length - gram + 1):
                        begin = places[(bits >> k) & 1 == 1] + k
                        np.add.at(turn, begin, 1)
                        np.add.at(turn, begin + length, -1)
                    gone = np.cumsum(turn[:-1]) > 0
                    words = [words[j] for j in np.flatnonzero(~gone)]
                removed.append(n[-1] - len(words))
                texts.append(b" ".join(words))
        fresh = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
        return pa.RecordBatch.from_arrays(
            [
                *(fresh.get(c, batch.column(c)) for c in names),
                pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
            ],
            [*names, "n_words", "n_removed"],
        )

    kept = docs.select(columns(names))
    return map_arrow(rows, work, f"{ddl(kept)}, n_words long, n_removed long")


def digest(stripped: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of what :func:`strip` returned."""
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
