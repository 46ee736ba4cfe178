"""Bulk-synchronous best-fit packing of tokenised documents into sequences.

Documents longer than a sequence are cut into full pieces and a rest. Lengths are whole numbers
up to the capacity, so documents and gaps form at most ``capacity`` classes each, whatever the
input. The classes take turns from long to short. In its turn a class of documents sweeps to
its successor, the class of the smallest gaps that hold it; as many gaps as there are documents
(or the reverse) are filled at once, the rest goes on to the next successor, and where none is
left it opens sequences. Conflicts inside a class are resolved by rank: the i-th document of a
class takes the i-th free place of it. Then the gaps' classes are updated and the next class
follows. That is best-fit decreasing, bulk by bulk.

Only the class counts reach the driver, and only runs of ranks leave it; both are bounded by
the capacity, not by the data. All rows are ranked and placed on the executors; a length that
holds any share of all rows is ranked in blocks (:func:`tidemark.llm.work.with_rank`).

Defined cases: null text is empty and packs its end id only; rows with equal ids are packed
separately; no rows, no sequences; other columns do not matter.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import default_vocabulary, encoded
from tidemark.llm.work import cut, map_batches, with_rank

CAPACITY = 2048


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of all documents."""
    path = vocabulary or default_vocabulary()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            lists = []
            for doc, found in zip(
                batch.column("doc_id").to_pylist(), encoded(batch.column("text"), path), strict=True
            ):
                ids = np.append(found.astype("<u4"), np.uint32(end_id))
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc, k, start, len(part), zlib.crc32(part.tobytes())))
                    if with_ids:
                        lists.append(part.astype(np.int32))
            if rows:
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = dict(zip(names, map(pa.array, zip(*rows, strict=True), kinds), strict=True))
                if with_ids:
                    columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return map_batches(docs.select("doc_id", "text"), run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit of length classes: rows (length, first rank, ranks, first sequence, offset).

    Rank first + i of a length goes into sequence first + i at the offset."""
    placed: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}  # gap -> runs of sequences [first, how many]
    order: list[int] = []  # gaps in ascending order
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append([first, n])

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = gap // length
            full = min(n, left // each)
            for k in range(each if full else 0):
                placed.append((length, rank, full, first, capacity - gap + k * length))
                rank += full
            left -= full * each
            leave(gap - each * length, first, full)
            if full < n and left:  # fewer than ``each`` are left: they share one sequence
                for k in range(left):
                    placed.append((length, rank, 1, first + full, capacity - gap + k * length))
                    rank += 1
                leave(gap - left * length, first + full, 1)
                full, left = full + 1, 0
            leave(gap, first + full, n - full)
    return placed


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row (doc_id, piece, start, length, ...) its sequence_id and offset."""
    spark = rows.sparkSession
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = ["_length", "_from", "_ranks", "_first", "offset"]
    found = plan(counts, capacity)
    steps = spark.createDataFrame(
        pa.table({n: pa.array([r[i] for r in found], pa.int64()) for i, n in enumerate(names)})
    )
    ranked = with_rank(rows, "length", ["doc_id", "piece", "start", "ids_crc32"], "_rank")
    here = (
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from"))
        & (F.col("_rank") < F.col("_from") + F.col("_ranks"))
    )
    return ranked.join(F.broadcast(steps), here).withColumn(
        "sequence_id", F.col("_first") + F.col("_rank") - F.col("_from")
    ).select(*rows.columns, "sequence_id", "offset")


def sequences(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0,
              vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, ids, docs): the packed training sequences themselves."""
    placed = pack(cut(pieces(docs, capacity, end_id, vocabulary, with_ids=True), "pieces"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("docs")
    )


def report(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack(cut(pieces(docs, capacity), "pieces"), capacity)
