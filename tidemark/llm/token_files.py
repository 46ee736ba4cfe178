"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A shard file holds the ids of its documents in ascending doc_id order, then the boundaries and
the document ids as Elias-Fano lists, then a footer that says where each part lies. An
Elias-Fano list of m numbers below u takes about 2 + log2(u / m) bits a number: the low bits
are packed, the high bits are a unary bit vector, and one 32-bit count for every block of 4096
of its bits lets ``select`` find the i-th number without a table of offsets.

Documents are range-partitioned by doc_id; each task writes one file batch by batch, so memory
is bounded by one batch and the shard's boundaries. A file gets its name from the attempt that
wrote it and counts only if the manifest, a written table, names it: lost or repeated tasks
leave nothing behind that a reader sees. Ids before a shard come from the manifest, which has
one row a shard.

Defined cases: null text is empty (only the end id); a null doc_id comes first; rows with equal
ids stay separate, in text order; no rows, no files; other columns are not written.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import default_vocabulary, encoded, encoder
from tidemark.llm.work import cut, map_batches, shared_folder

MAGIC = b"TIDSEF01"
#: Bits of the unary vector for each count of the select structure.
SELECT_BITS = 4096
READ_DOCS = 4096


class EliasFano:
    """A non-decreasing list of numbers 0..u."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.counts = n, low_bits, low, high, counts

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits(
            ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8),
            bitorder="little",
        )
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        blocks = (int(ones[-1]) // SELECT_BITS + 1) if n else 1
        bits = np.zeros(blocks * SELECT_BITS, np.uint8)
        bits[ones] = 1
        counts = np.searchsorted(ones, np.arange(blocks) * SELECT_BITS).astype("<u4")
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), counts)

    def select(self, first: int, last: int) -> np.ndarray:
        """Numbers first..last (exclusive)."""
        if first >= last:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.counts, first, "right")) - 1
        b = int(np.searchsorted(self.counts, last - 1, "right"))
        size = SELECT_BITS // 8
        ones = np.flatnonzero(np.unpackbits(self.high[a * size : b * size], bitorder="little"))
        skip = first - int(self.counts[a])
        ones = ones[skip : skip + last - first] + a * SELECT_BITS
        high = (ones - np.arange(first, last)) << self.low_bits
        if not self.low_bits:
            return high
        begin, end = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[begin // 8 : -(-end // 8)], bitorder="little")
        bits = bits[begin % 8 : begin % 8 + end - begin].reshape(-1, self.low_bits)
        return high + (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.counts.tobytes()]

    def shape(self) -> dict:
        return {"n": self.n, "low_bits": self.low_bits, "bytes": [len(p) for p in self.parts()]}

    @classmethod
    def read(cls, shape: dict, raw: bytes) -> EliasFano:
        a, b, _ = np.cumsum(shape["bytes"])
        return cls(
            shape["n"], shape["low_bits"], np.frombuffer(raw[:a], np.uint8),
            np.frombuffer(raw[a:b], np.uint8), np.frombuffer(raw[b:], "<u4"),
        )


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def write(
    docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 1
) -> DataFrame:
    """Write the shard files below ``folder``; returns the manifest (shard, file, docs, ids)."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        files, base = _open(folder)
        out, ends, ids, name = None, [0], [], f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        kind = encoder(path).type
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}")
                end = np.array([end_id], kind).tobytes()
                for found in encoded(batch.column("text"), path):
                    out.write(found.tobytes() + end)
                    ends.append(ends[-1] + len(found) + 1)
                ids += batch.column("doc_id").to_pylist()
            if out is None:
                return
            nulls = sum(x is None for x in ids)
            known = np.array(ids[nulls:], np.int64)
            least = int(known[0]) if len(known) else 0
            lists = [EliasFano.of(np.array(ends)), EliasFano.of(known - least)]
            for part in lists:
                out.write(b"".join(part.parts()))
            footer = json.dumps({
                "id_bytes": kind.itemsize, "ids": ends[-1], "null_docs": nulls, "least_doc": least,
                "ends": lists[0].shape(), "docs": lists[1].shape(),
            }).encode()
            out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "file": [name], "docs": [len(ids)], "ids": [ends[-1]]}
        )

    # an explicit text order makes shards repeatable where ids are not unique
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return cut(map_batches(rows, run, "shard int, file string, docs long, ids long"), "manifest")


class Shard:
    """An open shard file."""

    def __init__(self, folder: str, name: str):
        files, base = _open(folder)
        self.file = files.open_input_file(f"{base}/{name}")
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{name} is not a token-id file")
        n = struct.unpack("<I", tail[:4])[0]
        self.footer = json.loads(self.file.read_at(n, size - 12 - n))
        self.type = np.dtype(f"<u{self.footer['id_bytes']}")
        at = self.footer["ids"] * self.type.itemsize
        lists = []
        for key in ("ends", "docs"):
            length = sum(self.footer[key]["bytes"])
            lists.append(EliasFano.read(self.footer[key], self.file.read_at(length, at)))
            at += length
        self.ends, self.docs = lists
        self.n = self.ends.n - 1

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        nulls = self.footer["null_docs"]
        found = self.docs.select(max(0, first - nulls), max(0, last - nulls)) + self.footer["least_doc"]
        return [None] * (min(last, nulls) - min(first, nulls)) + found.tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        size = self.type.itemsize
        return np.frombuffer(self.file.read_at((end - start) * size, start * size), self.type)


def read(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(  # one row a shard: a few bytes for every 100 MB of text
        "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")
    )
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(batch.column(c).to_pylist() for c in ("file", "before")), strict=True):
                shard = Shard(folder, name)
                for i in range(0, shard.n, READ_DOCS):
                    last = min(shard.n, i + READ_DOCS)
                    ends = shard.ends.select(i, last + 1)
                    crcs, lists = [], []
                    for a, b in zip(ends[:-1], ends[1:], strict=True):
                        ids = shard.ids(int(a), int(b))
                        crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if with_ids:
                            lists.append(ids.astype(np.int32))
                    columns = {
                        "doc_id": pa.array(shard.doc_ids(i, last), pa.int64()),
                        "start": pa.array(ends[:-1] + base, pa.int64()),
                        "n_tokens": pa.array(np.diff(ends), pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    } | ({"ids": pa.array(lists, pa.list_(pa.int32()))} if with_ids else {})
                    yield pa.RecordBatch.from_pydict(columns)

    n = max(1, manifest.count())
    return map_batches(placed.repartition(n, "file"), run, schema)


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write all documents to the shared folder and read every one back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/llm-ids-{uuid.uuid4().hex}"
    return read(spark, folder, write(docs, folder, vocabulary))
