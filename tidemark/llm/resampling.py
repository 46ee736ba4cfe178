"""Importance resampling towards a target: hashed n-gram features, Gumbel top-k draw.

Features are all runs of 1 to 3 words. Their buckets are CRCs of their bytes, computed in length
buckets: the distinct features of a chunk of texts are grouped by equal byte length into
two-dimensional uint8 arrays, the CRCs of all rows of an array are updated column by column, and
the results are scattered back to the places of the features. Two passes over the texts: one
counts buckets (10,000 sums a task), one adds the gains of each document's features; the table of
gains has one row for each bucket, so its broadcast is bounded by their number. The draw is a
distributed rank over narrow rows.

Defined cases: null text has no words and no features (weight 0); documents with fewer than
``min_words`` words are scored and never drawn; ties go to the smaller id, null ids first and
equal ids in any order; a null id is hashed like an empty one; repeated rows are counted and
ranked each for itself; an empty target gives weights by the source alone; no documents, no rows.
:func:`resample` returns the drawn rows with their own columns, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ordering import ascending, ordered
from tidemark.llm.words import Words, split
from tidemark.llm.work import cut, map_batches, workers_import

BUCKETS = 10_000
LONGEST_RUN = 3
SEED = 42
PERCENT = 5
MIN_WORDS = 20
#: Arrays with fewer rows are hashed row by row: a column step costs as much as 16 short calls.
FEW_ROWS = 16
FOUND = ["n_words", "n_features", "weight"]


def _crc_table() -> np.ndarray:
    """Remainders of all bytes for the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def matrix_crcs(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a uint8 matrix, all rows at once, column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def slice_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices data[starts[i] : starts[i] + lengths[i]], by length buckets."""
    out = np.zeros(len(starts), np.uint32)
    by_length = np.argsort(lengths, kind="stable")
    sizes, firsts = np.unique(lengths[by_length], return_index=True)
    for size, rows in zip(sizes, np.split(by_length, firsts[1:]), strict=True):
        if len(rows) < FEW_ROWS:
            for r in rows:
                out[r] = zlib.crc32(data[starts[r] : starts[r] + size])
        else:
            windows = np.lib.stride_tricks.sliding_window_view(data, size)
            out[rows] = matrix_crcs(windows[starts[rows]])
    return out


def joined_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all words of the chunk with one blank after each, their starts there, their numbers in a
    dictionary of the chunk)."""
    lengths = words.ends - words.starts
    first = np.cumsum(lengths) - lengths
    letters = words.data[np.repeat(words.starts - first, lengths) + np.arange(lengths.sum())]
    offsets = np.append(first, lengths.sum()).astype(np.int64)
    array = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    ids = array.dictionary_encode().indices.to_numpy().astype(np.int64)
    starts = first + np.arange(len(lengths))
    spaced = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    spaced[np.repeat(starts - first, lengths) + np.arange(lengths.sum())] = letters
    return spaced, starts, ids


def feature_buckets(words: Words, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 and 3 words: (index of the first word, bucket) of every feature."""
    if not len(words.starts):
        return
    spaced, starts, ids = joined_words(words)
    ends = starts + (words.ends - words.starts)
    room = words.room()
    codes, kinds = ids, int(ids.max()) + 1  # number of the run from each word on
    for length in range(1, LONGEST_RUN + 1):
        at = np.flatnonzero(room >= length)
        if not len(at):
            return
        if length > 1:  # equal runs: equal shorter run, equal last word
            pairs = codes[at] * kinds + ids[at + length - 1]
            numbers, distinct = pd.factorize(pairs)
            codes = np.zeros(len(ids), np.int64)
            codes[at] = numbers
            n_distinct = len(distinct)
        else:
            numbers, n_distinct = codes[at], kinds
        sample = np.empty(n_distinct, np.int64)
        sample[numbers] = at  # any place of each distinct feature
        sizes = ends[sample + length - 1] - starts[sample]
        crcs = slice_crcs(spaced, starts[sample], sizes)
        yield at, (crcs % np.uint32(buckets)).astype(np.int64)[numbers]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count) over all features of the ``text`` column, empty buckets left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for words in split(batch.column(0), "alnum", fold=True):
                for _, found in feature_buckets(words, buckets):
                    counts += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.record_batch([pa.array(some), pa.array(counts[some])], ["bucket", "count"])

    counted = map_batches(texts.select("text"), run, "bucket long, count long")
    return counted.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket: thousandths of the log of target share over document share.

    The result has ``buckets`` numbers, whatever the input.
    """
    source = bucket_counts(docs, buckets).withColumnRenamed("count", "s")
    wanted = bucket_counts(target, buckets).withColumnRenamed("count", "t")
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    rows = both.join(source, "bucket", "left").join(wanted, "bucket", "left").fillna(0, ["s", "t"])
    found = rows.select("bucket", "s", "t").toPandas()
    s, t = np.zeros(buckets), np.zeros(buckets)
    s[found["bucket"]], t[found["bucket"]] = found["s"], found["t"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, name: str) -> DataFrame:
    """docs with a struct column of words, features and weight, the sum of the features' gains."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    workers_import(docs.sparkSession)
    buckets = len(gain)

    def work(texts: pa.Array) -> pa.Array:
        n_words, n_features, weights = (np.zeros(len(texts), np.int64) for _ in range(3))
        for words in split(texts, "alnum", fold=True):
            total = np.zeros(len(words.starts), np.int64)
            number = np.zeros(len(words.starts), np.int64)
            for at, found in feature_buckets(words, buckets):
                total[at] += sent.value[found]
                number[at] += 1
            rows = slice(words.first_row, words.first_row + len(words))
            n_words[rows] = np.diff(words.offsets)
            for out, values in ((n_features, number), (weights, total)):
                sums = np.concatenate([[0], np.cumsum(values)])
                out[rows] = sums[words.offsets[1:]] - sums[words.offsets[:-1]]
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.array(n_features), pa.array(weights)], FOUND
        )

    kinds = ", ".join(f"{f} long" for f in FOUND)
    once = F.arrow_udf(work, kinds).asNondeterministic()  # a filter on it shall not run it again
    return docs.withColumn(name, once(F.col("text")))


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate from the id and the seed, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def score_of(found: str, seed: int) -> Column:
    return F.col(found)["weight"] + noise(F.col("doc_id"), seed)


def _ranked(docs: DataFrame, gain: np.ndarray, percent: int, seed: int, min_words: int) -> DataFrame:
    scored = cut(
        weighted(docs.select("doc_id", "text"), gain, "found")
        .select("doc_id", "found.*", score_of("found", seed).alias("score")), "scored",
    )
    able = scored.where(F.col("n_words") >= min_words)
    draws = percent * able.count() // 100
    order = [F.col("score").desc(), ascending("doc_id")]
    place = F.col("_place") + 1
    kept = ["doc_id", "n_features", "weight", "score"]
    drawn = ordered(able, [], order).placed().select(
        *kept, F.when(place <= draws, place).alias("rank")
    )
    others = scored.where(F.col("n_words") < min_words)
    return drawn.unionByName(others.select(*kept, F.lit(None).cast("long").alias("rank")))


def ranked(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED,
    min_words: int = MIN_WORDS, buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null if not drawn) of every document."""
    return _ranked(docs, gains(docs, target, buckets), percent, seed, min_words)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED,
    min_words: int = MIN_WORDS, buckets: int = BUCKETS,
) -> DataFrame:
    """The drawn rows of docs with all their columns.

    Scores repeat exactly, so the last drawn pair of score and id tells the drawn rows; rows
    that share that pair are all drawn."""
    gain = gains(docs, target, buckets)
    last = (
        _ranked(docs, gain, percent, seed, min_words).where("rank IS NOT NULL")
        .orderBy(F.col("rank").desc()).select("score", "doc_id").first()
    )
    if last is None:
        return docs.limit(0)
    taken = {c.lower() for c in docs.columns}
    name = next(n for n in ("found" + "_" * i for i in range(len(taken) + 1)) if n not in taken)
    tied = F.col("doc_id").isNull()
    if last["doc_id"] is not None:
        tied = tied | (F.col("doc_id") <= F.lit(last["doc_id"]))
    score = score_of(name, seed)
    best = (score > F.lit(last["score"])) | ((score == F.lit(last["score"])) & tied)
    long_enough = F.col(name)["n_words"] >= min_words
    return weighted(docs, gain, name).where(long_enough & best).drop(name)
