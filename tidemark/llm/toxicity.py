"""Toxicity: class-conditional Kneser-Ney models, compared by length-normalised likelihood.

A word follows its document's class: P(word | class) is an interpolated Kneser-Ney model whose
histories are the two classes. Its counts are the words of labelled documents, each less a
discount; the mass that is taken goes to continuation counts that the classes share, the number
of documents of the whole corpus that hold the word. So an expression that the labels show
rarely has the same backoff in both classes, and one that no class has shown more often than its
discount weighs nothing. The discount is a share of the class's size, equal
for both, since the classes differ in size.

Expressions of words that are ordinary one by one are seen by a second model, whose history is
the word before as well: P(word | word before, class). Its counts are the word pairs of the same
labelled documents; the mass taken from a history goes to continuation counts that the classes
share, the number of distinct words that precede the word in the whole corpus. A pair that
neither class has shown twice weighs nothing. Pairs are the longest expressions that are counted.

A document's features, of either model, are its mean log-likelihood ratio and, again by its
length, the evidence above ``STRONG`` of single words or pairs, so that a long text hides no
insults. A logistic calibration turns them into a probability; it is fitted on labelled rows that the counts have not seen, and
chooses among the discounts, and whether pairs are used, by likelihood.

Class counts come from a bounded sample of labelled rows (``max_labelled``, those of smallest
hashes), of which a third by a hash of the id is set aside for calibration; the shared counts
come from every document. All counts are one table, a row for each 64-bit word hash of the
corpus, so it grows with the vocabulary; tasks sum their own words before the shuffle. Only
words that a class has shown more often than the least discount can weigh anything: these, of
the bounded sample, are collected and broadcast with their ratios.

Defined cases: null text is empty; an empty text has no evidence; a null label is no label, and
a document with several labels is toxic if one says so; rows with equal ids are scored one by
one; without samples of both classes every score is the share of toxic rows (0.5 without any);
other columns pass through :func:`reject` unchanged.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.work import (
    aside,
    columns,
    cut,
    ddl,
    drop,
    map_arrow,
    map_batches,
    told_apart,
    without,
)

#: Words whose counts a task holds before it sends them on.
WORDS_AT_ONCE = 1 << 20
ROWS_OF_BATCH = 1 << 16
DISCOUNTS = (0.75, 1.5, 3.0, 6.0, 12.0, 25.0)
STRONG = 2.0
MAX_LABELLED = 250_000
CUTOFF = 0.3
#: Columns of the features that a calibration may use.
FEATURE_SETS = ([0, 1], [0, 2, 3], [0, 1, 4, 5], [0, 2, 3, 4, 6, 7])
FEATURES = 8
#: Discounts of pairs; one that is shown once is no evidence.
PAIR_DISCOUNTS = tuple(max(1.5, d) for d in DISCOUNTS)
#: The corpus's distinct pairs are counted in so many scans, each of a share by hash, so that
#: the shuffle of one fits the disk.
PASSES = 3
_COUNTS = ("ordinary", "toxic", "documents")


def _row_numbers(run: W.Words) -> np.ndarray:
    return np.repeat(np.arange(len(run)), np.diff(run.offsets))


def count(run: W.Words, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a run of documents, and three counts of each: in documents of either
    label (0, 1; -1 for none), and the documents that hold it."""
    coded = pa.array(run.hashes()).dictionary_encode()
    word, at = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
    row = _row_numbers(run)
    sums = np.zeros((3, len(word)), np.int64)
    given = label[row]
    for c in (0, 1):
        sums[c] = np.bincount(at[given == c], minlength=len(word))
    once = np.sort(row * len(word) + at)
    once = once[np.diff(once, prepend=-1) > 0]
    sums[2] = np.bincount(once % max(1, len(word)), minlength=len(word))
    order = np.argsort(word)
    return word[order], sums[:, order]


def _pairs(run: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that follow another word of their document, and the hashes of the pairs."""
    follows = np.ones(len(hashes), bool)
    follows[run.offsets[:-1][np.diff(run.offsets) > 0]] = False
    at = np.flatnonzero(follows)
    return at, W.window_hashes(hashes, 2)[at - 1]


def _with_pair(rows: DataFrame) -> DataFrame:
    """The hash of each pair in place of its two words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = np.stack([batch.column(c).to_numpy() for c in ("left", "word")], axis=1)
        pair = W.window_hashes(both.ravel().view(np.uint64), 2)[::2].view(np.int64)
        return batch.drop_columns(["left", "word"]).add_column(0, "pair", pa.array(pair))

    return map_arrow(rows, work, f"pair long, {ddl(rows.drop('left', 'word'))}")


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and a place of each."""
    order = np.argsort(values)
    ordered = values[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else order
    return ordered[first], order[first]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    word, sums = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts], axis=1)
    order = np.argsort(word)
    word, sums = word[order], sums[:, order]
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else order
    return word[first], np.add.reduceat(sums, first, axis=1) if len(word) else sums


def _found(keys: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """The place of each sought value in sorted keys; their number where it is missing."""
    if not len(keys):
        return np.zeros(len(sought), np.int64)
    at = np.searchsorted(keys, sought)
    return np.where(keys[np.minimum(at, len(keys) - 1)] == sought, at, len(keys))


def _starts(keys: np.ndarray) -> np.ndarray:
    """Which leading bits some key has: most values that are no keys are told without a search."""
    bits = min(26, max(10, (8 * len(keys)).bit_length()))
    marks = np.zeros(1 << bits, bool)
    marks[keys.view(np.uint64) >> W.U64(64 - bits)] = True
    return marks


def _hits(keys: np.ndarray, marks: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are keys, and the places of their keys."""
    at = np.flatnonzero(marks[hashes >> W.U64(65 - len(marks).bit_length())])
    place = _found(keys, hashes[at].view(np.int64))
    found = place < len(keys)
    return at[found], place[found]


class Model:
    """Log-likelihood ratios of the words and pairs that have one, for each discount."""

    def __init__(self, table: DataFrame):
        """Of a table of :func:`counts`."""
        self.marks = None  # made by the tasks
        total = table.agg(
            *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS)
        ).first()
        size = np.array([total.ordinary, total.toxic], float)
        self.words, self.ratios = np.zeros(0, np.int64), np.zeros((len(DISCOUNTS), 1), np.float32)
        self.pairs, self.pair_ratios = self.words, self.ratios
        if not size.all():
            return
        taken = np.outer(DISCOUNTS, size / size.min())  # (discount, class)
        kept = table.agg(*(
            F.sum(F.least(F.col(c).cast("double"), F.lit(float(t)))).alias(f"{c}{k}")
            for k, row in enumerate(taken) for c, t in zip(_COUNTS, row, strict=False)
        )).first()
        least = taken.min(axis=0)
        seen = (F.col("ordinary") > float(least[0])) | (F.col("toxic") > float(least[1]))
        rows = table.where(seen).toArrow()  # of the bounded sample
        word, ordinary, toxic, documents = (rows.column(c).to_numpy() for c in ("word", *_COUNTS))
        order = np.argsort(word)
        self.words, shared = word[order], documents[order] / total.documents
        counts = np.stack([ordinary, toxic])[:, order].astype(float)
        self.ratios = np.zeros((len(DISCOUNTS), len(word) + 1), np.float32)  # the last is of all others
        for k, ratio in enumerate(self.ratios):
            log = []
            for c in (0, 1):
                left = kept[f"{_COUNTS[c]}{k}"] / size[c]
                log.append(np.log(np.maximum(counts[c] - taken[k, c], 0) / size[c] + left * shared))
            ratio[:-1] = np.where((counts > taken[k][:, None]).any(axis=0), log[1] - log[0], 0)

    def add_pairs(self, pairs: DataFrame, contexts: DataFrame) -> None:
        """Of a table of :func:`pair_counts` and one of :func:`left_contexts`."""
        size = pairs.agg(F.sum("ordinary"), F.sum("toxic")).first()
        if not (size[0] and size[1]):
            return
        taken = np.outer(PAIR_DISCOUNTS, np.array(size, float) / min(size))
        total = contexts.agg(F.sum("contexts")).first()[0]
        least = taken.min(axis=0)
        history = pairs.groupBy("left").agg(
            *(F.sum(c).alias(f"{c}_size") for c in _COUNTS[:2]),
            *(F.sum(F.least(F.col(c).cast("double"), F.lit(float(t)))).alias(f"{c}_{k}")
              for k, row in enumerate(taken) for c, t in zip(_COUNTS, row, strict=False)),
        )

        def log(c: str, k: int, t: float) -> Column:
            own = F.greatest(F.col(c) - F.lit(t), F.lit(0.0))
            given = (own + F.col(f"{c}_{k}") * F.col("contexts") / F.lit(total)) / F.col(f"{c}_size")
            return F.log(F.when(F.col(f"{c}_size") > 0, given).otherwise(F.col("contexts") / F.lit(total)))

        ratios = []
        for k, (o, t) in enumerate(taken.tolist()):
            seen = (F.col("ordinary") > o) | (F.col("toxic") > t)
            ratios.append(F.when(seen, log("toxic", k, t) - log("ordinary", k, o)).otherwise(0.0)
                          .cast("float").alias(f"r{k}"))
        rows = (
            pairs.where((F.col("ordinary") > float(least[0])) | (F.col("toxic") > float(least[1])))
            .join(history, "left").join(contexts, "word").select("left", "word", *ratios)
        )
        rows = _with_pair(rows).toArrow()  # of the bounded sample
        pair = rows.column("pair").to_numpy()
        order = np.argsort(pair)
        self.pairs = pair[order]
        self.pair_ratios = np.zeros((len(DISCOUNTS), len(pair) + 1), np.float32)
        for k in range(len(DISCOUNTS)):
            self.pair_ratios[k, :-1] = rows.column(f"r{k}").to_numpy()[order]

    def features(self, run: W.Words) -> np.ndarray:
        """(document, discount, feature)."""
        row, length = _row_numbers(run), np.maximum(1, np.diff(run.offsets))
        hashes = run.hashes()
        second, pair = _pairs(run, hashes)
        if self.marks is None:
            self.marks = _starts(self.words), _starts(self.pairs)
        out = np.zeros((len(run), len(DISCOUNTS), FEATURES))
        for first, rows, sought, keys, marks, ratios in (
            (0, row, hashes, self.words, self.marks[0], self.ratios),
            (4, row[second], pair, self.pairs, self.marks[1], self.pair_ratios),
        ):
            at, place = _hits(keys, marks, sought)  # all others add nothing
            rows = rows[at]
            for k, ratio in enumerate(ratios):
                found = ratio[place]
                total = np.bincount(rows, found, len(run))
                strong = np.bincount(rows, np.maximum(found - STRONG, 0), len(run))
                out[:, k, first : first + 4] = np.stack(
                    [total / length, strong / length, np.log1p(strong), np.sqrt(strong / length)], axis=1
                )
        return out


def _labelled(labels: DataFrame, train: Column, max_labelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and labels (0, 1) of the sample."""
    rows = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).toArrow()
    )
    ids = rows.column("doc_id").to_numpy().astype(np.int64)
    order = np.argsort(ids)
    return ids[order], rows.column("toxic").to_numpy()[order]


def _set_aside(ids: np.ndarray) -> np.ndarray:
    return W.mix(ids.view(np.uint64)) % W.U64(3) == 0


def _sent(names: list[str], arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(arrays[0]), ROWS_OF_BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + ROWS_OF_BATCH]) for x in arrays], names)


def _labels_of(batch: pa.RecordBatch, known: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The label (0, 1; -1 for none) of each row."""
    own = batch.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy()
    given = np.full(len(own), -1)
    if len(known):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        given = np.where(known[at] == own, label[at], -1)
        given[np.asarray(batch.column("doc_id").is_null())] = -1
    return given


def counts(docs: DataFrame, ids: np.ndarray, toxic: np.ndarray) -> DataFrame:
    """(word, ordinary, toxic, documents) of every word hash of all documents, written once."""
    shared = docs.sparkSession.sparkContext.broadcast((ids, toxic))
    names = ["word", *_COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            given = _labels_of(batch, *shared.value)
            for words in W.split(batch.column("text"), "alnum", fold=True):
                parts.append(count(words, given[words.first_row : words.first_row + len(words)]))
                held += len(parts[-1][0])
                if held > WORDS_AT_ONCE:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held > WORDS_AT_ONCE // 2:
                        yield from _sent(names, [parts[0][0].view(np.int64), *parts[0][1]])
                        parts, held = [], 0
        if parts:
            word, sums = _summed(parts)
            yield from _sent(names, [word.view(np.int64), *sums])

    schema = ", ".join(f"{c} long" for c in names)
    found = map_batches(docs.select("doc_id", "text"), run, schema)
    return cut(found.groupBy("word").agg(*(F.sum(c).alias(c) for c in _COUNTS)), "words")


def pair_counts(docs: DataFrame, ids: np.ndarray, toxic: np.ndarray) -> DataFrame:
    """(left, word, ordinary, toxic) of every word pair of labelled documents, written once."""
    shared = docs.sparkSession.sparkContext.broadcast((ids, toxic))
    names = ["left", "word", *_COUNTS[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = _labels_of(batch, *shared.value)
            batch, given = batch.filter(pa.array(given >= 0)), given[given >= 0]
            for words in W.split(batch.column("text"), "alnum", fold=True):
                word = words.hashes()
                second, pair = _pairs(words, word)
                coded = pa.array(pair).dictionary_encode()
                at, n = coded.indices.to_numpy(), len(coded.dictionary)
                label = given[words.first_row + _row_numbers(words)[second]]
                sums = [np.bincount(at[label == c], minlength=n) for c in (0, 1)]
                first = np.zeros(n, np.int64)
                first[at] = second  # a place of each pair
                word = word.view(np.int64)
                yield from _sent(names, [word[first - 1], word[first], *sums])

    found = map_batches(docs.select("doc_id", "text"), run, ", ".join(f"{c} long" for c in names))
    return cut(found.groupBy(*names[:2]).agg(*(F.sum(c).alias(c) for c in names[2:])), "pairs")


def left_contexts(docs: DataFrame) -> DataFrame:
    """(word, contexts) of every word hash that follows another word in any document: the number
    of distinct words before it. Written once."""

    def scan(share: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0
            for batch in batches:
                for words in W.split(batch.column("text"), "alnum", fold=True):
                    word = words.hashes()
                    second, pair = _pairs(words, word)
                    own = np.flatnonzero(pair % W.U64(PASSES) == share)
                    pair, first = _distinct(pair[own])
                    parts.append((pair, word[second[own[first]]]))
                    held += len(pair)
                    if held > WORDS_AT_ONCE:
                        parts = [distinct(parts)]
                        held = len(parts[0][0])
                        if held > WORDS_AT_ONCE // 2:
                            yield from _sent(["pair", "word"], [x.view(np.int64) for x in parts[0]])
                            parts, held = [], 0
            if parts:
                yield from _sent(["pair", "word"], [x.view(np.int64) for x in distinct(parts)])

        found = map_batches(docs.select("text"), run, "pair long, word long").distinct()
        return cut(found.groupBy("word").agg(F.count(F.lit(1)).alias("contexts")), "contexts")

    def distinct(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pair, first = _distinct(np.concatenate([p[0] for p in parts]))
        order = np.argsort(word := np.concatenate([p[1] for p in parts])[first])
        return pair[order], word[order]  # equal words side by side shuffle in fewer bytes

    shares = [scan(k) for k in range(PASSES)]
    total = functools.reduce(DataFrame.union, shares).groupBy("word").agg(F.sum("contexts").alias("contexts"))
    out = cut(total, "contexts")
    for part in shares:
        drop(part)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """Weights of a logistic regression (the constant first), and its mean log-likelihood."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return [math.log(share / (1 - share))] + [0.0] * x.shape[1], -math.inf
    scale = x.std(axis=0) + 1e-9
    a = np.c_[np.ones(len(x)), x / scale]
    weights, ridge = np.zeros(a.shape[1]), np.diag([1e-6] + [1e-2] * x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ weights, -30, 30)))
        slope = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge
        step = np.linalg.solve(slope, a.T @ (y - p) - ridge @ weights)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ weights, -30, 30))), 1e-9, 1 - 1e-9)
    likelihood = float(np.log(np.where(y == 1, p, 1 - p)).mean())
    return [float(weights[0]), *map(float, weights[1:] / scale)], likelihood


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[int, list[int], list[float]]:
    """The discount, features and weights of the best likelihood, less one for each weight."""
    fits = []
    for k in range(len(DISCOUNTS)):
        for chosen in FEATURE_SETS:
            weights, likelihood = fit(x[:, k, chosen] if len(y) else np.zeros((0, len(chosen))), y)
            fits.append((likelihood - len(weights) / max(1, len(y)), k, chosen, weights))
    return max(fits, key=lambda f: f[0])[1:]


def train_rows(id_column: str = "doc_id") -> Column:
    """Rows whose label may be learned: crc32 of the id as text, modulo 4, is not 2."""
    return ~_held_out(id_column)


def _held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(row columns of docs without text) and ``score`` of every document."""
    spark = docs.sparkSession
    ids, toxic = _labelled(labels, train_rows(), max_labelled)
    aside = _set_aside(ids)
    table = counts(docs, ids[~aside], toxic[~aside])
    learned = Model(table)
    drop(table)
    if len(learned.words):  # else a class has no sample
        contexts = left_contexts(docs)  # first, so that its shuffles do not meet the pairs on disk
        pairs = pair_counts(docs, ids[~aside], toxic[~aside])
        learned.add_pairs(pairs, contexts)
        drop(pairs)
        drop(contexts)
    model = spark.sparkContext.broadcast(learned)
    names = [c for c in docs.columns if c not in ("text", "__features__")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.concatenate([
            model.value.features(words) for words in W.split(batch.column("text"), "alnum", fold=True)
        ])
        flat = found.reshape(len(found), -1)
        bounds = np.arange(len(found) + 1, dtype=np.int32) * flat.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.ravel().astype(np.float32)))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists], [*names, "__features__"])

    kept = docs.select(columns(names))
    rows = cut(map_arrow(docs.select(*columns(names), "text"), work, f"{ddl(kept)}, __features__ array<float>"), "features")
    chosen = spark.createDataFrame(
        pa.table({"_id": pa.array(ids[aside]), "_toxic": pa.array(toxic[aside].astype(np.int32))})
    )
    known = rows.select("doc_id", "__features__").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")
    ).select("__features__", "_toxic").toArrow()  # of the bounded sample
    y = known.column("_toxic").to_numpy().astype(float)
    x = np.array(known.column("__features__").to_pylist(), float).reshape(len(y), len(DISCOUNTS), FEATURES)
    k, used, weights = _calibrated(x, y if len(y) else toxic[:0].astype(float))
    total = F.lit(weights[0])
    for feature, weight in zip(used, weights[1:], strict=True):
        total = total + F.col("__features__")[FEATURES * k + feature].cast("double") * weight
    return rows.withColumn("score", 1 / (1 + F.exp(-total))).drop("__features__")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs.select("doc_id", "text"), labels).select(
        "doc_id", _held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )


@aside
def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, each judged by its own text."""
    docs, row = told_apart(docs)
    narrow = docs.select("doc_id", "text", *([row] if row != "doc_id" else []))
    toxic = score(narrow, labels).where(F.col("score") >= CUTOFF)
    return without(docs, toxic.select(row), row)
