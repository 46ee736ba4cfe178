"""Mixing sources to target weights: block draws by shard, slots mapped through permutations.

The words of a source, its documents in order of id, are one stream that is cut into blocks of
``block_words`` words (the last may be shorter). Each source gets a quota of words: its share by
weight, at most ``most`` times its own words, the excess reshared by weight until no source is
above its limit. The quota is a number of slots; a multinomial draw gives how many of them go to
each output shard, so quotas hold exactly while the mix of a shard is random. Slot j of a source
takes block ``permute(j mod blocks)`` of pass ``j div blocks``; the permutation is a swap-or-not
shuffle keyed by seed, source and pass, computed slot by slot, so no table of a source's blocks
is ever gathered. The last slot of a source takes the first words of its block only, so a source
gives its target rounded to whole words. Slots and blocks are joined by (source, block).

Every draw depends on seed, source number and pass alone, so reruns agree. A pass holds each
block once, so no document is taken more than ``most`` times (rounded up) its size.

Tasks hold ``CHUNK_SLOTS`` slots, or one row per (source, shard); a source with any share of the
words is spread over its blocks. Quotas are found by sums over the table of sources, of which one
row reaches the driver in each round.

Defined cases: null text has no words and is never taken; a null source is a source of its own
and the last one; null ids come first; rows equal in id keep their places by size; repeated rows
are documents of their own; sources without words have target 0; no documents, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ordering import ascending, ordered
from tidemark.llm.words import mix
from tidemark.llm.work import cut, map_arrow, map_batches

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 256
SHARDS = 40
SEED = 42
CHUNK_SLOTS = 65_536
TASK_SLOTS = 4 * CHUNK_SLOTS
#: Rounds of the swap-or-not shuffle: six for each bit of 2**16 blocks, as its analysis asks.
ROUNDS = 96
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- permutations ----------------------------------------------------------------------------


def _round(x: np.ndarray, n: np.ndarray, key: np.ndarray, number: int) -> np.ndarray:
    """One round: swap x with its partner, or not, as a bit of both decides. It is its own inverse."""
    turn = mix(key + np.uint64((2 * number + 1) * 0x9E3779B97F4A7C15 % 2**64))
    partner = (turn % n + n - x) % n
    bit = mix(np.maximum(x, partner) ^ mix(turn + _GOLDEN)) >> np.uint64(63)
    return np.where(bit == 1, partner, x)


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Places of x (0..n-1) under the permutation of n things that ``key`` names; all are arrays."""
    x, n, key = (np.asarray(a).astype(np.uint64) for a in (x, n, key))
    for number in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        x = _round(x, n, key, number)
    return x.astype(np.int64)


def keys(seed: int, source: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Key of a source's permutation in pass ``number``."""
    start = mix(np.asarray([seed], np.uint64) + _GOLDEN)
    return mix(mix(start ^ np.asarray(source).astype(np.uint64)) + np.asarray(number).astype(np.uint64))


# -- quotas ----------------------------------------------------------------------------------


def water_level(sources: DataFrame, most: int) -> float:
    """Words per unit of weight such that targets, each at most its limit, use all words."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * most
    level, capped = 0.0, -1
    while True:
        above = (F.col("weight") * F.lit(level)) > limit
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.sum(F.when(~above, F.col("weight"))), F.count_if(above),
        ).first()
        if row[2] == capped or not row[1]:
            return level
        capped = row[2]
        level = (total - row[0]) / row[1]


def quotas(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (number, source_size, weight) with ``target``, the words it shall give."""
    level = water_level(sources, most)
    share = F.col("weight") * F.lit(level)
    limit = (F.col("source_size") * most).cast("double")
    return sources.withColumn("target", F.least(share.cast("double"), limit))


# -- the mix ---------------------------------------------------------------------------------


def numbered(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
    source_weights: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with number of the source, place and first word there; sources with target).

    ``docs`` has doc_id, source, size and what else shall go along. Weights repeat over the sources by code point; ``source_weights`` (source, weight) gives
    them by name instead, 0 where it names none.
    """
    in_order = ordered(
        docs, ["source"], [ascending("doc_id"), ascending("size")], "size",
        group_order=[F.col("source").asc_nulls_last()],
    )
    found = cut(in_order.parts.groupBy("source").agg(F.max("_group_sum").alias("source_size")), "sources")
    sources = ordered(found, [], [F.col("source").asc_nulls_last()]).placed().select(
        "source", "source_size", F.col("_place").alias("number")
    )
    if source_weights is None:
        cycle = F.array(*[F.lit(w) for w in weights])
        sources = sources.withColumn("weight", F.get(cycle, (F.col("number") % len(weights)).cast("int")))
    else:
        named = source_weights.select(F.col("source").alias("named"), "weight")
        sources = sources.join(named, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
        sources = sources.withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)))
    sources = cut(quotas(cut(sources, "sources"), most), "sources")
    side = sources.select(F.col("source").alias("named"), "number", "source_size", "target")
    parts = in_order.parts.join(side, in_order.parts["source"].eqNullSafe(side["named"])).drop("named")
    placed = in_order.placed(cut(parts, "parts")).withColumnsRenamed(
        {"_place": "place", "_before": "first_word"}
    )
    return placed.drop("_group_rows", "_group_sum"), sources


def shard_counts(sources: DataFrame, shards: int, block_words: int, seed: int) -> DataFrame:
    """(number, source_size, blocks, shard, first_slot, slots, last_slot, last_words): the slots
    of a source that an output shard gets; the source's last slot takes ``last_words`` words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        number, size, target = (np.asarray(batch.column(i)) for i in range(3))
        words = np.floor(target + 0.5).astype(np.int64)
        blocks = -(-size // block_words)
        passes, rest = words // size, words % size
        short = size - (blocks - 1) * block_words
        at = permute(blocks - 1, blocks, keys(seed, number, passes), inverse=True)
        # slots of the unfinished pass: its short block may be among them
        slots = -(-rest // block_words)
        lost = np.where(at < slots, block_words - short, 0)
        more = slots * block_words - lost < rest
        slots = slots + more
        held = (slots - 1) * block_words - np.where(at < slots - 1, block_words - short, 0)
        last = np.where(rest > 0, rest - held, block_words)
        total = passes * blocks + slots
        drawn = np.concatenate([
            np.random.default_rng([seed, int(s)]).multinomial(n, np.full(shards, 1 / shards))
            for s, n in zip(number, total, strict=True)
        ])
        firsts = np.cumsum(drawn.reshape(-1, shards), axis=1).ravel() - drawn
        each = lambda values: pa.array(np.repeat(values, shards))
        return pa.record_batch(
            [each(number), each(size), each(blocks), pa.array(np.tile(np.arange(shards), len(number))),
             pa.array(firsts), pa.array(drawn), each(total - 1), each(last)],
            ["number", "source_size", "blocks", "shard", "first_slot", "slots", "last_slot", "last_words"],
        )

    some = sources.where("source_size > 0").select("number", "source_size", "target")
    return map_arrow(
        some, work, "number long, source_size long, blocks long, shard long, first_slot long, "
        "slots long, last_slot long, last_words long",
    ).where("slots > 0")


def slots(sources: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(shard, number, pass, block, words) of every slot of the mix, as a written table.

    Its few input rows say nothing about its size, so tasks are counted by slots, and the table
    is written before a join chooses its way by it.
    """
    counts = shard_counts(sources, shards, block_words, seed)
    total = counts.agg(F.sum("slots")).first()[0] or 0
    tasks = 1 + total // TASK_SLOTS
    chunks = counts.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {CHUNK_SLOTS}")))
    ).repartition(tasks, "number", "shard", "chunk")

    def one(row: dict) -> pa.RecordBatch:
        begin = row["first_slot"] + row["chunk"] * CHUNK_SLOTS
        end = min(begin + CHUNK_SLOTS, row["first_slot"] + row["slots"])
        slot = np.arange(begin, end)
        n = np.full(len(slot), row["blocks"])
        number = slot // n
        source = np.full(len(slot), row["number"])
        block = permute(slot % n, n, keys(seed, source, number))
        words = np.minimum(block_words, row["source_size"] - block * block_words)
        words = np.where(slot == row["last_slot"], np.minimum(words, row["last_words"]), words)
        columns = [np.full(len(slot), row["shard"]), source, number, block, words]
        return pa.record_batch([pa.array(c) for c in columns], ["shard", "number", "pass", "block", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield one(row)

    return cut(
        map_batches(chunks, run, "shard long, number long, pass long, block long, words long"), "slots"
    )


def pieces(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(number, block, place, at, from_word, length, ...): the part of each document in each block.

    ``at`` counts words from the block's first, ``from_word`` from the document's first.
    """
    first, end = F.col("first_word"), F.col("first_word") + F.col("size")
    span = F.sequence(F.expr(f"first_word div {block_words}"), F.expr(f"(first_word + size - 1) div {block_words}"))
    cut_up = documents.where("size > 0").withColumn("block", F.explode(span))
    begin = F.greatest(F.col("block") * block_words, first)
    return cut_up.withColumns(
        {
            "at": begin - F.col("block") * block_words,
            "from_word": begin - first,
            "length": F.least((F.col("block") + 1) * block_words, end) - begin,
        }
    )


def taken(drawn: DataFrame, parts: DataFrame) -> DataFrame:
    """Slots joined with the parts of their blocks; ``used`` is how many words of a part count."""
    joined = drawn.join(parts, ["number", "block"])
    return joined.withColumn(
        "used", F.least(F.col("length"), F.greatest(F.col("words") - F.col("at"), F.lit(0)))
    ).where("used > 0")


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS,
    block_words: int = BLOCK_WORDS, most: int = MOST, seed: int = SEED,
    source_weights: DataFrame | None = None,
) -> DataFrame:
    """The mix: (shard, source, pass, block, at, doc_id, from_word, used, text), one row for each
    part of a document in a slot, with its words joined by single blanks."""
    sized = docs.select("doc_id", "source", "text", n_words(F.col("text")).alias("size"))
    documents, sources = numbered(sized, weights, most, source_weights)
    documents = cut(documents, "documents")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    parts = pieces(documents, block_words).withColumn(
        "text", F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), F.col("length").cast("int")), " ")
    )
    got = taken(slots(sources, shards, block_words, seed), parts)
    shortened = F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("used").cast("int")), " ")
    return got.select(
        "shard", "source", "pass", "block", "at", "doc_id", "from_word", "used",
        F.when(F.col("used") < F.col("length"), shortened).otherwise(F.col("text")).alias("text"),
    )


def report(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS,
    block_words: int = BLOCK_WORDS, most: int = MOST, seed: int = SEED,
    source_weights: DataFrame | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    sized = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    documents, sources = numbered(sized, weights, most, source_weights)
    documents = cut(
        documents.select("doc_id", "number", "place", "first_word", "size", "source_size", "target"), "documents"
    )
    parts = pieces(documents.select("number", "place", "first_word", "size"), block_words)
    got = taken(slots(sources, shards, block_words, seed), parts)
    sums = got.groupBy("number", "place").agg(F.sum("used").alias("taken"))
    return documents.join(sums, ["number", "place"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
