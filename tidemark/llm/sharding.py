"""Sharding by jump consistent hashing, in DataFrame expressions only.

A stable key goes to one of n shards by the jumps of Lamping and Veach: from shard b the next
jump goes to floor((b + 1) * 2**31 / (r + 1)), r being the upper 31 of the key's next random
bits, until it passes n. There is no ring or table; with one more shard a row stays or moves
into the new one. The 64-bit linear congruential step is done in decimals, which hold the whole
product, so nothing overflows.

Defined cases: a null key is a key of its own (it goes where key 0 goes); null text has no
bytes; rows with equal keys share a shard and get different slots; no row, no result; columns
named shard or slot are replaced; other
columns pass through :func:`shard` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import aside, quote, with_rank

#: Jumps that are unrolled; more are needed once in 10**20 rows and then done one by one.
JUMPS = 64
_TWO_64 = "cast(18446744073709551616 as decimal(20,0))"


def _jumps(key: Column, shards: Column, steps: Column) -> Column:
    """State (b, j, key) after at most ``steps`` jumps of which the last passes the shards."""
    start = F.struct(
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
        F.pmod(key.cast("decimal(20,0)"), F.expr(_TWO_64)).cast("decimal(20,0)").alias("k"),
    )

    def jump(state: Column, _: Column) -> Column:
        product = state["k"] * F.lit(2862933555777941757).cast("decimal(19,0)")
        after = F.pmod(product + F.lit(1).cast("decimal(1,0)"), F.expr(_TWO_64)).cast("decimal(20,0)")
        bits = F.floor(after / F.lit(2**33).cast("decimal(10,0)")).cast("long")
        place = F.floor(
            (state["j"] + 1).cast("double") * (F.lit(float(2**31)) / (bits + 1).cast("double"))
        ).cast("long")
        moved = F.struct(state["j"].alias("b"), place.alias("j"), after.alias("k"))
        return F.when(state["j"] < shards, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), steps), start, jump)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long key."""
    n = F.lit(shards).cast("long")
    key = F.coalesce(key.cast("long"), F.lit(0))
    few = _jumps(key, n, F.lit(JUMPS))
    return F.when(few["j"] >= n, few["b"]).otherwise(_jumps(key, n, F.lit(shards + 1))["b"]).cast("int")


@aside
def shard(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """docs with ``shard``, and ``slot``, the place of the row in its shard (from 0, no gaps)."""
    placed = docs.withColumn("shard", jump_hash(F.col(key), shards))
    others = [c for c in docs.columns if c not in (key, "shard", "slot")]
    return with_rank(placed, "shard", [quote(c) for c in (key, *others)], "slot")


def report(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
