"""Exact dedup: groups by a 128-bit content hash, one row of each group stays (no Python in tasks).

Rows meet by the MD5 of the text. Inside each group the bytes are compared by the smallest and
the largest text: they are equal only if all texts of the group are. Both are aggregates with a
map-side part, so a group that holds any share of all rows costs each task one row. A hash with
different texts (a collision) is grouped again by the text itself, and its rows are joined by it.

Defined cases: null counts as the empty text; of equal texts the row with the smallest id stays
(``keep="smallest"``) or the one with the largest; null ids come last in either case and stay
only if the group has no other id; rows that repeat both text and id are one document listed
repeatedly and share its result in :func:`groups`; :func:`deduplicate` keeps one of them; other
columns pass through it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import aside, cut, told_apart, without


def groups(docs: DataFrame, keep: str = "smallest", id_column: str = "doc_id",
           hashed=F.md5) -> DataFrame:
    """One row per row of docs: (id_column, keep_id, group_size, kept, text_sha256).

    ``hashed`` is a parameter for tests of collisions."""
    chosen = F.min("_id") if keep == "smallest" else F.max("_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("_id"), text.alias("_text"), hashed(text.cast("binary")).alias("_hash")
    )
    found = cut(
        rows.groupBy("_hash").agg(
            chosen.alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
            (F.min("_text") == F.max("_text")).alias("_equal"),
        ), "exact",
    )
    narrow = rows.select("_id", "_hash", F.sha2(F.col("_text"), 256).alias("text_sha256"))
    out = narrow.join(found.where("_equal").drop("_equal"), "_hash").drop("_hash")
    mixed = found.where(~F.col("_equal")).select("_hash")
    if not mixed.isEmpty():
        clash = rows.join(mixed, "_hash", "left_semi")
        exact = clash.groupBy("_text").agg(
            chosen.alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        rest = clash.join(exact, "_text").select(
            "_id", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size"
        )
        out = out.unionByName(rest)
    return out.select(
        F.col("_id").alias(id_column), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


@aside
def deduplicate(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each text.

    Where ids repeat or are null, rows are told apart by a number; of equal texts the row with the
    smallest (largest) id stays, of rows equal in both the first (last) one."""
    docs, row = told_apart(docs)
    if row != "doc_id":
        ids = docs.select(F.struct(F.col("doc_id").isNull() == (keep == "smallest"), "doc_id", row).alias("id"), "text")
        found = groups(ids, keep, "id")
        return without(docs, found.where("not kept").select(f"id.{row}"), row)
    return without(docs, groups(docs, keep).where("not kept").select("doc_id"), row)
