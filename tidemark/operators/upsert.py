"""Keyed table changes as joins: upsert, append-if-new, update-from.

Parquet tables have no MERGE, UPDATE or DELETE; each function returns the new content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import broadcast_if_small, null_safe, prefixed, quoted


def upsert_by_key(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    rules: dict[str, Column] | None = None,
) -> DataFrame:
    """Full outer merge on unique keys: new values win, or the rule over ``o.x`` and ``n.x``.

    Columns of ``old`` that ``new`` lacks are kept.
    """
    rules = rules or {}
    flag_old, flag_new = F.col("o._there"), F.col("n._there")
    joined = (
        old.withColumn("_there", F.lit(True))
        .alias("o")
        .join(new.withColumn("_there", F.lit(True)).alias("n"), keys, "full_outer")
    )
    columns = []
    for name in old.columns:
        if name in keys:
            columns.append(F.col(name))
        elif name not in new.columns:
            columns.append(F.col(f"o.{name}").alias(name))
        else:
            both = rules.get(name, F.col(f"n.{name}"))
            columns.append(
                F.when(flag_old.isNotNull() & flag_new.isNotNull(), both)
                .when(flag_new.isNotNull(), F.col(f"n.{name}"))
                .otherwise(F.col(f"o.{name}"))
                .alias(name)
            )
    return joined.select(*columns)


def append_if_new(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose keys are not in ``existing``; NULL keys count as new."""
    return new.join(existing.select(*keys), keys, "left_anti")


def insert_if_absent(rows: DataFrame, constant: DataFrame, keys: list[str]) -> DataFrame:
    """Add constant rows whose keys are missing."""
    missing = constant.join(rows.select(*keys), keys, "left_anti")
    return rows.unionByName(missing, allowMissingColumns=True)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    columns: list[str],
    only: Column | None = None,
    source_rows: int | None = None,
) -> DataFrame:
    """Take ``columns`` from the matching source row (keys unique there, NULL matches NULL).

    A source of ``source_rows`` rows is broadcast if that is within the limits.
    """
    renamed = source.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    side = prefixed(renamed, keys)
    if source_rows is not None:
        side = broadcast_if_small(side, source_rows)
    hit = F.col("_hit").isNotNull()
    if only is not None:
        hit = hit & only
    updated = {c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    joined = target.join(side, null_safe(target, side, keys), "left")
    return joined.withColumns(updated).select(*quoted(target.columns))
