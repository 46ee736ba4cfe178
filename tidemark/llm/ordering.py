"""Places of rows in one order over many tasks: ranks and running sums without a hot task.

Rows are range-partitioned by (group, order), so a group of any size spans as many partitions
as it fills. The partition's number is written with the rows, one small row for each (group,
partition) carries what lies before it, and a window inside the partition adds the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.work import cut


def ascending(column: str) -> Column:
    return F.col(column).asc_nulls_first()


@dataclass
class Ordered:
    """Rows of groups in order, and one row for each (group, partition).

    ``parts`` holds group, ``_part``, ``_base`` (rows of the group in earlier partitions),
    ``_base_sum`` (their weight), ``_group_rows`` and ``_group_sum``.
    """

    rows: DataFrame
    parts: DataFrame
    group: list[str]
    order: list[Column]
    weight: str | None

    def placed(self, parts: DataFrame | None = None) -> DataFrame:
        """Rows with ``_place`` (from 0) and ``_before`` (weight before them in their group).

        ``parts`` may carry more columns of the groups, which the rows then get, too.
        """
        parts = self.parts if parts is None else parts
        inner = Window.partitionBy(*self.group, "_part").orderBy(*self.order)
        local = self.rows.withColumn("_in", F.row_number().over(inner) - 1)
        sums = F.lit(0).cast("long")
        if self.weight:
            before = inner.rowsBetween(Window.unboundedPreceding, -1)
            sums = F.coalesce(F.sum(self.weight).over(before), sums)
        local = local.withColumn("_in_sum", sums)
        side = parts.withColumnsRenamed({c: f"_r{c}" for c in [*self.group, "_part"]})
        same = local["_part"] == side["_r_part"]
        for c in self.group:
            same = same & local[c].eqNullSafe(side[f"_r{c}"])
        return (
            local.join(side, same)
            .withColumn("_place", F.col("_base") + F.col("_in"))
            .withColumn("_before", F.col("_base_sum") + F.col("_in_sum"))
            .drop("_in", "_in_sum", "_part", "_r_part", *[f"_r{c}" for c in self.group], "_base", "_base_sum")
        )


def ordered(
    rows: DataFrame, group: list[str], order: list[Column], weight: str | None = None,
    group_order: list[Column] | None = None,
) -> Ordered:
    """Deal rows into ranges of (group, order); ties of ``order`` are placed in any order."""
    first = [ascending(c) for c in group] if group_order is None else group_order
    dealt = cut(
        rows.repartitionByRange(*first, *order).withColumn("_part", F.spark_partition_id()), "order"
    )
    total = F.sum(weight) if weight else F.lit(0)
    sizes = dealt.groupBy(*group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), total.cast("long").alias("_sum")
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = sizes.select(
        *group, "_part",
        F.coalesce(F.sum("_n").over(before), zero).alias("_base"),
        F.coalesce(F.sum("_sum").over(before), zero).alias("_base_sum"),
        F.sum("_n").over(whole).alias("_group_rows"),
        F.sum("_sum").over(whole).alias("_group_sum"),
    )
    return Ordered(dealt, cut(parts, "parts"), group, order, weight)
