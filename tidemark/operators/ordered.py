"""Row numbers, neighbours and running counts per ordered group, safe for hot groups.

Ordinary groups use plain window functions. For hot groups the rows are range-partitioned
by (group, order): every range partition is one contiguous *segment*. Windows run inside
each segment, one small summary row per (group, segment) gives what the earlier segments
carry in, and a broadcast join adds it. The result equals the plain window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.skew import (
    DETECT,
    broadcast_if_small,
    cut_lineage,
    known_or_detected,
    left_join,
    null_safe,
    prefixed,
    quoted,
)


@dataclass
class Ordering:
    """What to compute over ``group`` in ``order`` (which must be unique within a group)."""

    group: list[str]
    order: list[str]
    number: str
    lags: dict[str, str] = field(default_factory=dict)
    leads: dict[str, str] = field(default_factory=dict)


def windowed(rows: DataFrame, spec: Ordering) -> DataFrame:
    """Plain window functions."""
    window = W.partitionBy(*spec.group).orderBy(*spec.order)
    columns = {spec.number: F.row_number().over(window).cast("bigint")}
    columns |= {out: F.lag(source).over(window) for out, source in spec.lags.items()}
    columns |= {out: F.lead(source).over(window) for out, source in spec.leads.items()}
    return rows.withColumns(columns)


def _segment(rows: DataFrame, spec_group: list[str], order: list[str], segments: int) -> DataFrame:
    return cut_lineage(
        rows.repartitionByRange(segments, *spec_group, *order).withColumn(
            "_segment", F.spark_partition_id()
        )
    )


def _spanning(summary: DataFrame, group: list[str]) -> DataFrame:
    """Summary rows of groups in more than one segment: at most two per segment."""
    return summary.withColumn("_parts", F.count("*").over(W.partitionBy(*group))).where(
        "_parts > 1"
    )


def segmented(rows: DataFrame, spec: Ordering, segments: int) -> DataFrame:
    """The same columns as :func:`windowed`, with no task larger than a segment."""
    rows = _segment(rows, spec.group, spec.order, segments)
    names = rows.columns
    inner = Ordering(spec.group + ["_segment"], spec.order, "_pos", spec.lags, spec.leads)
    local = windowed(rows, inner)

    at = F.struct(*spec.order)
    last = F.struct(F.lit(True).alias("_set"), *[F.col(c).alias(o) for o, c in spec.lags.items()])
    first = F.struct(F.lit(True).alias("_set"), *[F.col(c).alias(o) for o, c in spec.leads.items()])
    summary = rows.groupBy(*spec.group, "_segment").agg(
        F.count("*").alias("_n"),
        F.max_by(last, at).alias("_last"),
        F.min_by(first, at).alias("_first"),
    )
    by_segment = W.partitionBy(*spec.group).orderBy("_segment")
    carry = _spanning(summary, spec.group).select(
        *spec.group,
        F.col("_segment"),
        F.col("_n"),
        F.sum("_n").over(by_segment.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.lag("_last").over(by_segment).alias("_prev"),
        F.lead("_first").over(by_segment).alias("_next"),
    )
    keys = spec.group + ["_segment"]
    side = broadcast_if_small(prefixed(carry, keys), 2 * segments)
    joined = local.join(side, null_safe(local, side, keys), "left")
    columns = {spec.number: F.col("_pos") + F.coalesce(F.col("_before"), F.lit(0))}
    for out in spec.lags:
        columns[out] = F.when(F.col("_pos") == 1, F.col("_prev")[out]).otherwise(F.col(out))
    for out in spec.leads:
        columns[out] = F.when(F.col("_pos") == F.col("_n"), F.col("_next")[out]).otherwise(
            F.col(out)
        )
    joined = joined.withColumns(columns)
    kept = [c for c in names if c != "_segment"]
    return joined.select(*quoted(kept + [c for c in columns if c not in kept]))


def ordered_columns(rows: DataFrame, spec: Ordering, hot=DETECT) -> DataFrame:
    """Number rows and take neighbours; hot groups go by segments.

    ``hot`` may hold groups of a coarser key (users, where the group is a session).
    """
    hot = known_or_detected(hot, rows, spec.group)
    if hot is None:
        return windowed(rows, spec)
    ordinary, large = hot.split(rows)
    return windowed(ordinary, spec).unionByName(segmented(large, spec, hot.segments()))


def windowed_running_count(
    rows: DataFrame, group: list[str], order: str, hit, out: str
) -> DataFrame:
    """Running count of ``hit`` in which rows of equal ``order`` are peers."""
    window = (
        W.partitionBy(*group).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    return rows.withColumn(out, F.count_if(hit).over(window))


def _segmented_sum(
    rows: DataFrame, group: list[str], order: list[str], weight: str, out: str, segments: int
) -> DataFrame:
    """Running sum of a weight by segments; ``order`` is unique within a group."""
    rows = _segment(rows, group, order, segments)
    names = [c for c in rows.columns if c != "_segment"]
    by_segment = W.partitionBy(*group).orderBy("_segment")
    totals = rows.groupBy(*group, "_segment").agg(F.sum(weight).alias("_total"))
    carry = _spanning(totals, group).select(
        *group,
        "_segment",
        F.sum("_total").over(by_segment.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
    )
    keys = group + ["_segment"]
    side = broadcast_if_small(prefixed(carry, keys), 2 * segments)
    within = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = rows.withColumn("_running", F.sum(weight).over(within))
    return summed.join(side, null_safe(summed, side, keys), "left").select(
        *quoted(names), (F.col("_running") + F.coalesce(F.col("_before"), F.lit(0))).alias(out)
    )


def segmented_running_count(
    rows: DataFrame, group: list[str], order: str, hit, out: str, segments: int
) -> DataFrame:
    """Same as :func:`windowed_running_count` by segments.

    Peers are combined first, so copies of one moment never meet in one task, and the
    counts are joined back by moment (a moment with many copies by broadcast).
    """
    moments = rows.groupBy(*group, order).agg(F.count_if(hit).alias("_hits"))
    counted = _segmented_sum(moments, group, [order], "_hits", out, segments).drop("_hits")
    return left_join(rows, counted, group + [order], nulls_match=True)


def segmented_with_copies(
    rows: DataFrame, group: list[str], order: list[str], number: str, segments: int, chunk: int
) -> DataFrame:
    """Row numbers by segments where whole rows may repeat any number of times.

    Equal rows are counted first, numbered as one, and written out again in chunks spread
    over tasks.
    """
    names = rows.columns
    kinds = rows.groupBy(*quoted(names)).agg(F.count("*").alias("_copies"))
    ended = _segmented_sum(kinds, group, order, "_copies", "_end", segments)
    parts = ended.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {chunk}")))
    ).repartition(*group, *order, "_chunk")
    first = F.col("_chunk") * chunk + 1
    last = F.least((F.col("_chunk") + 1) * chunk, F.col("_copies"))
    return parts.withColumn("_copy", F.explode(F.sequence(first, last))).select(
        *quoted(names), (F.col("_end") - F.col("_copies") + F.col("_copy")).alias(number)
    )


def newest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key in this order.

    The rank filter lets Spark keep one row per key in each map task before the shuffle,
    so a key with a large share of the rows costs no more than the others.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
