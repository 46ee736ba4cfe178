"""Run control that is data work: logs, recovery list, schema drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COUNT_METRICS = ["mst_event_params_cnt", "mst_item_params_cnt"]
WIDTH_METRICS = ["micro_user_columns_cnt", "micro_items_columns_cnt"]


def run_status_summary(log: DataFrame) -> DataFrame:
    """Runs, rows and day range per status."""
    return log.groupBy("phase_0_status").agg(
        F.count("*").alias("runs"),
        F.sum("total_rows").alias("total_rows"),
        F.min("end_date").alias("first_day"),
        F.max("end_date").alias("last_day"),
    )


def recoverable_days(log: DataFrame, shard_counts: DataFrame, cutoff: str) -> DataFrame:
    """Days logged as skipped since the cutoff whose source shard now has rows.

    Each day comes once, and not if a run of that day has succeeded.
    """
    recent = log.where(F.col("end_date") >= cutoff)
    skipped = recent.where(F.col("phase_0_status").like("SKIPPED%")).select("end_date").distinct()
    done = recent.where(F.col("phase_0_status") == "SUCCESS").select("end_date")
    filled = shard_counts.where("row_count > 0").select(F.col("shard").alias("end_date"))
    return skipped.join(filled, "end_date", "left_semi").join(done, "end_date", "left_anti")


def changed_fields(previous: dict[str, Column], current: dict[str, Column]) -> Column:
    """Names of changed metrics: any change of a count, a shrinking or (dis)appearing width."""
    changed = [
        F.when(~previous[m].eqNullSafe(current[m]), F.lit(m)) for m in COUNT_METRICS
    ]
    for m in WIDTH_METRICS:
        appeared = previous[m].isNull() != current[m].isNull()
        shrunk = F.coalesce(current[m] < previous[m], F.lit(False))
        changed.append(F.when(appeared | shrunk, F.lit(m)))
    return F.concat_ws(",", *changed)


def drift_over_snapshots(snapshots: DataFrame, order: str) -> DataFrame:
    """Changed fields of every snapshot against the one before; none for the first.

    One row per run, so the log is small by nature.
    """
    window = W.orderBy(order)
    metrics = COUNT_METRICS + WIDTH_METRICS
    before = {m: F.lag(m).over(window) for m in metrics}
    pairs = snapshots.withColumns(
        {f"_before_{m}": column for m, column in before.items()}
        | {"_first": F.row_number().over(window) == 1}
    )
    fields = changed_fields(
        {m: F.col(f"_before_{m}") for m in metrics}, {m: F.col(m) for m in metrics}
    )
    return pairs.withColumn(
        "changed_fields", F.when(F.col("_first"), F.lit("")).otherwise(fields)
    ).select(*snapshots.columns, "changed_fields")


def latest(log: DataFrame, order: str, tie_breaks: list[str] = ()) -> DataFrame:
    """Newest row of a log."""
    return log.orderBy(F.col(order).desc(), *[F.col(c).desc() for c in tie_breaks]).limit(1)


def schema_drift(previous: dict | None, current: dict) -> list[str]:
    """Changed metrics of two snapshots (the driver-side form of :func:`changed_fields`)."""
    if previous is None:
        return []
    changed = [m for m in COUNT_METRICS if previous.get(m) != current.get(m)]
    for m in WIDTH_METRICS:
        old, new = previous.get(m), current.get(m)
        if old is None or new is None:
            if old != new:
                changed.append(m)
        elif new < old:
            changed.append(m)
    return changed
