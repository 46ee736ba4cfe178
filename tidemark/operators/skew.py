"""Bounded tasks for groups that may hold a large share of all rows.

A group (a user, a session, all rows without an id) counts as hot when it has more rows
than ``tidemark.hotRows``. Hot groups are found by one map-side-combined count and take a
different way than the rest: their small join side is broadcast, and their ordered windows
run over contiguous segments (see :mod:`tidemark.operators.ordered`). There are at most
``rows / hotRows`` hot groups, so the set of hot keys stays small by construction.
"""

from __future__ import annotations

import contextlib
import functools
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 256 << 20
DEFAULT_PART_ROWS = 4_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_here = threading.local()


def hot_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("tidemark.hotRows", str(DEFAULT_HOT_ROWS)))


def broadcast_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("tidemark.broadcastRows", str(DEFAULT_BROADCAST_ROWS)))


def part_row_limit(spark: SparkSession) -> int:
    """Rows above which a wide write goes in parts, to bound its shuffle files."""
    return int(spark.conf.get("tidemark.partRows", str(DEFAULT_PART_ROWS)))


def broadcast_byte_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("tidemark.broadcastBytes", str(DEFAULT_BROADCAST_BYTES)))


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """Where intermediates go: the folder of the run in this thread, else spark.checkpoint.dir,
    else the warehouse. All executors share each of them."""
    return getattr(_here, "folder", None) or shared_folder(spark)


@contextlib.contextmanager
def working_in(spark: SparkSession, folder: str) -> Iterator[None]:
    """Intermediates of this thread go to ``folder``, which is removed at the end."""
    before, _here.folder = getattr(_here, "folder", None), folder
    try:
        yield
    finally:
        _here.folder = before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def files_go_after_query(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query inside are removed when it ends, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut_lineage(rows: DataFrame) -> DataFrame:
    """Write rows to the work folder and read them back.

    Later steps see the same rows even if an executor is lost, and read only the columns
    they need. Hashes as hex text take half the room under zstd.
    """
    spark = rows.sparkSession
    path = f"{work_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    with files_go_after_query(spark):
        rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def row_bytes(rows: DataFrame) -> int:
    """Spark's estimate of a row's width, from its columns' types."""
    return int(rows._jdf.schema().defaultSize())


def is_small(side: DataFrame, row_bound: int) -> bool:
    """Whether a side of at most this many rows is within the limits of a broadcast."""
    spark = side.sparkSession
    small = row_bound <= broadcast_row_limit(spark)
    return small and row_bound * row_bytes(side) <= broadcast_byte_limit(spark)


def broadcast_if_small(side: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast hint, given a proven upper bound of the row count and the rows' width."""
    return F.broadcast(side) if is_small(side, row_bound) else side


def quoted(names: list[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col(quote(name)) for name in names]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "_r_") -> Column:
    """Join condition in which NULL keys match; right keys carry a prefix."""
    return functools.reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys]
    )


def prefixed(side: DataFrame, keys: list[str], prefix: str = "_r_") -> DataFrame:
    return side.withColumnsRenamed({k: prefix + k for k in keys})


class HotGroups:
    """Keys of the groups above the row limit."""

    def __init__(self, frame: DataFrame, keys: list[str]):
        self.frame, self.keys = frame, keys
        found = frame.agg(F.count("*"), F.coalesce(F.sum("hot_rows"), F.lit(0))).first()
        self.groups, self.rows = found[0], found[1]

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of ordinary groups, rows of hot groups)."""
        side = broadcast_if_small(
            prefixed(self.frame.select(*self.keys), self.keys), self.groups
        )
        on = null_safe(rows, side, self.keys)
        return rows.join(side, on, "left_anti"), rows.join(side, on, "left_semi")

    def narrow(self, side: DataFrame) -> DataFrame:
        """Rows of a unique-keyed side that belong to hot groups, broadcast when small."""
        return broadcast_if_small(self.split(side)[1], self.groups)

    def segments(self) -> int:
        """Number of range partitions that keeps each below the row limit on average."""
        return max(2, -(-2 * self.rows // hot_row_limit(self.frame.sparkSession)))


def hot_groups(
    rows: DataFrame, keys: list[str], weight: Column | None = None
) -> HotGroups | None:
    """Groups above the row limit, or None. Runs one aggregation over the key columns.

    ``weight`` is the number of rows that a row will become, such as the size of an array
    that is exploded later.
    """
    number = F.count("*") if weight is None else F.sum(F.greatest(weight, F.lit(0)).cast("bigint"))
    hot = (
        rows.groupBy(*keys)
        .agg(number.alias("hot_rows"))
        .where(F.col("hot_rows") > hot_row_limit(rows.sparkSession))
    )
    found = HotGroups(cut_lineage(hot), keys)  # written once, then only counted
    return found if found.groups else None


DETECT = object()


def known_or_detected(hot, rows: DataFrame, keys: list[str]) -> HotGroups | None:
    """A caller that already knows the hot groups passes them (or None) instead of DETECT."""
    return hot_groups(rows, keys) if hot is DETECT else hot


def left_join(
    rows: DataFrame,
    side: DataFrame,
    keys: list[str],
    nulls_match: bool = False,
    hot=DETECT,
) -> DataFrame:
    """Left equi-join with a unique-keyed side; rows of hot keys meet a broadcast copy."""
    names = rows.columns
    added = [c for c in side.columns if c not in keys]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        if not nulls_match:
            return left.join(right, keys, "left").select(*quoted(names + added))
        right = prefixed(right, keys)
        return left.join(right, null_safe(left, right, keys), "left").select(*quoted(names + added))

    hot = known_or_detected(hot, rows, keys)
    if hot is not None and hot.keys != keys:
        raise ValueError(f"hot groups of {hot.keys} say nothing about {keys}")
    if hot is None:
        return joined(rows, side)
    cold_rows, hot_rows = hot.split(rows)
    return joined(cold_rows, side).unionByName(joined(hot_rows, hot.narrow(side)))
