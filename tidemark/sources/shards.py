"""Scans of day-sharded parquet datasets.

A dataset is one parquet directory partitioned by ``shard`` (yyyyMMdd text). Shard bounds
are literals, so the scan prunes partitions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.functions.ids import shift_day


def in_shards(rows: DataFrame, start: str, end: str) -> DataFrame:
    return rows.where(F.col("shard").between(start, end))


def widened(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Shards from one day earlier: the local day may begin in the previous shard."""
    return in_shards(rows, shift_day(start, -1), end)


def look_back(rows: DataFrame, start: str, end: str, days: int = S.LOOKBACK_DAYS) -> DataFrame:
    return in_shards(rows, shift_day(start, -days), end)


def read_sharded(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Scan with the given schema; columns the files lack read as NULL."""
    return spark.read.schema(S.ddl(columns)).parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_sharded(spark, path, S.EVENTS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """User snapshot; columns it lacks (``user_id``, ``audiences``) read as NULL."""
    return read_sharded(spark, path, S.USERS)


def marks(spark: SparkSession, path: str, start: str, end: str) -> dict[str, str]:
    """Size, number of files and time of each shard folder in the range, to tell changed shards."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for folder in fs.listStatus(root):
        shard = folder.getPath().getName().removeprefix("shard=")
        if len(shard) == 8 and shard.isdigit() and start <= shard <= end:
            summary = fs.getContentSummary(folder.getPath())
            parts = summary.getLength(), summary.getFileCount(), folder.getModificationTime()
            found[shard] = "/".join(map(str, parts))
    return found


def bytes_of(spark: SparkSession, path: str, start: str, end: str) -> int:
    """Bytes of the shard folders in the range, from the file system's own summary."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    total = 0
    for folder in fs.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith("shard=") and start <= name.removeprefix("shard=") <= end:
            total += fs.getContentSummary(folder.getPath()).getLength()
    return total


def if_present(read, spark: SparkSession, path: str | None) -> DataFrame | None:
    """A dataset that may be absent."""
    if path is None:
        return None
    try:
        return read(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def empty(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    """No rows, as the optimizer can see: a join with them shuffles nothing."""
    typed = [F.lit(None).cast(kind).alias(name) for name, kind in columns.items()]
    return spark.range(1).select(*typed).where(F.lit(False))


def has_rows(rows: DataFrame, start: str, end: str) -> bool:
    """Availability gate: does any shard of the range hold a row?"""
    return not in_shards(rows, start, end).select("shard").isEmpty()


def shard_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard").agg(F.count("*").alias("row_count"))
