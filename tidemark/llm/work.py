"""Small helpers that the corpus operators share: tables, lineage cuts, ranks without hot tasks."""

from __future__ import annotations

import contextlib
import functools
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that numpy handles at once inside a task.
CHUNK_BYTES = 2 << 20
#: Rows of one rank block; a block is the unit one task sorts.
RANK_BLOCK_ROWS = 100_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which all executors share; the warehouse where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


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


def cut(rows: DataFrame, label: str = "step") -> DataFrame:
    """Write rows to the shared folder and read them back.

    Later steps see the same rows, even if an executor is lost, and read only the columns
    that they need. The folder outlives the query, since its result is lazy.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    with files_go_after_query(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def drop(rows: DataFrame) -> None:
    """Delete a table that :func:`cut` wrote and nothing reads any more."""
    spark = rows.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        if "/llm-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def columns(names: list[str]) -> list[Column]:
    """Columns by name, whatever signs the names hold."""
    return [F.col(quote(name)) for name in names]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl(rows: DataFrame) -> str:
    """The columns as DDL, with field names inside of types quoted where they need it."""
    fields = rows._jdf.schema()
    return ", ".join(f"{quote(name)} {fields.apply(name).dataType().sql()}" for name in rows.columns)


def aside(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Columns of the first argument that begin with an underscore, like the operator's own working
    columns, have other names while it runs."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = {c: f"kept {n}" for n, c in enumerate(docs.columns) if c.startswith("_")}
        found = operator(docs.withColumnsRenamed(names), *args, **options)
        return found.withColumnsRenamed({new: old for old, new in names.items()})

    return run


def told_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """(docs, a column that names single rows): ``doc_id`` where it is unique and never null, else
    a number that is written with the rows."""
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if twice.where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs, "doc_id"
    return cut(docs.withColumn("_row", F.monotonically_increasing_id()), "rows"), "_row"


def without(docs: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """docs without the rows that ``gone`` (one column) names by their column ``row``."""
    side = gone.toDF("_gone").distinct()
    return docs.join(side, docs[row] == side["_gone"], "left_anti").drop("_row")


def workers_import(spark: SparkSession) -> None:
    """Python workers also look for this library where the driver has it.

    On a cluster whose machines lack that path the library comes with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_batches(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` whose workers find this library (see :func:`workers_import`)."""
    workers_import(rows.sparkSession)
    names = rows.columns
    if not any(sign in name for name in names for sign in ".`"):
        return rows.mapInArrow(run, schema)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.rename_columns(names) for b in batches)

    plain = rows.toDF(*(f"c{i}" for i in range(len(names))))  # mapInArrow takes no dots and ticks
    return plain.mapInArrow(renamed, schema)


def map_arrow(
    rows: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """:func:`map_batches` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if out is not None and out.num_rows:
                    yield out

    return map_batches(rows, run, schema)


def with_rank(rows: DataFrame, group: str, order: list[str], rank: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, at bounded rows a task.

    Rows are dealt to blocks by a hash of ``order``; a block of a group is numbered by one
    window, and the sizes of a group's earlier blocks are added. So a group that holds any
    share of all rows is spread over many tasks, and only (group, block) counts meet. Rows
    that are equal in ``order`` stay together; their mutual order is open.
    """
    blocks = max(1, -(-rows.count() // RANK_BLOCK_ROWS))
    dealt = rows.withColumn("__block__", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = dealt.groupBy(group, "__block__").agg(F.count(F.lit(1)).alias("__size__"))
    before = Window.partitionBy(group).orderBy("__block__").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = sizes.select(
        F.col(group).alias("__group__"), F.col("__block__").alias("__base_block__"),
        F.coalesce(F.sum("__size__").over(before), F.lit(0)).alias("__base__"),
    )
    inner = Window.partitionBy(group, "__block__").orderBy(*order)
    numbered = dealt.withColumn("__in__", F.row_number().over(inner) - 1)
    same: Column = F.col(group).eqNullSafe(F.col("__group__")) & (
        F.col("__block__") == F.col("__base_block__")
    )
    return (
        numbered.join(bases, same)
        .withColumn(rank, F.col("__base__") + F.col("__in__"))
        .drop("__block__", "__in__", "__group__", "__base_block__", "__base__")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of a stream sorted by ``key``, cut so that no key is in two of them."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[batch.num_rows - 1]
        if kept and keys[0] != kept[-1].column(key)[0]:
            yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            kept = []
        # rows of the last key wait for the next batch
        same = np.asarray(pc.equal(keys, last))
        cut_at = batch.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        if cut_at:
            kept.append(batch.slice(0, cut_at))
            yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            kept = []
        kept.append(batch.slice(cut_at))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _sum_of(edges: DataFrame) -> tuple[int, int]:
    """Count and hash of a set of edges, to see whether it changed."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: each node's edges move to its smallest
    neighbour until every component is a star. Each step is two shuffles of the edges, the
    number of steps is logarithmic, and the edges are written between steps. The minimum of a
    neighbourhood is an aggregate, so a node with very many edges needs no large task.
    """
    now = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "edges",
    )
    state = _sum_of(now)
    while state[0]:
        both = now.union(now.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut(
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct(), "edges",
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = cut(
            large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges",
        )
        drop(now)
        drop(large)
        before, state, now = state, _sum_of(small), small
        if state == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select("b", F.col("b")).distinct())
