"""Output tables as parquet directories on any Hadoop-compatible shared storage.

``<root>/<table>/v<N>/`` holds one version; its manifest (``_manifest-<M>.json``, the highest
counts) is written last and makes the version visible, so a failed replacement leaves the older
version in place.

A table by days has its day as the first partition column, below the number of the write that
brought it. Replacing days writes them under a new number, and then a new manifest says which
write each replaced day is read from; all other days are those of write 0. So a reader sees all
of a replacement or nothing, an interrupted one is never seen, and no folder is listed to find
what to remove: it is the older write's folder of that day.

A table by days whose column types widen keeps its files. The version gets one more folder, in
which days are written from then on; the manifest lists the older folders with the types that
they were written in, and their days are cast when they are read, until they are replaced.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.evolve import conform
from tidemark.operators.skew import files_go_after_query, quote, quoted
from tidemark.sources.shards import empty

MANIFEST = "_manifest-"
WRITE = "__write__"


@dataclass
class Part:
    """Rows to be written; ``finish`` makes the table's columns of them after they have been spread."""

    rows: DataFrame
    spread: bool = False
    finish: Callable[[DataFrame], DataFrame] | None = None


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- files ---------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, *parts: str) -> bool:
        path = self._path(*parts)
        return self._fs(path).exists(path)

    def _names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        fs = self._fs(path)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def _delete(self, *parts: str) -> None:
        path = self._path(*parts)
        self._fs(path).delete(path, True)

    def _write_text(self, text: str, *parts: str) -> None:
        path = self._path(*parts)
        stream = self._fs(path).create(path, True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _read_text(self, *parts: str) -> str:
        path = self._path(*parts)
        stream = self._fs(path).open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # -- versions ------------------------------------------------------------------------

    def _versions(self, table: str) -> list[int]:
        return sorted(
            int(name[1:]) for name in self._names(table) if name[:1] == "v" and name[1:].isdigit()
        )

    def _manifests(self, table: str, version: str) -> list[int]:
        names = (n.removeprefix(MANIFEST).partition(".") for n in self._names(table, version) if n.startswith(MANIFEST))
        return sorted(int(number) for number, _, kind in names if kind == "json")

    def _current(self, table: str) -> tuple[str, int] | None:
        for version in reversed(self._versions(table)):
            found = self._manifests(table, f"v{version}")
            if found:
                return f"v{version}", found[-1]
        return None

    def exists(self, table: str) -> bool:
        return self._current(table) is not None

    def meta(self, table: str) -> dict | None:
        """``columns`` and ``partitions``; ``folder`` that takes new days; ``older`` folders with their
        columns and the first write number that is not theirs; ``days``: the write of each replaced
        day; ``next``: the number of the next write."""
        current = self._current(table)
        if current is None:
            return None
        version, number = current
        return json.loads(self._read_text(table, version, f"{MANIFEST}{number}.json"))

    def columns(self, table: str) -> dict[str, str] | None:
        meta = self.meta(table)
        return meta["columns"] if meta else None

    @staticmethod
    def _by_days(columns: dict[str, str], partitions: list[str]) -> bool:
        return bool(partitions) and columns[partitions[0]] == "date"

    @staticmethod
    def _folder_of(meta: dict, number: int) -> str:
        return next((part["folder"] for part in meta["older"] if number < part["before"]), meta["folder"])

    def days(self, table: str) -> list[date]:
        """Days of a table by days, replaced ones even if they have no rows; one listing."""
        meta = self.meta(table)
        if meta is None:
            return []
        names = self._names(table, *self._folder_of_write(meta, 0))
        found = {name.partition("=")[2] for name in names if "=" in name} | set(meta["days"])
        return sorted(date.fromisoformat(day) for day in found if day[:1].isdigit())

    # -- notes ---------------------------------------------------------------------------

    def note(self, name: str, value: list | dict | None) -> None:
        """A small note that outlives the run; None removes it."""
        if value is None:
            self._delete("_notes", f"{name}.json")
        else:
            self._write_text(json.dumps(value), "_notes", f"{name}.json")

    def noted(self, name: str) -> list | dict | None:
        given = self._exists("_notes", f"{name}.json")
        return json.loads(self._read_text("_notes", f"{name}.json")) if given else None

    def _publish(self, table: str, version: str, meta: dict) -> None:
        """A new manifest under the next number: complete before it has its name, then visible at
        once. The one before it stays for readers that have just opened it."""
        known = self._manifests(table, version)
        name = f"{MANIFEST}{(known[-1] if known else 0) + 1}.json"
        self._write_text(json.dumps(meta), table, version, f"{name}.part")
        source, target = self._path(table, version, f"{name}.part"), self._path(table, version, name)
        if not self._fs(target).rename(source, target):
            raise OSError(f"cannot publish {target}")
        for number in known[:-1]:
            self._delete(table, version, f"{MANIFEST}{number}.json")

    def _drop_version(self, table: str, version: int) -> None:
        for name in self._names(table):
            if name == f"v{version}" or name.startswith(f"v{version}g"):
                self._delete(table, name)

    # -- reads ---------------------------------------------------------------------------

    def read(self, table: str, default: dict[str, str] | None = None) -> DataFrame:
        """The table in its stored column order; an empty typed frame if it is missing."""
        meta = self.meta(table)
        if meta is None:
            if default is None:
                raise ValueError(f"no table {table} under {self.root}")
            return empty(self.spark, default)
        if not self._by_days(meta["columns"], meta["partitions"]):
            return self._scan(table, meta["folder"], meta["columns"])
        day, frames = F.col(quote(meta["partitions"][0])), []
        used = {self._folder_of(meta, number) for number in {0, *meta["days"].values()}}
        parts = [*meta["older"], {"folder": meta["folder"], "columns": meta["columns"]}]
        for number, part in enumerate(parts):
            if part["folder"] in used:
                columns = part["columns"] | {WRITE: "int"}
                frame = self._scan(table, part["folder"], columns)
                frame = frame.where(F.col(WRITE) == self._write_of(meta["days"], day)).drop(WRITE)
                for later in parts[number + 1 :]:  # one widening after the other, as values changed
                    frame = conform(frame, later["columns"])
                frames.append(frame)
        return functools.reduce(DataFrame.unionByName, frames)

    def _scan(self, table: str, folder: str, columns: dict[str, str]) -> DataFrame:
        frame = self.spark.read.schema(S.ddl(columns)).parquet(f"{self.root}/{table}/{folder}")
        return frame.select(*quoted(columns))

    @staticmethod
    def _write_of(writes: dict[str, int], day: Column) -> Column:
        """Number of the write that a day is read from, a lookup by its place in a list of days."""
        if not writes:
            return F.lit(0)
        first, last = (date.fromisoformat(end(writes)) for end in (min, max))
        numbers = [str(writes.get(d.isoformat(), 0)) for d in days_between(first, last)]
        listed = F.split(F.lit(",".join(numbers)), ",").cast("array<int>")
        return F.coalesce(F.get(listed, F.date_diff(day, F.lit(first))), F.lit(0))

    # -- writes --------------------------------------------------------------------------

    def replace(
        self,
        table: str,
        rows: DataFrame,
        partitions: list[str] = (),
        cluster: list[str] = (),
        spread: bool = False,
    ) -> None:
        """New version with exactly these rows; the one before the last is removed.

        ``spread`` rebalances by the partition columns: AQE then sizes the files, splitting
        a partition with many rows and joining small pieces.
        """
        self.replace_in_parts(table, [Part(rows, spread)], dict(rows.dtypes), partitions, cluster)

    def replace_in_parts(
        self, table: str, parts: list[Part], columns: dict[str, str], partitions: list[str] = (), cluster: list[str] = ()
    ) -> None:
        """New version with the rows of all parts, written one after the other: the shuffle files of
        one go before the next is begun. The version is visible when all of them are written."""
        versions = self._versions(table)
        version = f"v{(versions[-1] if versions else 0) + 1}"
        place = f"{version}/{WRITE}=0" if self._by_days(columns, partitions) else version
        self._write_parts(parts, partitions, cluster, table, place)
        meta = {"columns": columns, "partitions": list(partitions), "folder": version}
        self._publish(table, version, meta | {"older": [], "days": {}, "next": 1})
        for old in versions[:-1]:
            self._drop_version(table, old)

    def _write_parts(self, parts: list[Part], partitions, cluster, *place: str) -> None:
        for number, part in enumerate(parts):
            rows, spread = part.rows, part.spread
            if part.finish is not None:
                rows = part.finish(rows.hint("rebalance", *[F.col(c) for c in partitions]) if spread else rows)
                spread = False
            writer = self._writer(rows, partitions, cluster, spread).mode("append" if number else "overwrite")
            with files_go_after_query(self.spark):
                writer.option("partitionOverwriteMode", "static").parquet("/".join([self.root, *place]))

    def _writer(self, rows: DataFrame, partitions, cluster, spread):
        if spread:
            rows = rows.hint("rebalance", *[F.col(c) for c in partitions])
        if cluster:
            rows = rows.sortWithinPartitions(*partitions, *cluster)
        writer = rows.write.option("compression", "zstd")
        return writer.partitionBy(*partitions) if partitions else writer

    def append(
        self, table: str, rows: DataFrame, columns: dict[str, str], partitions: list[str] = ()
    ) -> None:
        """More rows; AQE sizes the files, so a small run leaves a small number of them."""
        rows = conform(rows, columns)
        meta = self.meta(table)
        if meta is None:
            self.replace(table, rows, partitions, spread=True)
            return
        if meta["older"] or meta["days"]:  # rows of replaced days would not be seen
            raise ValueError(f"{table} has replaced days or older types and takes whole days only")
        by_days = self._by_days(meta["columns"], meta["partitions"])
        place = f"{meta['folder']}/{WRITE}=0" if by_days else meta["folder"]
        with files_go_after_query(self.spark):
            self._writer(rows, meta["partitions"], (), True).mode("append").parquet(
                f"{self.root}/{table}/{place}"
            )

    def clear(self, table: str) -> None:
        """State reset: the table is gone for readers."""
        for version in self._versions(table):
            self._drop_version(table, version)

    def evolve(self, table: str, columns: dict[str, str], cluster: list[str] = ()) -> None:
        """Give the table these columns; the files of a table by days stay as they are.

        New columns cost nothing. Changed types open a new folder for the days written from now
        on. Tables that are not by days are rewritten.
        """
        meta = self.meta(table)
        if meta is None or meta["columns"] == columns:
            return
        version, old = self._current(table)[0], meta["columns"]
        changed = [c for c, t in old.items() if columns.get(c, t) != t]
        lost = [c for c in old if c not in columns]
        if not changed and not lost:
            self._publish(table, version, meta | {"columns": columns})
            return
        if lost or not self._by_days(old, meta["partitions"]):
            rows = conform(self.read(table), columns)
            self.replace(table, rows, meta["partitions"], cluster, spread=True)
            return
        part = {"folder": meta["folder"], "columns": old, "before": meta["next"]}
        older = [*meta["older"], part]
        moved = {"columns": columns, "older": older, "folder": f"{version}g{len(older)}"}
        self._publish(table, version, meta | moved)

    def overwrite_days(
        self,
        table: str,
        rows: DataFrame,
        days: list[date],
        cluster: list[str] = (),
        spread: bool = False,
    ) -> None:
        """Replace whole days (the first partition column): rows in, all else of them out.

        ``rows`` hold every row these days shall have and no others. ``rows`` may read this table.
        """
        number = self.stage_days(table, rows, cluster, spread)
        self.publish_days(table, {number: days})

    def stage_days(
        self,
        table: str,
        rows: DataFrame,
        cluster: list[str] = (),
        spread: bool = False,
        after: int | None = None,
    ) -> int:
        """Write rows of whole days that no reader sees yet: the number of their write.

        ``after`` is the number of a write that is staged before it and published with it.
        """
        columns = self.meta(table)["columns"]
        return self.stage_parts(table, [Part(conform(rows, columns), spread)], cluster, after)

    def stage_parts(
        self, table: str, parts: list[Part], cluster: list[str] = (), after: int | None = None
    ) -> int:
        """The same with rows in parts, written one after the other under one number."""
        meta = self.meta(table)
        partitions = meta["partitions"]
        if not self._by_days(meta["columns"], partitions):
            raise ValueError(f"{table} is not partitioned by day first")
        number = meta["next"] if after is None else after + 1
        self._write_parts(parts, partitions, cluster, table, meta["folder"], f"{WRITE}={number}")
        return number

    def staged(self, table: str, number: int) -> DataFrame:
        """The rows of a write that is not published."""
        meta = self.meta(table)
        return self._scan(table, f"{meta['folder']}/{WRITE}={number}", meta["columns"])

    def publish_days(self, table: str, staged: dict[int, list[date]]) -> None:
        """Read these days from the staged writes from now on, all of them at once."""
        meta = self.meta(table)
        partitions = meta["partitions"]
        writes = dict(meta["days"])
        for number, days in staged.items():
            writes |= dict.fromkeys((day.isoformat() for day in days), number)
        given = {day.isoformat() for days in staged.values() for day in days}
        self._publish(table, self._current(table)[0], meta | {"days": writes, "next": max(staged) + 1})
        for day in sorted(given):  # nothing reads these any more
            self._delete(table, *self._folder_of_write(meta, meta["days"].get(day, 0)), f"{partitions[0]}={day}")
        for old in {meta["days"].get(day, 0) for day in given} - {0, *writes.values()}:
            self._delete(table, *self._folder_of_write(meta, old))

    def _folder_of_write(self, meta: dict, number: int) -> tuple[str, str]:
        return self._folder_of(meta, number), f"{WRITE}={number}"


def days_between(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]
