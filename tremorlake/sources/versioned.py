"""A keyed Parquet table whose versions are switched by one small file.

    <path>/data/<commit>/part=<value>/*.parquet    files, never changed once written
    <path>/versions/<number>.json                  what a version consists of: {part: [[commit, rows], ...]}

A write first puts new files below ``data``, which no version names yet, and then publishes the next version's
file: written under another name and renamed, without overwriting. Until the rename everyone reads the old
version; a writer that fails before it leaves files that nothing reads, and of two writers that started from
the same version the later one gets ``ConcurrentWrite`` instead of losing the other's rows. Only partitions
that a batch touches are read or written anew, all others are named again by the next version.

The partition of a row is a function of its key (``by``), so that a row and its successor are in the same one:
a key column as it is, the day or month of a key time, or a hash of the key over a fixed number of buckets. The version file
has an entry per partition and write since the last rewrite, as a listing of directories would.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tremorlake.session import durable, release
from tremorlake.sources.sinks import aligned, merged_rows, new_rows

PART = "part"
NONE = "__none__"
FOLDED = 16  # pieces of a partition, from which an insert writes it anew as one


class ConcurrentWrite(Exception):
    """Another writer has published the version that this one was to be."""


def by_value(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).cast("string")


def by_day(column: str) -> Callable[[], Column]:
    return lambda: F.date_format(column, "yyyy-MM-dd")


def by_month(column: str) -> Callable[[], Column]:
    return lambda: F.date_format(column, "yyyy-MM")


def by_epoch_day(column: str) -> Callable[[], Column]:
    """The UTC day of seconds since 1970."""
    return lambda: F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col(column) / 86400).cast("int")).cast("string")


def by_bucket(key: Sequence[str], buckets: int) -> Callable[[], Column]:
    return lambda: F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string")


class VersionedTable:
    """A table with a key at ``path``; ``by`` gives the partition of a row from its key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], by: Callable[[], Column] | None = None, buckets: int = 16):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, list(key)
        self._by = by or by_bucket(self.key, buckets)

    # -- the version files

    def _fs(self):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _hadoop_path(self, inside: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{inside}")

    def _names(self, folder: str) -> list[str]:
        fs, where = self._fs(), self._hadoop_path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> tuple[int, dict[str, list]]:
        """(number, {part: [[commit, rows], ...]}) of a version, the newest by default; (0, {}) before the first."""
        known = self.versions()
        if not known:
            return 0, {}
        number = max(known) if version is None else version
        if number not in known:
            raise ValueError(f"{self.path} has no version {version}; it has {min(known)} to {max(known)}")
        stream = self._fs().open(self._hadoop_path(f"versions/{number:012d}.json"))
        try:
            return number, json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, number: int, parts: dict[str, list]) -> int:
        """Make ``parts`` version ``number``: the one step that readers see."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        made, final = self._hadoop_path(f"versions/.{uuid.uuid4().hex}"), self._hadoop_path(f"versions/{number:012d}.json")
        out = self._fs().create(made, False)
        try:
            out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        finally:
            out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), conf).rename(self._fs().makeQualified(made), self._fs().makeQualified(final), never)
        except Exception as error:
            self._fs().delete(made, False)
            if "FileAlreadyExistsException" in str(error):
                raise ConcurrentWrite(f"version {number} of {self.path} was published by another writer") from error
            raise
        return number

    # -- rows

    def exists(self) -> bool:
        return bool(self.versions())

    def _piece(self, part: str) -> str:
        """The directory of a partition inside a commit, as partitionBy names it."""
        return f"{PART}={self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(part)}"

    def _folders(self, parts: dict[str, list]) -> list[str]:
        return [f"{self.path}/data/{commit}/{self._piece(part)}" for part, pieces in sorted(parts.items()) for commit, _ in pieces]

    def _read(self, parts: dict[str, list]) -> DataFrame | None:
        folders = self._folders(parts)
        return self.spark.read.schema(self.schema).parquet(*folders).select(*self.schema.names) if folders else None

    def read(self, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, of some partitions only if they are named; no rows before the first version."""
        _, named = self.manifest(version)
        if parts is not None:
            named = {p: named[p] for p in parts if p in named}
        rows = self._read(named)
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    def rows(self, version: int | None = None) -> int:
        """The number of rows, from the version file."""
        return sum(n for pieces in self.manifest(version)[1].values() for _, n in pieces)

    def _dealt(self, batch: DataFrame) -> tuple[DataFrame, list[str]]:
        """The batch in the table's columns with its partition, written once, and the partitions it touches."""
        rows = durable(self._parted(aligned(batch, self.schema)))
        return rows, [r[0] for r in rows.select(PART).distinct().collect()]

    def _parted(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(PART, F.coalesce(F.nullif(self._by(), F.lit("")), F.lit(NONE)))

    def _write(self, rows: DataFrame) -> tuple[str, dict[str, int]]:
        """New files for ``rows`` (with ``part``) below a commit of their own: its name, and rows per partition."""
        commit = uuid.uuid4().hex
        folder = f"{self.path}/data/{commit}"
        rows.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)  # large partitions are split over tasks, small ones share one
        if not any(n.startswith(f"{PART}=") for n in self._names(f"data/{commit}")):
            return commit, {}
        typed = T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])
        counted = self.spark.read.schema(typed).parquet(folder).groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
        return commit, {r[PART]: r["n"] for r in counted.collect()}

    def insert_ignore(self, batch: DataFrame, order: Sequence[str] | None = None) -> int:
        """Add the rows whose key the table lacks, the first in ``order`` of each; returns how many.

        A batch that brings nothing new makes no version. A partition with many small pieces is written anew.
        """
        number, parts = self.manifest()
        rows, touched = self._dealt(batch)
        order = order or [c for c in self.schema.names if c not in self.key]
        own = {p: parts[p] for p in touched if p in parts}
        added = new_rows(self._read(own), rows, self.key, order)
        folded = {p: pieces for p, pieces in own.items() if len(pieces) >= FOLDED}
        if folded:
            added = added.unionByName(self._parted(self._read(folded)))
        commit, counts = self._write(added)
        release(rows)
        before = {p: sum(n for _, n in pieces) for p, pieces in folded.items()}
        new = sum(counts.values()) - sum(before.values())
        if new:
            pieces = {p: [*([] if p in folded else parts.get(p, [])), [commit, n]] for p, n in counts.items()}
            self._publish(number + 1, parts | pieces)
        else:
            self._fs().delete(self._hadoop_path(f"data/{commit}"), True)
        return new

    def upsert(self, batch: DataFrame, order: Sequence[str] | None = None) -> int:
        """Write the batch over the table by key, the last in ``order`` of each; returns rows in the partitions written."""
        number, parts = self.manifest()
        rows, touched = self._dealt(batch)
        if not touched:
            return 0
        order = order or [c for c in self.schema.names if c not in self.key]
        target = self._read({p: parts[p] for p in touched if p in parts})
        commit, counts = self._write(merged_rows(None if target is None else self._parted(target), rows, self.key, order))
        release(rows)
        self._publish(number + 1, parts | {p: [[commit, n]] for p, n in counts.items()})
        return sum(counts.values())

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions, and files that none of these names, those of failed
        writers and of replaced partitions too; returns how many commits lost files. Not to be run beside a writer."""
        known = sorted(self.versions())
        stay = known[-keep:]
        used: dict[str, set[str]] = {}
        for v in stay:
            for part, pieces in self.manifest(v)[1].items():
                for commit, _ in pieces:
                    used.setdefault(commit, set()).add(self._piece(part))
        fs = self._fs()
        for v in known[:-keep]:
            fs.delete(self._hadoop_path(f"versions/{v:012d}.json"), False)
        gone = 0
        for commit in self._names("data"):
            if commit in used:
                dead = [f"data/{commit}/{n}" for n in self._names(f"data/{commit}") if n.startswith(f"{PART}=") and n not in used[commit]]
            else:
                dead = [f"data/{commit}"]
            for folder in dead:
                fs.delete(self._hadoop_path(folder), True)
            gone += bool(dead)
        return gone
