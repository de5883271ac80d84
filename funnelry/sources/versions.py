"""Tables that are replaced bucket by bucket, with a manifest that makes changes visible.

A store is a folder of tables. Rows of a table are spread over buckets by a hash of its key;
each version of the store has a manifest that lists the files of every bucket. A change
writes new files for the buckets it touches, then a manifest, which one atomic rename makes
the current one: all tables of a store change together or not at all. Readers and merges open
the listed files only, so what a killed run has left behind is never seen.

    store/manifests/00000000000000000007.json
    store/data/<change>/<table>/bucket=3/part-....parquet

A store has one writer at a time. A second one loses at the rename and raises, having changed
nothing. The folder must be on a file system with atomic rename.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"
#: Files below this size are gathered by a compaction.
SMALL_FILE = 64 * 1024**2


class Conflict(RuntimeError):
    """Another writer has committed since this change began."""


@dataclass(frozen=True)
class Table:
    """One table in a manifest: its layout, and the files of each bucket that has any."""

    schema: str
    keys: tuple[str, ...]
    buckets: int
    files: Mapping[int, tuple[str, ...]] = field(default_factory=dict)

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Manifest:
    """A version of a store. ``applied`` has the last batch of every source taken in."""

    version: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)
    applied: Mapping[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {
            name: {
                "schema": t.schema,
                "keys": t.keys,
                "buckets": t.buckets,
                "files": {str(b): f for b, f in t.files.items()},
            }
            for name, t in self.tables.items()
        }
        return json.dumps({"tables": tables, "applied": dict(self.applied)})

    @staticmethod
    def from_json(version: int, text: str) -> Manifest:
        content = json.loads(text)
        tables = {
            name: Table(
                t["schema"],
                tuple(t["keys"]),
                t["buckets"],
                {int(b): tuple(f) for b, f in t["files"].items()},
            )
            for name, t in content["tables"].items()
        }
        return Manifest(version, tables, content["applied"])

    def files(self) -> set[str]:
        return {f for t in self.tables.values() for files in t.files.values() for f in files}


class Folder:
    """The few file operations a store needs, through the session's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = self._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(self._conf)
        self.root = self.fs.makeQualified(self.root)
        self.path = self.root.toString()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        if not self.fs.exists(at):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(at)]

    def files(self, folder: str) -> list[str]:
        """Names of all files below a folder, relative to the root."""
        at, found = self._at(folder), []
        if self.fs.exists(at):
            listed = self.fs.listFiles(at, True)
            while listed.hasNext():
                found.append(listed.next().getPath().toString()[len(self.path) + 1 :])
        return found

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Writes a file beside its place, then renames it there; fails if one is there."""
        beside = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self._gateway.new_array(options, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.root.toUri(), self._conf
        )
        try:
            context.rename(beside, self._at(name), none)
        except Exception as error:
            self.fs.delete(beside, False)
            if self.fs.exists(self._at(name)):
                raise Conflict(f"{self.path}/{name} has been written by another change") from error
            raise

    def size(self, name: str) -> int:
        return self.fs.getFileStatus(self._at(name)).getLen()

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def versions(self) -> list[int]:
        names = self.folder.names("manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The current version, or an earlier one that is still kept."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest()
        return Manifest.from_json(version, self.folder.read(_name(version)))

    def read(
        self, name: str, buckets: Iterable[int] | None = None, version: int | None = None
    ) -> DataFrame:
        """A table as of a version; only the files of ``buckets`` where these are given."""
        return self._rows(self.manifest(version).tables[name], buckets)

    def _rows(self, table: Table, buckets: Iterable[int] | None = None) -> DataFrame:
        wanted = table.files if buckets is None else set(buckets)
        files = [f for b, fs in table.files.items() if b in wanted for f in fs]
        schema = T._parse_datatype_string(table.schema)
        if not files:
            # No rows that the optimizer knows to be none, unlike those of an empty list.
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            return self.spark.range(0).select(*none).where(F.lit(False))
        return self.spark.read.schema(schema).parquet(*[f"{self.folder.path}/{f}" for f in files])

    def begin(self) -> Change:
        return Change(self, self.manifest())

    def vacuum(self, keep: int = 2) -> int:
        """Deletes what only earlier versions than the ``keep`` latest list; how many files.

        Readers of a version keep working until ``keep`` more have been committed. Changes
        that no version lists go too: they were killed, or cannot be committed any more, as
        a version has come between.
        """
        versions = self.versions()
        dropped = [self.manifest(v).files() for v in versions[:-keep]]
        listed = set().union(*[self.manifest(v).files() for v in versions[-keep:]])
        gone = set().union(*dropped) - listed
        changes = {f.split("/")[1] for f in listed}
        for change in self.folder.names("data"):
            if change not in changes:
                self.folder.delete(f"data/{change}")
        for f in gone:
            if f.split("/")[1] in changes:
                self.folder.delete(f)
        for v in versions[:-keep]:
            self.folder.delete(_name(v))
        return len(gone)


def _name(version: int) -> str:
    return f"manifests/{version:020d}.json"


class Change:
    """New contents of some buckets, invisible to others until :meth:`commit`.

    Threads may replace buckets of different tables at the same time.
    """

    def __init__(self, store: Store, manifest: Manifest):
        self.store, self.base, self.tables = store, manifest, dict(manifest.tables)
        self.id = uuid.uuid4().hex

    def create(self, name: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> Table:
        """The table as it is, or an empty one of this layout if there is none yet."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        table = self.tables.setdefault(name, Table(ddl, tuple(keys), buckets))
        if (table.schema, table.keys, table.buckets) != (ddl, tuple(keys), buckets):
            raise ValueError(f"{name} is stored with another layout: {table}")
        return table

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        return self.store._rows(self.tables[name], buckets)

    def touched(self, name: str, rows: DataFrame) -> set[int]:
        """Buckets that hold the keys of some rows: at most as many as the table has."""
        if self.tables[name].buckets == 1:
            return {0}
        found = rows.select(self.tables[name].bucket_of().alias(BUCKET)).distinct()
        return {r[0] for r in found.collect()}

    def _write(self, name: str, rows: DataFrame) -> dict[int, list[str]]:
        """Writes rows to new files; their names by bucket."""
        table = self.tables[name]
        names = [f.name for f in T._parse_datatype_string(table.schema)]
        rows = rows.select(*names)
        at = f"data/{self.id}/{name}-{uuid.uuid4().hex}"
        path = f"{self.store.folder.path}/{at}"
        if table.buckets == 1:
            rows.write.parquet(path)
        else:
            # Gathers a bucket's rows in few files and splits a large bucket, so a bucket
            # that holds a third of all rows is written by many tasks.
            placed = rows.withColumn(BUCKET, table.bucket_of()).hint("rebalance", BUCKET)
            placed.write.partitionBy(BUCKET).parquet(path)
        files: dict[int, list[str]] = {}
        for f in self.store.folder.files(at):
            if f.endswith(".parquet"):
                place = f"/{BUCKET}="
                bucket = int(f.split(place)[1].split("/")[0]) if table.buckets > 1 else 0
                files.setdefault(bucket, []).append(f)
        return files

    def replace(self, name: str, rows: DataFrame, buckets: Iterable[int]) -> None:
        """Puts rows in place of all rows of some buckets; each must belong to one of them."""
        buckets = set(buckets)
        files = self._write(name, rows)
        if wrong := set(files) - buckets:
            raise ValueError(f"rows of {name} fall in buckets {sorted(wrong)}, not to be replaced")
        kept = {b: f for b, f in self.tables[name].files.items() if b not in buckets}
        new = {b: tuple(f) for b, f in files.items()}
        self.tables[name] = replace(self.tables[name], files=kept | new)

    def append(self, name: str, rows: DataFrame) -> None:
        """Adds rows beside those of their buckets."""
        files = dict(self.tables[name].files)
        for b, more in self._write(name, rows).items():
            files[b] = (*files.get(b, ()), *more)
        self.tables[name] = replace(self.tables[name], files=files)

    def compact(self, name: str, small_bytes: int = SMALL_FILE) -> int:
        """Gathers the small files of each bucket in fewer; how many files were gathered.

        Files of ``small_bytes`` and more stay as they are. Rows keep their content, not their
        place in files.
        """
        table, gathered, files = self.tables[name], [], {}
        for b, names in table.files.items():
            small = [f for f in names if self.store.folder.size(f) < small_bytes]
            small = small if len(small) > 1 else []
            gathered += small
            files[b] = tuple(f for f in names if f not in set(small))
        if not gathered:
            return 0
        rows = self.store._rows(replace(table, files={0: tuple(gathered)}))
        written = self._write(name, rows.hint("rebalance") if table.buckets == 1 else rows)
        for b, more in written.items():
            files[b] = (*files.get(b, ()), *more)
        self.tables[name] = replace(table, files={b: f for b, f in files.items() if f})
        return len(gathered)

    def commit(self, applied: Mapping[str, int] | None = None) -> Manifest:
        """Makes all replacements current at once, then clears what no kept version lists."""
        done = Manifest(
            self.base.version + 1, self.tables, {**self.base.applied, **(applied or {})}
        )
        self.store.folder.write_new(_name(done.version), done.to_json())
        self.store.vacuum()
        return done
