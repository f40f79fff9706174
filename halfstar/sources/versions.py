"""Stored tables that change from one whole version to the next.

What a job writes lies in folders of its own. At last it writes the manifest of a new version, a small table
that names the folders of every table, and only with it the version is there. So a job that dies half way
leaves readers where they were; a reader that has begun stays on its version; several tables change together; and a
version that replaces some parts of a table shares the folders of all others with the one before.

Layout below a root: ``versions/version=<n>`` holds the manifests, ``<table>/batch=<n>-<id>`` what the writer of
version n has stored, by parts (``year=2010``) where it is partitioned.
"""

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_MANIFEST = "writer STRING, table STRING, part STRING, folder STRING"
#: Fixed value: the folder name of NULL in a partitioned table.
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class Entry(NamedTuple):
    """A folder that holds a part of a table, or with an empty ``part`` a whole one."""

    table: str
    part: str
    folder: str


class ConcurrentWrite(RuntimeError):
    """Another job has written the same version first; start again from the newest one."""


def part_name(column: str, value: object) -> str:
    return f"{column}={_NULL_PART if value is None else value}"


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{_MANIFEST}, version BIGINT").parquet(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest(spark: SparkSession, root: str) -> int:
    """The number of the newest version, 0 if there is none."""
    manifests = _manifests(spark, root)
    return (manifests.agg(F.max("version")).first()[0] or 0) if manifests is not None else 0


class Version:
    """The tables of one version, as readers see them."""

    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.number = newest(spark, self.root) if number is None else number
        self.entries: list[Entry] = []
        if self.number:
            rows = _manifests(spark, self.root).where(F.col("version") == self.number)
            found = rows.select("writer", "table", "part", "folder").collect()
            if not found:
                raise LookupError(f"no version {self.number} below {self.root}")
            first = min(r.writer for r in found)
            self.entries = [Entry(r.table, r.part, r.folder) for r in found if r.writer == first]

    def tables(self) -> list[str]:
        return sorted({e.table for e in self.entries})

    def parts(self, table: str) -> list[str]:
        """The parts of a partitioned table that have rows."""
        return sorted({e.part for e in self.entries if e.table == table and e.part})

    def folder(self, table: str = "") -> str:
        """The folder of a table that is stored whole."""
        (entry,) = [e for e in self.entries if e.table == table]
        return entry.folder

    def read(
        self, table: str, parts: Sequence[str] | None = None, schema: StructType | None = None
    ) -> DataFrame:
        """A table, or only some of its parts; folders of other parts are not even listed.

        Parts that are not there have no rows. With no folder to read at all, ``schema`` must be given.
        """
        wanted = [e for e in self.entries if e.table == table and (parts is None or e.part in parts)]
        return _read(self.spark, self.root, table, wanted, schema)


def _read(
    spark: SparkSession, root: str, table: str, entries: list[Entry], schema: StructType | None
) -> DataFrame:
    if not entries:
        if schema is None:
            raise LookupError(f"nothing stored of {table} below {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{root}/{table}")
    df = (reader.schema(schema) if schema else reader).parquet(*(e.folder for e in entries))
    return df.select(*schema.names) if schema else df.drop("batch")


class Draft(Version):
    """A version in the making, which begins as the newest one and is seen by nobody until `commit`."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.number += 1
        self.writer = uuid.uuid4().hex

    def new_folder(self, table: str) -> str:
        return f"{self.root}/{table}/batch={self.number}-{uuid.uuid4().hex}"

    def _store(self, df: DataFrame, table: str, by: str | None) -> list[Entry]:
        folder = self.new_folder(table)
        df.write.parquet(folder, partitionBy=[by] if by else None, compression="snappy")
        if by is None:
            return [Entry(table, "", folder)]
        # a scan without columns: the values are in the folders' names
        stored = self.spark.read.schema(df.schema).parquet(folder)
        names = [part_name(by, r[0]) for r in stored.select(by).distinct().collect()]
        if not names:  # no folder of a part says what the rows look like
            folder = self.new_folder(table)
            self.spark.createDataFrame([], df.schema).write.parquet(folder)
            return [Entry(table, "", folder)]
        return [Entry(table, name, f"{folder}/{name}") for name in sorted(names)]

    def _put(self, table: str, by: str | None, old: list[Entry], new: list[Entry]) -> None:
        """Let a table consist of these entries; an empty one of a partitioned table counts only by itself."""
        mine = old + new
        mine = ([e for e in mine if e.part] or mine[-1:]) if by else mine
        self.entries = [e for e in self.entries if e.table != table] + mine

    def append(self, df: DataFrame, table: str, by: str | None = None) -> DataFrame:
        """Add rows to a table; returns them as stored. A part may lie in several folders."""
        entries = self._store(df, table, by)
        self._put(table, by, [e for e in self.entries if e.table == table], entries)
        return _read(self.spark, self.root, table, entries, df.schema)

    def replace(
        self, df: DataFrame, table: str, by: str | None = None, parts: Sequence[str] | None = None
    ) -> DataFrame:
        """Put rows in the place of a table, or of the given parts of it; returns them as stored.

        Whoever gives ``parts`` gives rows of these only; a part without rows is gone then.
        """
        entries = self._store(df, table, by)
        old = [e for e in self.entries if e.table == table and parts is not None and e.part not in parts]
        self._put(table, by, old, entries)
        return _read(self.spark, self.root, table, entries, df.schema)

    def commit(self) -> int:
        """Make this version the newest one. Raises ConcurrentWrite if another job was faster."""
        if newest(self.spark, self.root) >= self.number:
            raise ConcurrentWrite(f"version {self.number} is there already")
        rows = [(self.writer, *e) for e in self.entries]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("append").parquet(f"{self.root}/versions/version={self.number}")
        written = _manifests(self.spark, self.root).where(F.col("version") == self.number)
        if written.agg(F.min("writer")).first()[0] != self.writer:
            raise ConcurrentWrite(f"another job has written version {self.number}")
        return self.number


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> int:
    """Let ``write`` store what it wants below a new folder, and make that the newest version.

    `current` gives that folder to readers. If ``write`` fails, the version before stays.
    """
    draft = Draft(spark, root)
    folder = draft.new_folder("marts")
    write(folder)
    draft.entries = [Entry("", "", folder)]
    return draft.commit()


def current(spark: SparkSession, root: str, number: int | None = None) -> str:
    """The folder that the newest version (or the given one) was published in."""
    return Version(spark, root, number).folder()


def drop_old(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete versions but the ``keep`` newest, and the folders that only they name; returns what was deleted.

    For times when nobody reads an old version. Folders of jobs that have not committed yet are
    younger than the newest version and stay.
    """
    root, last = root.rstrip("/"), newest(spark, root)
    numbers = sorted(r[0] for r in _manifests(spark, root).select("version").distinct().collect())
    kept = {e.folder for n in numbers[-keep:] for e in Version(spark, root, n).entries}
    system = _FileSystem(spark, root)
    doomed = []
    for table in system.children(root):
        for batch in system.children(table):
            name = batch.rpartition("/")[2]
            if not name.startswith("batch=") or int(name[6:].partition("-")[0]) > last:
                continue
            used = {f for f in kept if _same(f, batch) or _under(f, batch)}
            if not used:
                doomed.append(batch)
            elif not any(_same(f, batch) for f in used):
                doomed += [p for p in system.children(batch) if "=" in p.rpartition("/")[2] and not any(_same(f, p) for f in used)]
    doomed = [f"{root}/versions/version={n}" for n in numbers[:-keep]] + doomed
    for folder in doomed:  # manifests first: no manifest ever names a folder that is gone
        system.delete(folder)
    return doomed


def _plain(folder: str) -> str:
    """An address without scheme and host, as file systems spell these in several ways."""
    return "/" + folder.partition("://")[2].partition("/")[2] if "://" in folder else folder.removeprefix("file:")


def _same(a: str, b: str) -> bool:
    return _plain(a) == _plain(b)


def _under(folder: str, above: str) -> bool:
    return _plain(folder).startswith(_plain(above) + "/")


class _FileSystem:
    """The session's file system of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._system = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def children(self, folder: str) -> list[str]:
        if not self._system.getFileStatus(self._path(folder)).isDirectory():
            return []
        return [s.getPath().toString() for s in self._system.listStatus(self._path(folder))]

    def delete(self, folder: str) -> None:
        self._system.delete(self._path(folder), True)
