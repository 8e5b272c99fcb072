"""A set of tables that is replaced as a whole.

Each build writes to a folder of its own, and last of all one small manifest that names, for every table, where it lies. Readers
follow the newest manifest. A build that fails leaves no manifest, so the tables of the last one that ended stay those that
are read. It deletes its own folder; one that is killed leaves it there, where nothing reads it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallystar.sources.tables import read_written, table_path

#: Below the folder of the set: manifests, one folder each, and versions.
MANIFESTS = "manifests"
VERSIONS = "versions"
_ROW = "number long, version string, tables array<struct<name: string, version: string, format: string, schema: string>>"


@dataclass(frozen=True)
class Stored:
    """A table of the set: its path, its format and its schema."""

    path: str
    fmt: str
    schema: StructType
    version: str


@dataclass(frozen=True)
class Manifest:
    """Which tables make up the set. The first has number 0 and none."""

    folder: str
    number: int
    tables: Mapping[str, Stored]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        there = self.tables[name]
        return read_written(spark, there.path, there.fmt, there.schema)


def _manifests(spark: SparkSession, folder: str) -> list:
    try:
        return spark.read.schema(_ROW).json(f"{folder}/{MANIFESTS}/*").collect()  # one row per build that is kept
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _parsed(folder: str, row) -> Manifest:
    tables = {t.name: Stored(table_path(f"{folder}/{VERSIONS}/{t.version}", t.name, t.format), t.format, StructType.fromJson(json.loads(t.schema)), t.version) for t in row.tables}
    return Manifest(folder, row.number, tables)


def current(spark: SparkSession, folder: str) -> Manifest:
    """The newest manifest of ``folder``; one without tables if there is none."""
    rows = _manifests(spark, folder)
    return _parsed(folder, max(rows, key=lambda r: (r.number, r.version))) if rows else Manifest(folder, 0, {})


class Version:
    """A build of some tables of a set: write them below ``path``, tell of each with ``add``, then ``publish``, or ``discard`` them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.before = current(spark, folder)
        self.name = uuid.uuid4().hex
        self.path = f"{folder}/{VERSIONS}/{self.name}"
        self.added: dict[str, Stored] = {}

    def add(self, name: str, fmt: str, schema: StructType) -> Stored:
        self.added[name] = Stored(table_path(self.path, name, fmt), fmt, schema, self.name)
        return self.added[name]

    def publish(self, keep: int = 2) -> Manifest:
        """Make the tables added those that readers find; tables not added stay those of the build before.

        The manifest is one file of one row, which appears when its write ends. Versions that only manifests before the newest ``keep``
        name are deleted, so a reader that began under the last one can end. Of two builds at once the later manifest counts.
        """
        tables = {**self.before.tables, **self.added}
        row = (self.before.number + 1, self.name, [(n, t.version, t.fmt, t.schema.json()) for n, t in sorted(tables.items())])
        self.spark.createDataFrame([row], _ROW).coalesce(1).write.json(f"{self.folder}/{_manifest_name(*row[:2])}")
        rows = sorted(_manifests(self.spark, self.folder), key=lambda r: (r.number, r.version))
        named = {t.version for r in rows[-keep:] for t in r.tables}
        for old in rows[:-keep]:
            self._delete(_manifest_name(old.number, old.version))
            for version in {t.version for t in old.tables} - named:
                self._delete(f"{VERSIONS}/{version}")
        return Manifest(self.folder, row[0], tables)

    def discard(self) -> None:
        self._delete(f"{VERSIONS}/{self.name}")

    def _delete(self, below: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{below}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _manifest_name(number: int, version: str) -> str:
    return f"{MANIFESTS}/{number:08d}-{version}"
