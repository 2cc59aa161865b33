"""Several tables that change together: written by runs of their own, named by a manifest.

A run writes all its tables into a new folder and then adds one row to the manifest, which says
where the tables of the release are. Readers go by the last row. So they see all tables of one run or
all of the run before, and a run that fails, or is still at work, changes nothing for them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cleargrist.functions import named
from cleargrist.sinks.writers import restore_keys
from cleargrist.sources.tables import KEEP_NUL, ReadOptions, read_table

_MANIFEST = (
    "number long, run string, tables array<struct<name string, fmt string, columns array<string>,"
    " keys array<string>, parts array<struct<folder string, schema string>>>>"
)


@dataclass(frozen=True)
class Part:
    """Files of one run: their folder under the path of the releases, and their schema as JSON.

    Without a folder the run had no rows for the table.
    """

    folder: str | None
    schema: str


@dataclass(frozen=True)
class StoredTable:
    """A table of a release, which may lie in the folders of several runs.

    ``keys`` are the columns it is partitioned by, with copies of them in the files.
    """

    fmt: str
    columns: tuple[str, ...]
    parts: tuple[Part, ...]
    keys: tuple[str, ...] = ()

    def after(self, older: StoredTable | None) -> StoredTable:
        """This table with the rows of an older one before it."""
        if older is None:
            return self
        if older.fmt != self.fmt or older.keys != self.keys:
            raise ValueError("appended rows must be stored as those before them")
        extra = tuple(c for c in older.columns if c not in self.columns)
        return replace(self, columns=self.columns + extra, parts=older.parts + self.parts)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """All its rows. Columns that a run has not stored are null in its rows."""
        folders: dict[str, list[str]] = {}
        for part in self.parts:
            stored = folders.setdefault(part.schema, [])
            if part.folder:
                stored.append(f"{path}/{part.folder}")
        whole: DataFrame | None = None
        for text, paths in folders.items():
            schema = StructType.fromJson(json.loads(text))
            rows = read_stored(spark, paths, self.fmt, schema) if paths else spark.createDataFrame([], schema)
            rows = restore_keys(rows, self.keys) if self.keys else rows
            whole = rows if whole is None else whole.unionByName(rows, allowMissingColumns=True)
        return whole.select(*map(named, self.columns))


@dataclass(frozen=True)
class Release:
    number: int
    run: str
    tables: Mapping[str, StoredTable]


def new_run() -> str:
    """The name of a run, and of its folder below ``runs``."""
    return uuid4().hex


def latest(spark: SparkSession, path: str) -> Release | None:
    """The last release under a path, or None."""
    try:
        entries = spark.read.schema(_MANIFEST).json(f"{path}/manifest/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # One row for each release; only the last one comes to the driver.
    row = entries.orderBy(F.col("number").desc(), "run").first()
    if row is None:
        return None
    tables = {
        t["name"]: StoredTable(
            t["fmt"], tuple(t["columns"]), tuple(Part(*p) for p in t["parts"]), tuple(t["keys"])
        )
        for t in row["tables"]
    }
    return Release(row["number"], row["run"], tables)


def publish(
    spark: SparkSession, path: str, run: str, tables: Mapping[str, StoredTable], after: Release | None
) -> Release:
    """Make the tables of a run the next release after one that was the last as the run began.

    Two runs at a time would each leave out what the other has added: if another run has published
    since, this one is refused, and its rows stay out.
    """
    number = after.number + 1 if after else 1
    now = latest(spark, path)
    if (now.number if now else 0) != number - 1:
        raise RuntimeError(f"another run has published release {now.number} meanwhile; run again")
    rows = [
        (name, t.fmt, list(t.columns), list(t.keys), [(p.folder, p.schema) for p in t.parts])
        for name, t in tables.items()
    ]
    entry = spark.createDataFrame([(number, run, rows)], _MANIFEST)
    entry.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest/{number:010d}")
    return Release(number, run, dict(tables))


def read_stored(spark: SparkSession, path: str | list[str], fmt: str, schema: StructType) -> DataFrame:
    """Read a stored output under the schema it was written with, which inference could miss."""
    options = ReadOptions(fmt=fmt, check=False)
    if fmt.lower() == "csv":
        options = replace(options, multiline=True, extra=KEEP_NUL)
    return read_table(spark, path, schema, options)

