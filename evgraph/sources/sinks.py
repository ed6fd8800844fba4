"""Batch writers whose rows are visible as a whole or not at all: database files by key, and canonical NDJSON in one order."""

from __future__ import annotations

import json
import os
import shutil
import sqlite3
import uuid
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, BooleanType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType

from ..functions.jsonx import canonical_of
from ..plans.versions import Conflict, Versions

SHARD = "_shard"
#: Columns of a database file for columns of a frame, and back.
STORED = {StringType: "TEXT", LongType: "INTEGER", IntegerType: "INTEGER", ShortType: "INTEGER", ByteType: "INTEGER", BooleanType: "BOOLEAN", DoubleType: "REAL", FloatType: "REAL", BinaryType: "BLOB"}
LOADED = {"TEXT": "string", "INTEGER": "bigint", "BOOLEAN": "boolean", "REAL": "double", "BLOB": "binary"}


def _folder(path: str) -> Path:
    """A folder of the file system; database files can't be in any other store."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"database files need a mounted folder, not {parts.scheme}")
    return Path(unquote(parts.path) if parts.scheme else path)


def _name(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _stored(kind: DataType) -> str:
    if type(kind) not in STORED:
        raise ValueError(f"a database file has no columns of {kind.simpleString()}")
    return STORED[type(kind)]


def _latest(root: Path) -> int:
    return max((int(p.stem) for p in (root / "_versions").glob("[0-9]*.json")), default=0)


def _manifest(root: Path, version: int) -> dict:
    return json.loads((root / "_versions" / f"{version:08d}.json").read_text()) if version else {"tables": {}, "batches": []}


@dataclass
class _Written(WriterCommitMessage):
    """What a task has staged: the file of each of its shards."""

    files: dict[int, str]


class _Shards(DataSourceWriter):
    """One task writes whole shards: a copy of the file that is there, under a name of its own, with the new rows. The files count once
    the manifest names them; a task that fails, is lost or runs twice leaves files that nothing names."""

    def __init__(self, schema: StructType, options: dict):
        self.root, self.table = _folder(options["path"]), options["table"]
        self.keys, self.verb = json.loads(options["keys"]), {"ignore": "IGNORE", "replace": "REPLACE"}[options["conflict"]]
        self.base, self.shards, self.batch = int(options["base"]), int(options["shards"]), options.get("batch")
        self.names = [f.name for f in schema.fields]
        self.columns = [f"{_name(f.name)} {_stored(f.dataType)}" for f in schema.fields if f.name != SHARD]
        self.before = _manifest(self.root, self.base)["tables"].get(self.table, {}).get("files", {})

    def write(self, rows: Iterator) -> _Written:
        at, keys, files, con = self.names.index(SHARD), [self.names.index(k) for k in self.keys], {}, None
        places = ", ".join("?" * len(self.columns))
        try:
            for row in rows:  # sorted by shard
                shard = row[at]
                if shard not in files:
                    if con is not None:
                        con.commit()
                        con.close()
                    files[shard] = f"data/{shard:05d}-{uuid.uuid4().hex}.db"
                    con = self._open(shard, self.root / files[shard])
                if any(row[k] is None for k in keys):
                    raise ValueError(f"a key of {self.table} is null")
                con.execute(f"INSERT OR {self.verb} INTO {_name(self.table)} VALUES ({places})", [v for i, v in enumerate(row) if i != at])
            if con is not None:
                con.commit()
        except BaseException:
            self._remove(files)
            raise
        finally:
            if con is not None:
                con.close()
        return _Written(files)

    def _open(self, shard: int, goal: Path) -> sqlite3.Connection:
        goal.parent.mkdir(parents=True, exist_ok=True)
        if str(shard) in self.before:
            shutil.copyfile(self.root / self.before[str(shard)], goal)
        con = sqlite3.connect(goal)
        con.execute("PRAGMA journal_mode = OFF")  # a file that isn't whole is never named
        con.execute(f"CREATE TABLE IF NOT EXISTS {_name(self.table)} ({', '.join(self.columns)}, PRIMARY KEY ({', '.join(map(_name, self.keys))}))")
        return con

    def _remove(self, files: dict[int, str]) -> None:
        for f in files.values():
            (self.root / f).unlink(missing_ok=True)

    def commit(self, messages: list[_Written | None]) -> None:
        new: dict[str, str] = {}
        for m in messages:
            for shard, name in (m.files if m is not None else {}).items():
                if str(shard) in new:
                    raise RuntimeError(f"two tasks wrote shard {shard}")
                new[str(shard)] = name
        manifest = _manifest(self.root, self.base)
        manifest["tables"][self.table] = {"shards": self.shards, "keys": self.keys, "columns": self.columns, "files": self.before | new}
        if self.batch is not None:
            manifest["batches"] = [*manifest["batches"], f"{self.table}:{self.batch}"]
        place = self.root / "_versions"
        place.mkdir(parents=True, exist_ok=True)
        hidden = place / f".{uuid.uuid4().hex}"
        hidden.write_text(json.dumps(manifest, sort_keys=True))
        try:
            os.link(hidden, place / f"{self.base + 1:08d}.json")  # fails where another writer was first
        except FileExistsError as e:
            raise Conflict(f"version {self.base + 1} is there already") from e
        finally:
            hidden.unlink()

    def abort(self, messages: list[_Written | None]) -> None:
        for m in messages:
            if m is not None:
                self._remove(m.files)


class _Files(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.root, self.table, self.names = _folder(options["path"]), options["table"], [f.name for f in schema.fields]
        self.truth = [i for i, f in enumerate(schema.fields) if isinstance(f.dataType, BooleanType)]
        self.files = _table(self.root, self.table, options)["files"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for _, f in sorted(self.files.items())] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        with closing(sqlite3.connect(f"{(self.root / partition.value).as_uri()}?mode=ro", uri=True)) as con:
            for row in con.execute(f"SELECT {', '.join(map(_name, self.names))} FROM {_name(self.table)}"):
                yield tuple(None if v is None else bool(v) if i in self.truth else v for i, v in enumerate(row)) if self.truth else row


def _table(root: Path, table: str, options: dict) -> dict:
    found = _manifest(root, int(options["version"]) if "version" in options else _latest(root))["tables"]
    if table not in found:
        raise ValueError(f"no table {table} in {root}")
    return found[table]


class SqliteShards(DataSource):
    """Format `sqlite_shards`: a table in database files, one for each shard of its keys, in a folder that the driver and all executors
    mount. Options for reading: path, table, version (the newest if absent). Writing is by `upsert_files`."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_shards"

    def schema(self) -> str:
        columns = _table(_folder(self.options["path"]), self.options["table"], self.options)["columns"]
        split = [c.rsplit(" ", 1) for c in columns]
        return ", ".join(f"`{n[1:-1].replace(chr(34) * 2, chr(34)).replace('`', '``')}` {LOADED[k]}" for n, k in split)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Files(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("rows are put in by key: use mode append")
        return _Shards(schema, self.options)


def upsert_files(frame: DataFrame, path: str, table: str, keys: list[str], order: list[Column | str], conflict: str = "ignore", shards: int = 32, batch: str | None = None) -> int:
    """Puts rows into a table of database files by key and publishes a version, whose number is returned.

    conflict `ignore` keeps the row that is there, and of the batch the first in `order`; `replace` takes the batch's, the last in
    `order`. Rows of one key are reduced before they are shuffled, so a hot key is one row by then; rows equal in `order` are told
    apart by their other columns. A batch with a number counts once: a second write of it changes nothing. A failed task, a null key
    (ValueError in the task) or another writer who was first (Conflict) leaves the version there was. `shards` counts for the
    first batch of a table; an empty batch makes a version, too. Columns that aren't keys must be orderable and of a plain type.
    """
    if conflict not in ("ignore", "replace"):
        raise ValueError(conflict)
    if SHARD in frame.columns:
        raise ValueError(f"a column is named {SHARD}")
    spark, root = frame.sparkSession, _folder(path)
    spark.dataSource.register(SqliteShards)
    base = _latest(root)
    now = _manifest(root, base)
    if batch is not None and f"{table}:{batch}" in now["batches"]:
        return base
    there = now["tables"].get(table)
    columns = [f"{_name(f.name)} {_stored(f.dataType)}" for f in frame.schema.fields]
    if there is not None and (there["columns"] != columns or there["keys"] != keys):
        raise ValueError(f"{table} has other columns or keys")
    n = there["shards"] if there is not None else shards
    own, rest = [_column(k) for k in keys], [_column(c) for c in frame.columns if c not in keys]
    by = [c if isinstance(c, Column) else _column(c) for c in order]
    pick = F.min_by if conflict == "ignore" else F.max_by
    one = frame.groupBy(*own).agg(pick(F.struct(*rest), F.struct(*by, *rest)).alias("_r")).select(*own, "_r.*").select(*map(_column, frame.columns)) if rest else frame.distinct()
    placed = one.withColumn(SHARD, F.pmod(F.xxhash64(*own), F.lit(n)).cast("int")).repartition(n, SHARD).sortWithinPartitions(SHARD, *own)
    options = {"path": str(root), "table": table, "keys": json.dumps(keys), "conflict": conflict, "base": str(base), "shards": str(n)} | ({} if batch is None else {"batch": batch})
    placed.write.format("sqlite_shards").options(**options).mode("append").save()
    return base + 1


def read_files(spark: SparkSession, path: str, table: str, version: int | None = None) -> DataFrame:
    """A table of database files, by its newest version or an earlier one."""
    spark.dataSource.register(SqliteShards)
    options = {"path": path, "table": table} | ({} if version is None else {"version": str(version)})
    return spark.read.format("sqlite_shards").options(**options).load()


def publish_ndjson(frame: DataFrame, path: str, order: list[Column | str]) -> int:
    """Writes a record a line, keys in canonical order, lines in `order` over all files by their names, in any store; the version that
    is returned is visible when all tasks are done, an earlier one until then. Lines equal in `order` go by their text."""
    versions = Versions(frame.sparkSession, path)
    base, name = versions.latest(), versions.stage()
    text = canonical_of(frame, F.struct(*frame.columns))
    frame.withColumn("_line", text).orderBy(*order, "_line").select(F.col("_line").alias("value")).write.text(f"{versions.root}/{name}")
    return versions.publish({"lines": name}, base)


def published_ndjson(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Lines (value) of a published version, the newest if none is given."""
    versions = Versions(spark, path)
    return spark.read.text(f"{versions.root}/{versions.manifest(version)['lines']}")
