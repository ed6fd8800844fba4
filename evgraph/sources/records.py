"""Reading and writing records: NDJSON, XML, database files, and merges into tables."""

from __future__ import annotations

import re
import sqlite3
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.jsonx import canonical
from ..operators.contracts import ENVELOPE, envelope_issues
from ..operators.lanes import lane_issues

# Where whole envelopes may be.
SEAM_TABLES = ("source_observation", "source_observations", "observation", "observations", "source_record")
SEAM_COLUMNS = ("envelope_json", "observation_json", "record_json", "payload_json")


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of an NDJSON file by a schema, with `raw` and a `problem` where a line is no JSON object; blank lines are skipped."""
    lines = spark.read.text(path).withColumnRenamed("value", "raw").filter(F.trim("raw") != "")
    parsed = F.from_json("raw", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.withColumn("_r", parsed)
    bad = ~F.ltrim("raw").startswith("{") | F.col("_r._bad").isNotNull() | F.try_parse_json("raw").isNull()
    return rows.withColumn("problem", F.when(F.coalesce(bad, F.lit(True)), F.lit("line.not_an_object"))).select("_r.*", "raw", "problem").drop("_bad")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their number in their file, blank ones counted and left out.

    Files are read in blocks by as many tasks as they need: a line's number is its place in its block, by the scan's own running id,
    and the lines of the blocks before it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("path", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return lines.join(blocks, ["path", "_block"]).select("path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_number"), "line").filter(F.trim("line") != "")


def read_checked(spark: SparkSession, path: str, lane: str | None = None) -> DataFrame:
    """Records of NDJSON files (path, line_number, line, issues) with all issues of each, by the shared contract or by a lane's rules; a
    line that is no JSON object has the one issue `record.object`."""
    lines = numbered_lines(spark, path)
    if lane is not None:
        return lane_issues(lines, "line", lane)
    parsed = lines.withColumn("_r", F.from_json("line", ENVELOPE)).select("path", "line_number", "line", "_r.*")
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT"), F.lit(False))
    none = F.array(F.struct(F.lit("record.object").alias("code"), F.lit("$").alias("path")))
    return envelope_issues(parsed, "line").select("path", "line_number", "line", F.when(whole, F.col("issues")).otherwise(none).alias("issues"))


def write_checked(records: DataFrame, raw: str, path: str, lane: str | None = None) -> None:
    """Records given as JSON text as canonical NDJSON, if none has an issue; else nothing is written."""
    checked = lane_issues(records, raw, lane) if lane is not None else envelope_issues(records.withColumn("_r", F.from_json(raw, ENVELOPE)).select(F.col(raw).alias("_raw"), "_r.*"), "_raw").withColumnRenamed("_raw", raw)
    bad = checked.filter(F.size("issues") > 0).select("issues").first()
    if bad is not None:
        raise ValueError(f"invalid record: {bad['issues'][0]['code']} at {bad['issues'][0]['path']}")
    checked.select(canonical(F.col(raw)).alias("value")).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole files of one JSON value each, or of an array of rows."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def receipts(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha256) of each file as it is stored."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


def json_seam(tables: dict[str, DataFrame]) -> tuple[str, str] | None:
    """The first table and column, of those known to, that hold whole envelopes as JSON text."""
    return next(((t, c) for t in SEAM_TABLES if t in tables for c in SEAM_COLUMNS if c in tables[t].columns), None)


def seam_records(tables: dict[str, DataFrame]) -> DataFrame:
    """Envelopes of a database's seam as text (`raw`) with their issues."""
    found = json_seam(tables)
    if found is None:
        raise ValueError("no table holds whole envelopes")
    rows = tables[found[0]].select(F.col(found[1]).alias("raw"))
    return envelope_issues(rows.withColumn("_r", F.from_json("raw", ENVELOPE)).select("raw", "_r.*"), "raw").select("raw", "issues")


def write_ndjson(frame: DataFrame, path: str, order: list[str | Column] | None = None) -> None:
    """A record a line with keys in canonical order; sorted over all files if an order is given."""
    names = sorted(frame.columns)
    rows = frame.orderBy(*order) if order else frame
    rows.select(canonical(F.to_json(F.struct(*names))).alias("value")).write.mode("overwrite").text(path)


def same_records(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records that only one of two tables has, as canonical text: empty after a faithful round trip."""
    text = lambda x: x.select(canonical(F.to_json(F.struct(*sorted(x.columns)))).alias("record"))
    x, y = text(a), text(b)
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def read_xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row).schema(schema).load(path)


def resolve_within(root: str, pointer: str) -> Path:
    """A file under a root folder; addresses, absolute paths and ways out of the root are refused."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", pointer) or Path(pointer).is_absolute():
        raise ValueError(f"not a path within the root: {pointer}")
    found = (Path(root) / pointer).resolve()
    if not found.is_relative_to(Path(root).resolve()):
        raise ValueError(f"leaves the root: {pointer}")
    return found


# ---------------------------------------------------------------- merges into tables


def keep_first(target: DataFrame, incoming: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Rows of incoming whose key the target lacks are added; of equal incoming keys the first."""
    new = incoming.join(target.select(*keys), keys, "left_anti").withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1")
    return target.unionByName(new.select(*target.columns))


def keep_last(target: DataFrame, incoming: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Incoming rows replace those of equal key; of equal incoming keys the last."""
    new = incoming.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1")
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*target.columns))


def merge(target: DataFrame, incoming: DataFrame, keys: list[str], *order: Column, **rules: Column) -> DataFrame:
    """Upsert: new values win where they aren't null; `rules` give other columns' values from `old_` and `new_` columns. Of incoming rows
    of one key each column's last value in `order` that isn't null counts, without an order the greatest, as if the rows came one after
    another; a rule sees that value."""
    rest = [c for c in target.columns if c not in keys]
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))) if order else F.max(c)
    old = target.select(*keys, *[F.col(c).alias(f"old_{c}") for c in rest])
    new = incoming.groupBy(*keys).agg(*[last(c).alias(f"new_{c}") for c in rest]) if rest else incoming.select(*keys).distinct()
    both = old.join(new, keys, "full")
    return both.select(*keys, *[rules.get(c, F.coalesce(f"new_{c}", f"old_{c}")).alias(c) for c in rest])


def keep_known(column: str, unknown: str = "unknown") -> Column:
    """For `merge`: a new value unless it is unknown."""
    return F.when(F.coalesce(F.col(f"new_{column}"), F.lit(unknown)) != unknown, F.col(f"new_{column}")).otherwise(F.coalesce(f"old_{column}", F.lit(unknown)))


def alias_history(observed: DataFrame) -> DataFrame:
    """Intervals of mutable aliases (account, alias, observed_at): one ends when another is first seen after it."""
    own = Window.partitionBy("account").orderBy("observed_at", "alias")
    starts = observed.withColumn("_before", F.lag("alias").over(own)).filter(~F.col("alias").eqNullSafe(F.col("_before")))
    return starts.select("account", "alias", F.col("observed_at").alias("valid_from"), F.lead("observed_at").over(own).alias("valid_to"))


# ---------------------------------------------------------------- database files


class _Rows(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.table, self.parts = schema, options["path"], options["table"], int(options.get("partitions", 1))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = ", ".join('"' + f.name.replace('"', '""') + '"' for f in self.schema.fields)
        table = self.table.replace('"', '""')
        con = sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)
        try:
            part = f" WHERE rowid % {self.parts} = {int(partition.value)}" if self.parts > 1 else ""
            yield from con.execute(f'SELECT {names} FROM "{table}"{part}')
        finally:
            con.close()


class SqliteSource(DataSource):
    """Read-only tables of a database file: format `sqlite_ro`, options path, table, partitions; the file must be on all executors."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_ro"

    def schema(self) -> str:
        con = sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)
        try:
            kinds = {"INTEGER": "bigint", "INT": "bigint", "REAL": "double"}
            table = self.options["table"].replace('"', '""')
            return ", ".join(f"`{r[1]}` {kinds.get(r[2].upper(), 'string')}" for r in con.execute(f'PRAGMA table_info("{table}")'))
        finally:
            con.close()

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Rows(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)
