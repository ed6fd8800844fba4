"""Tables whose constraints hold: a change is staged, audited and published as a version, or leaves no trace."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.versions import Versions
from .contracts import changed, duplicates, orphans, violations

MODES = ("append", "ignore", "replace")


class Rejected(ValueError):
    """A change that breaks rules: of each its name, how many rows break it, and one of them."""

    def __init__(self, findings: list[tuple[str, int, str]]):
        super().__init__("; ".join(f"{rule}: {n} rows, such as {row}" for rule, n, row in findings))
        self.findings = findings


@dataclass
class Change:
    """Rows for a table: added, added where no row has their keys, or in place of all."""

    rows: DataFrame
    mode: str = "append"
    keys: tuple[str, ...] = ()


@dataclass
class Staged:
    """What a rule sees: tables as they would be, the rows that are new in each, and tables as they are."""

    after: Callable[[str], DataFrame]
    fresh: Callable[[str], DataFrame]
    before: Callable[[str], DataFrame | None]


#: A rule gives the rows that break it: (rule, row as JSON).
Rule = Callable[[Staged], DataFrame]


def _said(frame: DataFrame, name: str, *columns: str) -> DataFrame:
    return frame.select(F.lit(name).alias("rule"), F.to_json(F.struct(*columns)).alias("row"))


def unique(table: str, *keys: str, where: Column | None = None) -> tuple[str, Rule]:
    """No two rows agree in the keys, of those that `where` chooses; rows with a null key agree with none. Only keys that are new are
    looked up."""

    def rule(s: Staged) -> DataFrame:
        some = s.fresh(table).select(*keys).distinct().dropna()
        return _said(duplicates(s.after(table).join(some, list(keys), "left_semi"), list(keys), where), f"{table}.unique({', '.join(keys)})", *keys)

    return table, rule


def reference(table: str, key: str, parent: str, parent_key: str) -> tuple[str, Rule]:
    """A key that isn't null is one of the parent's; if the parent's rows are replaced, for all rows."""

    def rule(s: Staged) -> DataFrame:
        kept = s.before(parent) is None or s.fresh(parent).isEmpty()
        rows = s.fresh(table) if kept or not s.before(table) else s.after(table)
        return _said(orphans(rows, key, s.after(parent), parent_key), f"{table}.{key} of {parent}", key)

    return table, rule


def check(table: str, **conditions: Column) -> tuple[str, Rule]:
    """Each row meets all conditions; null passes."""

    def rule(s: Staged) -> DataFrame:
        rows = s.fresh(table)
        broken = violations(rows, **conditions)
        return broken.select(F.concat(F.lit(f"{table}.check "), "violated").alias("rule"), F.to_json(F.struct(*rows.columns)).alias("row"))

    return table, rule


def append_only(table: str, key: str) -> tuple[str, Rule]:
    """No row that has been published is changed or gone."""

    def rule(s: Staged) -> DataFrame:
        before = s.before(table)
        gone = changed(before, s.after(table), key) if before is not None else s.fresh(table).limit(0)
        return _said(gone, f"{table}.append_only", key)

    return table, rule


class Published:
    """A set of tables in versions.

    `commit` writes new rows aside, runs all rules on the tables as they would be, in one job, and publishes them with one rename; if
    a row breaks a rule, Rejected tells which and how many, and readers see what they saw. A change may bear a stream's name and
    the number of its batch: one that has been published already changes nothing, so a batch that is retried counts once.
    """

    def __init__(self, spark: SparkSession, root: str, rules: list[tuple[str, Rule]] | None = None):
        self.spark, self.store, self.rules = spark, Versions(spark, root), rules or []

    def version(self) -> int:
        return self.store.latest()

    def _read(self, manifest: dict, table: str) -> DataFrame | None:
        of = manifest.get("tables", {}).get(table)
        if of is None:
            return None
        rows = [self.store.read(p, of["schema"]) for p in of["parts"]]
        return reduce(DataFrame.unionByName, rows) if rows else self.spark.createDataFrame([], of["schema"])

    def table(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version, the newest by default."""
        found = self._read(self.store.manifest(version), name)
        if found is None:
            raise KeyError(name)
        return found

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self.store.manifest(version).get("tables", {}))

    def commit(self, changes: dict[str, Change], batch: tuple[str, int] | None = None) -> int:
        """Publishes changes to tables, all or none, and returns the version that has them."""
        base = self.store.latest()
        before = self.store.manifest(base)
        if batch is not None and before.get("batches", {}).get(batch[0], -1) >= batch[1]:
            return base
        after = {**before, "tables": dict(before.get("tables", {})), "batches": {**before.get("batches", {}), **({batch[0]: batch[1]} if batch else {})}}
        fresh: dict[str, str] = {}
        for name, change in changes.items():
            if change.mode not in MODES:
                raise ValueError(change.mode)
            held, rows = self._read(before, name), change.rows
            if held is not None:
                rows = rows.select(*held.columns)
            if change.mode == "ignore":
                rows = rows.dropDuplicates(list(change.keys))
                rows = rows if held is None else rows.join(held.select(*change.keys), list(change.keys), "left_anti").select(*held.columns)
            fresh[name] = part = self.store.stage()
            self.store.write(rows, part)
            schema = before["tables"][name]["schema"] if held is not None else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            after["tables"][name] = {"schema": schema, "parts": [*(before["tables"][name]["parts"] if held is not None and change.mode != "replace" else []), part]}
        new = lambda t: self.store.read(fresh[t], after["tables"][t]["schema"]) if t in fresh else self._read(after, t).limit(0)
        staged = Staged(lambda t: self._read(after, t), new, lambda t: self._read(before, t))
        wanted = [rule(staged) for table, rule in self.rules if table in after["tables"]]
        if wanted:
            found = reduce(DataFrame.unionByName, wanted).groupBy("rule").agg(F.count("*").alias("n"), F.min("row").alias("row")).orderBy("rule").collect()
            if found:
                raise Rejected([(r["rule"], r["n"], r["row"]) for r in found])
        return self.store.publish(after, base)
