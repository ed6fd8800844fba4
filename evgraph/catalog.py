"""Tables by domain, and what a query may count on: absent tables are gaps, not errors."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.textindex import TextIndex

DOMAINS = ("people", "books", "github", "awesome", "locator")
#: Tables that answers use when they are there: of the people domain, and those of the later schema.
EXPECTED = ("person", "person_content", "external_ids", "person_topic", "identity_claim", "person_search")
ADDITIVE = ("identity_cluster", "identity_decision", "entity_alias", "assertion", "relationship", "source_snapshot")


@dataclass
class Config:
    """Paths of domains and where each came from: explicit, file, environment or default, in this order of precedence."""

    paths: dict[str, str] = field(default_factory=dict)
    origins: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, explicit: Mapping[str, str] | None = None, file: str | None = None, env: Mapping[str, str] | None = None, root: str = ".") -> Config:
        env = os.environ if env is None else env
        listed = json.loads(Path(file).read_text()) if file and Path(file).exists() else {}
        out = cls()
        for domain in DOMAINS:
            for origin, path in (("explicit", (explicit or {}).get(domain)), ("file", listed.get(domain)), ("environment", env.get(f"EVGRAPH_{domain.upper()}")), ("default", f"{root}/{domain}" if Path(root, domain).is_dir() else None)):
                if path:
                    out.paths[domain], out.origins[domain] = str(path), origin
                    break
        return out


class Catalog:
    """(domain, table) to DataFrame."""

    def __init__(self, spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame] | None = None):
        self.spark, self.tables, self.notes = spark, dict(tables or {}), []
        self.indexes: dict[tuple[str, str], TextIndex] = {}

    @classmethod
    def open(cls, spark: SparkSession, config: Config) -> Catalog:
        """A folder of Parquet tables and text indexes for each domain; one that can't be read is a note."""
        out = cls(spark)
        for domain, path in config.paths.items():
            try:
                jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
                fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
                for status in fs.listStatus(jpath):
                    name = status.getPath().getName()
                    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_versions")):
                        out.indexes[domain, name] = TextIndex(spark, f"{path}/{name}")
                    elif not name.startswith(("_", ".")):
                        out.tables[domain, name.removesuffix(".parquet")] = spark.read.parquet(f"{path}/{name}")
            except Exception as e:  # noqa: BLE001  any reader's failure is the same to a caller
                out.notes.append(f"could not attach {domain}: {type(e).__name__}")
        return out

    def has(self, domain: str, table: str) -> bool:
        return (domain, table) in self.tables or (domain, table) in self.indexes

    def get(self, domain: str, table: str) -> DataFrame:
        return self.tables[domain, table]

    def missing(self) -> list[str]:
        return [f"people.{t}" for t in (*EXPECTED, *ADDITIVE) if not self.has("people", t)]

    def identity_mode(self) -> str:
        """`v3` with decision or cluster tables, `v2` with claims, else `none`."""
        if self.has("people", "identity_decision") or self.has("people", "identity_cluster"):
            return "v3"
        return "v2" if self.has("people", "identity_claim") else "none"

    def inventory(self) -> DataFrame:
        """Rows of each table."""
        out = None
        for (domain, table), frame in sorted(self.tables.items()):
            row = frame.agg(F.count("*").alias("rows")).select(F.lit(domain).alias("domain"), F.lit(table).alias("table"), "rows")
            out = row if out is None else out.unionByName(row)
        return out if out is not None else self.spark.createDataFrame([], "domain string, table string, rows long")

    def sources(self) -> DataFrame:
        """Snapshots with rights and freshness."""
        if not self.has("people", "source_snapshot"):
            return self.spark.createDataFrame([], "source string, rights_state string, retrieved_at string")
        snapshot = self.get("people", "source_snapshot")
        named = snapshot.withColumnRenamed("source_id", "source") if "source_id" in snapshot.columns else snapshot
        return named.select("source", "rights_state", "retrieved_at")


def optional(frame: DataFrame, column: str, kind: str = "string"):
    """A column, or null where the table has none of that name."""
    return F.col(column).cast(kind) if column in frame.columns else F.lit(None).cast(kind).alias(column)
