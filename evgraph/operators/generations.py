"""Generations of clusters as deltas: each decision costs what it touches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import ELIGIBLE
from ..plans.scratch import Scratch
from ..plans.versions import Versions
from .identity import generation, origin_rank

#: Deltas beyond which a generation is written whole.
PARTS = 16
ROW = ("cluster_id", "canonical_id", "rank", "strong")


class Generations:
    """Versions of (entity_id, cluster_id, canonical_id), each the clusters of all active acceptances of a decision log.

    A generation is made from the one before: acceptances that came or went, and entities that are new, gone or of another standing,
    touch their clusters, and only the members of those are clustered again. What differs is written, as are the acceptances that
    came or went; a read takes of each entity the last row up to a generation. A log that changes nothing makes no generation. After
    `most` deltas one is written whole; earlier generations stay readable.
    """

    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        self.spark, self.store = spark, Versions(spark, root)
        self.number = self.store.latest() if number is None else number
        self.manifest = self.store.manifest(self.number)

    @property
    def latest(self) -> int:
        """The number of the newest generation, 0 where there is none."""
        return self.store.latest()

    def at(self, number: int) -> Generations:
        """An earlier generation."""
        if number not in self.store.numbers():
            raise ValueError(f"no generation {number}")
        return Generations(self.spark, self.store.root, number)

    def _last(self, part: str, keys: list[str], schema: str) -> DataFrame:
        """Of each key the row of the last part that has one, without those that are gone."""
        parts = self.manifest.get("parts", [])
        if not parts:
            return self.spark.createDataFrame([], schema).drop("gone")
        rows = [self.store.read(f"{p}/{part}", schema).withColumn("_n", F.lit(i)) for i, p in enumerate(parts)]
        if len(rows) == 1:
            return rows[0].filter("NOT gone").drop("_n", "gone")
        others = [c for c in rows[0].columns if c not in (*keys, "_n")]
        last = reduce(DataFrame.unionByName, rows).groupBy(*keys).agg(F.max_by(F.struct(*others), "_n").alias("r"))
        return last.select(*keys, "r.*").filter("NOT gone").drop("gone")

    def _kind(self, entities: DataFrame | None = None) -> str:
        return self.manifest.get("kind") or entities.schema["entity_id"].dataType.simpleString()

    def _rows(self, kind: str) -> DataFrame:
        return self._last("members", ["entity_id"], f"entity_id {kind}, cluster_id string, canonical_id {kind}, rank int, strong long, gone boolean")

    def _edges(self, kind: str) -> DataFrame:
        return self._last("edges", ["u", "v"], f"u {kind}, v {kind}, gone boolean")

    def members(self) -> DataFrame:
        """(entity_id, cluster_id, canonical_id) of this generation."""
        if not self.manifest:
            raise ValueError("no generation has been made")
        return self._rows(self._kind()).select("entity_id", "cluster_id", "canonical_id")

    def apply(self, entities: DataFrame, decisions: DataFrame, identifiers: DataFrame, reason: str = "", most: int = PARTS) -> Generations:
        """The generation of a decision log: this one if nothing changes, else the next."""
        kind, scratch = self._kind(entities), Scratch(self.spark, "generation")
        strong = identifiers.filter(F.col("valid_to").isNull() & F.col("scheme").isin(*ELIGIBLE)).groupBy("entity_id").agg(F.count("*").alias("strong"))
        standing = entities.select(F.col("entity_id").cast(kind).alias("entity_id"), origin_rank(F.col("origin")).cast("int").alias("rank")).join(strong, "entity_id", "left").select("entity_id", "rank", F.coalesce("strong", F.lit(0)).cast("long").alias("strong"))
        pair = [f(F.col("entity_a").cast(kind), F.col("entity_b").cast(kind)).alias(n) for f, n in ((F.least, "u"), (F.greatest, "v"))]
        wanted = scratch.write(decisions.filter("active AND outcome = 'accepted'").select(*pair).filter("u <> v").distinct(), "wanted")
        held, before = self._edges(kind), self._rows(kind)
        came = wanted.join(held, ["u", "v"], "left_anti").withColumn("gone", F.lit(False))
        went = held.join(wanted, ["u", "v"], "left_anti").withColumn("gone", F.lit(True))
        moved = scratch.write(came.unionByName(went), "moved")
        old = before.select("entity_id", F.col("rank").alias("_rank"), F.col("strong").alias("_strong"), F.lit(True).alias("_old"))
        both = standing.withColumn("_new", F.lit(True)).join(old, "entity_id", "full")
        other = both.filter("_old IS NULL OR _new IS NULL OR rank <> _rank OR strong <> _strong").select("entity_id")
        touched = scratch.write(moved.select(F.explode(F.array("u", "v")).alias("entity_id")).unionByName(other).distinct(), "touched")
        if touched.isEmpty():
            return self
        # all members of the clusters that are touched, and what was in none
        near = before.join(touched, "entity_id", "left_semi").select("cluster_id").distinct()
        area = scratch.write(before.join(near, "cluster_id", "left_semi").select("entity_id").unionByName(touched).distinct(), "area")
        inside = wanted.join(area.withColumnRenamed("entity_id", "u"), "u", "left_semi")
        some = entities.join(area, "entity_id", "left_semi")
        log = inside.select(F.col("u").alias("entity_a"), F.col("v").alias("entity_b"), F.lit(True).alias("active"), F.lit("accepted").alias("outcome"))
        known = some.select(F.col("entity_id").alias("_e")).distinct()  # an acceptance of an entity that is gone joins nothing
        log = log.join(known, F.col("entity_a") == F.col("_e"), "left_semi").join(known, F.col("entity_b") == F.col("_e"), "left_semi")
        new = generation(some, log, identifiers, scratch).join(standing, "entity_id").withColumn("gone", F.lit(False))
        was = before.join(area, "entity_id", "left_semi")
        same = was.select("entity_id", *[F.col(c).alias(f"_{c}") for c in ROW])
        fresh = new.join(same, "entity_id", "left").filter(" OR ".join(f"NOT ({c} <=> _{c})" for c in ROW)).select("entity_id", *ROW, "gone")
        lost = was.join(standing, "entity_id", "left_anti").withColumn("gone", F.lit(True)).select("entity_id", *ROW, "gone")
        name = self.store.stage()
        self.store.write(fresh.unionByName(lost), f"{name}/members")
        self.store.write(moved, f"{name}/edges")
        written = self.store.read(f"{name}/members").count()
        parts = [*self.manifest.get("parts", []), name]
        manifest = {"kind": kind, "parts": parts, "reason": reason, "rows": written}
        if len(parts) > most:
            merged = Generations(self.spark, self.store.root, self.number)
            merged.manifest = manifest
            whole = self.store.stage()
            self.store.write(merged._rows(kind).withColumn("gone", F.lit(False)), f"{whole}/members")
            self.store.write(merged._edges(kind).withColumn("gone", F.lit(False)), f"{whole}/edges")
            manifest = {**manifest, "parts": [whole]}
        return Generations(self.spark, self.store.root, self.store.publish(manifest, self.number))
