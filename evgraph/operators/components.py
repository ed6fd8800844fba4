"""Connected components, and expansion by a bounded number of steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch | None = None, name: str = "cc", passes: int = 64) -> DataFrame:
    """Of (u, v) edges: (id, component) for each vertex that has an edge; component is the smallest id reachable.

    Alternating large-star and small-star passes over a written edge table. Each pass is two aggregations and two joins on vertex
    ids, whatever the size of a component; a vertex of very many edges is a hot join key, which adaptive execution splits.
    Nothing is collected but a count and a sum to see the fixpoint.
    """
    scratch = scratch or Scratch(edges.sparkSession, "components")
    now, state = scratch.write(_small(edges.filter("u <> v")), f"{name}-0"), None
    for i in range(1, passes + 1):
        new = scratch.write(_small(_large(now)), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        found = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = new
        if found == state or not found[0]:
            break
        state = found
    else:
        raise RuntimeError(f"no fixpoint after {passes} passes")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


def clusters(vertices: DataFrame, edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(id, component) of all vertices; one without an edge is its own component."""
    found = components(edges, scratch)
    return vertices.select("id").distinct().join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def expand(start: DataFrame, edges: DataFrame, passes: int = 8, scratch: Scratch | None = None) -> tuple[DataFrame, bool]:
    """All vertices that `passes` steps along (u, v) edges reach from `start` (id), and whether a further step would add none."""
    scratch = scratch or Scratch(edges.sparkSession, "expand")
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    seen = scratch.write(start.select("id").distinct(), "seen-0")
    frontier = seen
    for i in range(1, passes + 2):
        new = frontier.join(both, F.col("id") == F.col("u")).select(F.col("v").alias("id")).distinct().join(seen, "id", "left_anti")
        new = scratch.write(new, f"new-{i}")
        if new.isEmpty():
            return seen, True
        if i > passes:
            return seen, False
        seen, frontier = scratch.write(seen.unionByName(new), f"seen-{i}"), new
    return seen, False
