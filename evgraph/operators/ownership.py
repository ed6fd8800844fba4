"""Who owns a path: the most specific pattern of a registry, what lies outside a lane, and what requests put at risk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import path_matches, repository_path

# Shared files of a root, and marks of paths that ingest, speak of rights, change schemas or the shared contract.
ROOT_FILES = ("README.md", "AGENTS.md", "pyproject.toml", "requirements.txt", "requirements-dev.txt", "setup.py", "setup.cfg", "tox.ini", "pytest.ini", "package.json", "package-lock.json", "Makefile")
WORKFLOWS = ".github/workflows/"
SOURCES = ("sources/", "loaders/", "build_v3/", "scripts/", "index/")
RIGHTS = ("rights", "license", "terms", "source-methods/", "handoff", "manifest")
SCHEMAS = ("schema/", "migration", "ddl")
CONTRACTS = ("pg_observation", "pg-observation", "observation_contract", "observation-contract")

#: Paths of one place that are held against the patterns there in one go.
CHUNK = 50_000

REQUIRED = ("lane_id", "name", "repository", "branch", "owned_paths", "expected_artifacts", "validation_commands", "compatibility_seam")


def _prefixes(path: Column) -> Column:
    """A path's own prefixes by folders, with the empty one and itself: the nodes of a trie that it passes."""
    steps = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))


def _head(pattern: Column) -> Column:
    """The folder or path that a pattern names literally, in front of its first wildcard: where it hangs in a trie."""
    plain = F.regexp_replace(F.replace(pattern, F.lit("\\"), F.lit("/")), "^[./]+", "")
    literal = F.regexp_extract(plain, r"^[^*?\[]*", 0)
    folder = F.regexp_replace(F.regexp_replace(literal, "[^/]*$", ""), "/+$", "")
    return F.when(literal == plain, F.regexp_replace(plain, "/+$", "")).otherwise(folder)


def owners(paths: DataFrame, owned: DataFrame) -> DataFrame:
    """(repository, path, owner, pattern) of the owners of each path: `owned` has (repository, owner, pattern).

    Each path meets the patterns that hang at one of its own prefixes, by an equality join, and only those are matched: a pattern that
    ends in /** owns its root and all below it, others are globs. Patterns without a literal head hang at the root and meet all
    paths of their repository. The paths below a folder of more than CHUNK are dealt in so many parts, each of which meets all
    patterns there; there is at most one such folder for every CHUNK of the paths' prefixes, so they are broadcast."""
    distinct, prefixes = paths.select("repository", "path").distinct(), _prefixes(repository_path(F.col("path")))
    hung = owned.select("repository", "owner", "pattern", _head(F.col("pattern")).alias("_at"))
    folders = distinct.select("repository", F.explode(F.slice(prefixes, F.lit(1), F.greatest(F.size(prefixes) - 1, F.lit(1)))).alias("_at"))
    large = folders.groupBy("repository", "_at").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("_parts")).filter("_parts > 1")
    parts, last = F.broadcast(large), F.coalesce("_parts", F.lit(1)) - 1
    each = distinct.withColumn("_at", F.explode(prefixes)).join(parts, ["repository", "_at"], "left").withColumn("_part", F.pmod(F.xxhash64("path"), last + 1).cast("int")).drop("_parts")
    met = hung.join(parts, ["repository", "_at"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last))).drop("_parts")
    return each.join(met, ["repository", "_at", "_part"]).filter(path_matches(F.col("pattern"), F.col("path"))).select("repository", "path", "owner", "pattern", F.length("_at").alias("depth"))


def most_specific(paths: DataFrame, owned: DataFrame) -> DataFrame:
    """(repository, path, owner, pattern, owners): of each path the owner of the deepest pattern, of equally deep ones the longest, then
    the least by owner, and how many rows of `owned` own it; a path that nobody owns has nulls and 0."""
    found = owners(paths, owned)
    order = F.struct(-F.col("depth"), -F.length("pattern"), F.col("owner"), F.col("pattern"))
    best = found.groupBy("repository", "path").agg(F.min_by(F.struct("owner", "pattern"), order).alias("b"), F.count("*").alias("owners"))
    return paths.select("repository", "path").distinct().join(best, ["repository", "path"], "left").select("repository", "path", "b.owner", "b.pattern", F.coalesce("owners", F.lit(0)).cast("long").alias("owners"))


def outside(changes: DataFrame, lanes: DataFrame) -> DataFrame:
    """Changed paths (request, repository, branch, path) that the lane of their branch doesn't own; of branches that are a lane's."""
    lane = lanes.select("repository", "branch", "lane_id").dropDuplicates(["repository", "branch"])
    own = lanes.select("repository", F.col("lane_id").alias("owner"), F.explode("owned_paths").alias("pattern"))
    mine = changes.join(lane, ["repository", "branch"])
    held = owners(changes, own).select("repository", "path", F.col("owner").alias("lane_id")).distinct()
    return mine.join(held, ["repository", "path", "lane_id"], "left_anti").select("request", "lane_id", "repository", "path").distinct()


def _root(pattern: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.replace(pattern, F.lit("\\"), F.lit("/")), "^[./]+", ""), r"(/\*\*?)+$", ""), "/+$", "")


def registry_findings(lanes: DataFrame, expected: list[int] | None = None) -> DataFrame:
    """(code, lanes, paths): what is wrong in a registry of lanes, a row for each finding; `expected` are the ids that it must have.

    Overlaps are found by joining each root with the prefixes of the others', so they cost what the paths are long."""
    none, no_ids = F.array().cast("array<string>"), F.array().cast("array<int>")
    said = lambda rows, code, ids, paths=none: rows.select(F.lit(code).alias("code"), ids.cast("array<int>").alias("lanes"), paths.alias("paths"))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    whole = lanes.filter(F.size(missing) == 0)
    out = [said(lanes.filter(F.size(missing) > 0), "lane.required", F.array_compact(F.array("lane_id")), missing)]
    out.append(said(whole.groupBy("lane_id").agg(F.count("*").alias("n")).filter("n > 1"), "lane.duplicate_id", F.array("lane_id")))
    out.append(said(whole.groupBy("repository", "branch").agg(F.array_sort(F.collect_set("lane_id")).alias("ids"), F.count("*").alias("n")).filter("n > 1"), "lane.duplicate_branch", F.col("ids"), F.array("branch")))
    out.append(said(whole.filter(F.size("owned_paths") == 0), "lane.owned_paths", F.array("lane_id")))
    owned = whole.select("lane_id", "repository", F.explode("owned_paths").alias("pattern")).withColumn("root", _root(F.col("pattern")))
    out.append(said(owned.filter("root IN ('', '.')"), "lane.root_ownership", F.array("lane_id"), F.array("pattern")))
    inner = owned.select("repository", F.col("lane_id").alias("b"), F.col("pattern").alias("pb"), F.col("root").alias("rb"), F.explode(_prefixes(F.col("root"))).alias("root")).filter("root <> ''")
    outer = owned.select("repository", F.col("lane_id").alias("a"), F.col("pattern").alias("pa"), "root")
    pair = outer.join(inner, ["repository", "root"]).filter("a <> b AND (root <> rb OR a < b)")
    ordered = pair.select(F.when(F.col("a") < F.col("b"), F.struct("a", "b", "pa", "pb")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("pb").alias("pa"), F.col("pa").alias("pb"))).alias("p")).distinct()
    out.append(said(ordered, "lane.path_overlap", F.array("p.a", "p.b"), F.array("p.pa", "p.pb")))
    if expected is not None:
        ids = lanes.agg(F.array_sort(F.coalesce(F.collect_set("lane_id"), no_ids)).alias("ids"))
        out.append(said(ids.filter(F.col("ids") != F.lit(sorted(expected)).cast("array<int>")), "registry.expected_lanes", F.col("ids")))
    return reduce(DataFrame.unionByName, out)


def _holds(path: Column, marks: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.lower(path), F.lit(m)) for m in marks])


def path_classes(path: Column) -> dict[str, Column]:
    """What a changed path is: of ingestion, of rights, of a schema, of the shared contract, shared configuration."""
    said = repository_path(path)
    return {
        "is_source": reduce(lambda a, b: a | b, [F.startswith(said, F.lit(p)) for p in SOURCES]), "is_rights": _holds(said, RIGHTS), "is_schema": _holds(said, SCHEMAS), "is_contract": _holds(said, CONTRACTS),
        "is_shared": said.isin(*ROOT_FILES) | F.startswith(said, F.lit(WORKFLOWS)),
    }


def risks(changes: DataFrame, lanes: DataFrame) -> DataFrame:
    """(category, severity, requests, paths) of open requests (request, repository, branch, path): branches of no lane, paths outside
    the lane, a missing handoff, ingestion without a word on rights, and paths, shared files, schemas or the contract that several
    requests change."""
    rows = changes.filter(F.trim("path") != "").withColumn("path", repository_path(F.col("path"))).distinct()
    rows = rows.withColumns(path_classes(F.col("path")))
    lane = lanes.dropDuplicates(["repository", "branch"])
    said = lambda frame, category, severity: frame.select(F.lit(category).alias("category"), severity.alias("severity"), "requests", "paths")
    of = rows.groupBy("request", "repository", "branch").agg(F.array_sort(F.collect_set("path")).alias("paths"), F.bool_or("is_source").alias("source"), F.bool_or("is_rights").alias("rights")).withColumn("requests", F.array("request"))
    p0, p1 = F.lit("P0"), F.lit("P1")
    out = [said(of.join(lane, ["repository", "branch"], "left_anti"), "unknown_lane", p1)]
    beyond = outside(rows.select("request", "repository", "branch", "path"), lanes).groupBy("request").agg(F.array_sort(F.collect_set("path")).alias("paths")).withColumn("requests", F.array("request"))
    out.append(said(beyond, "outside_ownership", F.when(F.exists("paths", lambda p: F.startswith(p, F.lit("schema/"))), p0).otherwise(p1)))
    artifacts = F.filter("expected_artifacts", lambda a: F.endswith(a, F.lit(".md")) & F.contains(a, F.lit("handoff")))
    literal = F.filter("owned_paths", lambda a: F.contains(a, F.lit("handoff")) & ~F.endswith(a, F.lit("/**")))
    wanted = lane.select("repository", "branch", F.coalesce(F.get(artifacts, 0), F.get(literal, 0)).alias("handoff")).filter("handoff IS NOT NULL")
    out.append(said(of.join(wanted, ["repository", "branch"]).filter(~F.array_contains("paths", F.col("handoff"))).withColumn("paths", F.array("handoff")), "missing_handoff", p1))
    out.append(said(of.filter("source AND NOT rights"), "rights_surface", p1))
    several = rows.groupBy("repository", "path", "is_shared").agg(F.array_sort(F.collect_set("request")).alias("requests")).filter(F.size("requests") > 1).withColumn("paths", F.array("path"))
    out += [said(several, "path_overlap", p0), said(several.filter("is_shared"), "root_configuration", p1)]
    for kind, category in (("is_schema", "migration"), ("is_contract", "contract")):
        many = rows.filter(kind).groupBy("repository").agg(F.array_sort(F.collect_set("request")).alias("requests")).filter(F.size("requests") > 1).withColumn("paths", F.array().cast("array<string>"))
        out.append(said(many, category, p0))
    return reduce(DataFrame.unionByName, out)
