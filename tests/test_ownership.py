"""Owners of paths, registries of lanes and risks of requests."""

import pytest
from pyspark.sql import functions as F

from evgraph.operators import ownership

OWNED = [(1, "sources/**"), (2, "sources/media/**"), (3, "*.md"), (4, "docs/[a-c]*.txt"), (5, "sources/media/pilot.py"), (6, "schema/v?/*.sql"), (7, "./tools//**"), (8, "a/**/b.py"), (9, "sources\\web\\**")]


@pytest.mark.parametrize(
    ("path", "owner", "every"),
    [
        ("sources/x.py", 1, {1}), ("sources", 1, {1}), ("sources/media/x.py", 2, {1, 2}), ("sources/media/pilot.py", 5, {1, 2, 5}), ("README.md", 3, {3}), ("deep/er/README.md", 3, {3}), ("docs/alpha.txt", 4, {4}), ("docs/zeta.txt", None, set()), ("schema/v3/x.sql", 6, {6}),
        ("schema/v33/x.sql", None, set()), ("sourcesx/a.py", None, set()), ("./sources//media/y.py", 2, {1, 2}), ("tools/run.py", 7, {7}), ("a/x/y/b.py", 8, {8}), ("sources/web/a.py", 9, {1, 9}), ("", None, set()),
    ],
)
def test_owners(spark, path, owner, every):
    paths = spark.createDataFrame([("r", path), ("r", path), ("other", path)], "repository string, path string")
    owned = spark.createDataFrame([("r", i, p) for i, p in OWNED], "repository string, owner int, pattern string")
    best = {r["repository"]: r["owner"] for r in ownership.most_specific(paths, owned).collect()}
    assert best == {"r": owner, "other": None}
    assert {r["owner"] for r in ownership.owners(paths, owned).collect()} == every


LANE = "lane_id int, name string, repository string, branch string, owned_paths array<string>, expected_artifacts array<string>, validation_commands array<string>, compatibility_seam string"


def lane(i, *paths, branch=None, artifacts=(), **other):
    return {"lane_id": i, "name": f"l{i}", "repository": "r", "branch": branch or f"b{i}", "owned_paths": list(paths), "expected_artifacts": list(artifacts), "validation_commands": [], "compatibility_seam": "s"} | other


def lanes_of(spark, *rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in LANE.split(", ")) for r in rows], LANE)


def test_registry(spark):
    good = lanes_of(spark, lane(1, "sources/a/**"), lane(2, "sources/b/*", "x.py"))
    assert ownership.registry_findings(good, [1, 2]).count() == 0
    bad = lanes_of(spark, lane(1, "sources/**"), lane(2, "sources/b/*", "sources/c.py"), lane(2, "d/**", branch="b1"), lane(4), lane(5, "./"), lane(6, "e/**", name=None), lane(7, "d/**"), lane(8, "d2/**"), lane(9, "f/**", repository="q"), lane(10, "f/**"))
    got = sorted((r["code"], tuple(r["lanes"]), tuple(r["paths"])) for r in ownership.registry_findings(bad, [1, 2]).collect())
    assert got == sorted([
        ("lane.required", (6,), ("name",)), ("lane.duplicate_id", (2,), ()), ("lane.duplicate_branch", (1, 2), ("b1",)), ("lane.owned_paths", (4,), ()), ("lane.root_ownership", (5,), ("./",)), ("lane.path_overlap", (1, 2), ("sources/**", "sources/b/*")),
        ("lane.path_overlap", (1, 2), ("sources/**", "sources/c.py")), ("lane.path_overlap", (2, 7), ("d/**", "d/**")), ("registry.expected_lanes", (1, 2, 4, 5, 6, 7, 8, 9, 10), ()),
    ])


def test_risks(spark):
    registry = lanes_of(spark, lane(1, "sources/a/**", artifacts=["handoff/one.md"]), lane(2, "lib/**", "docs/handoff.md"))
    changes = [
        (10, "b1", ["sources/a/x.py", "sources/a/y.py"]), (11, "b2", ["lib/x.py", "schema/v3/t.sql", "README.md", "docs/handoff.md"]), (12, "nobody", ["README.md", "sql/migration_1.sql", "src/pg_observation.py"]), (13, "b1", ["sources/a/terms.md", "handoff/one.md", "src/pg-observation.json"]), (14, "b2", [" ", "lib/y.py", "docs/handoff.md", "lib/x.py"]),
    ]
    rows = spark.createDataFrame([(n, "r", b, p) for n, b, paths in changes for p in paths], "request int, repository string, branch string, path string")
    got = sorted((r["category"], r["severity"], tuple(r["requests"]), tuple(r["paths"])) for r in ownership.risks(rows, registry).collect())
    assert got == sorted([
        ("unknown_lane", "P1", (12,), ("README.md", "sql/migration_1.sql", "src/pg_observation.py")), ("outside_ownership", "P0", (11,), ("README.md", "schema/v3/t.sql")), ("outside_ownership", "P1", (13,), ("handoff/one.md", "src/pg-observation.json")), ("missing_handoff", "P1", (10,), ("handoff/one.md",)),
        ("rights_surface", "P1", (10,), ("sources/a/x.py", "sources/a/y.py")), ("path_overlap", "P0", (11, 12), ("README.md",)), ("path_overlap", "P0", (11, 14), ("docs/handoff.md",)), ("path_overlap", "P0", (11, 14), ("lib/x.py",)), ("root_configuration", "P1", (11, 12), ("README.md",)), ("migration", "P0", (11, 12), ()), ("contract", "P0", (12, 13), ()),
    ])
    assert ownership.risks(rows.limit(0), registry).count() == 0


def test_paths_of_one_folder_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ownership, "CHUNK", 50, raising=False)
    paths = spark.range(2000).selectExpr("'r' AS repository", "concat(if(id % 4 = 0, 'a', 'b'), '/', id, '.py') AS path")
    owned = spark.createDataFrame([("r", 1, "*.py"), ("r", 2, "a/**"), ("r", 3, "*8.py"), ("r", 4, "b/1.py")], "repository string, owner int, pattern string")
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        tasks = ownership.owners(paths, owned).groupBy(F.spark_partition_id()).count().collect()
        found = {r["path"]: (r["owner"], r["owners"]) for r in ownership.most_specific(paths, owned).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in tasks) == 2000 + 500 + 200 + 1 and max(r["count"] for r in tasks) < 1500
    for i in range(2000):
        path = f"{'b' if i % 4 else 'a'}/{i}.py"
        owner = 4 if i == 1 else 2 if i % 4 == 0 else 3 if i % 10 == 8 else 1
        assert found[path] == (owner, 1 + (i % 10 == 8) + (i % 4 == 0) + (i == 1))
