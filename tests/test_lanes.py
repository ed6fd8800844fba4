"""Rules of the lanes, records with line numbers, the identity write path, imports of a person graph, and the full `who`."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from evgraph.catalog import Catalog
from evgraph.engine import Engine
from evgraph.functions import text
from evgraph.operators import identity, lanes
from evgraph.sources import imports, records

SHA = "0" * 64
ID = {"scheme": "orcid", "value": "1", "scope": "global", "stability": "stable", "uniqueness": "unique", "evidence": "e"}
DAY = "2024-01-02T00:00:00Z"


def record(**changes):
    out = {
        "envelope_version": "pg-observation-0.1", "source": {"source_id": "s", "snapshot_id": "p", "record_native_id": "r", "observed_at": DAY, "retrieved_at": DAY, "terms_revision": "t", "rights_state": "open_data", "payload_sha256": SHA},
        "subject": {"kind": "work", "source_native_id": "n", "label": "l", "attributes": {}}, "identifiers": [ID], "contributions": [], "relationships": [], "evidence": [], "raw_pointer": "x",
    }
    for k, v in changes.items():
        where, _, field = k.partition("__")
        if field:
            out[where][field] = v
        else:
            out[k] = v
    return out


def codes(spark, lane, *found):
    rows = [(i, json.dumps(r) if isinstance(r, dict) else r, "own") for i, r in enumerate(found)]
    out = lanes.lane_issues(spark.createDataFrame(rows, "n int, raw string, issues string"), "raw", lane).orderBy("n").collect()
    return [sorted({i["code"] for i in r["issues"]}) for r in out]


def test_software_rules(spark):
    agent = {"kind": "person", "source_native_id": "a", "label": "A", "identifiers": [{**ID, "scheme": "name"}]}
    relation = {"predicate": "p", "evidence": "e", "observed_at": DAY, "object": {"kind": "work", "source_native_id": "w", "label": "W"}, "valid_time": {"from": "nope"}}
    got = codes(
        spark, "software", record(), record(source__retrieved_at="2024-01-01T00:00:00Z"), record(contributions=[{"role": "r", "observed_at": DAY, "agent": agent}]), record(contributions=[{"role": " ", "observed_at": DAY, "agent": {"kind": "work", "source_native_id": "a", "label": ""}}]), record(relationships=[relation]),
        record(subject__attributes={"metrics": [{"name": "n", "value": 1}]}), record(evidence=[{"kind": "k", "locator": "", "observed_at": "2024-01-01T00:00:00"}]), record(subject__attributes={"deep": [{"rank_score": 1}]}), "[]", None, "{", record(envelope_version="x", raw_pointer=" "),
    )
    assert got == [[], ["source.time_order"], ["identifier.attribute_promoted"], ["agent.kind", "required.text"], ["format.iso8601"], ["required.text"], ["format.timezone", "required.text"], ["identity.canonical_id_forbidden"], ["record.object"], ["record.object"], ["record.object"], ["envelope.version", "required.text"]]


def test_creator_rules(spark):
    model = {"name": "m", "version": "1", "input_sha256": SHA}
    proof = {"kind": "k", "locator": "l", "inference": True}
    got = codes(
        spark, "creators", record(), record(identifiers=[ID, {**ID, "scheme": "ORCID"}]), record(identifiers=[{**ID, "scheme": "Handle"}]), record(evidence=[{**proof, "model": model}]), record(evidence=[{**proof, "inference": False, "model": model}]), record(evidence=[{**proof, "model": {**model, "input_sha256": "z"}}]),
        record(contributions=[{"role": "r", "evidence": "e", "agent": {"source_native_id": "a", "label": "A"}}, {"role": "r", "evidence": "e", "agent": {"kind": "robot", "source_native_id": "a", "label": "A"}}]), record(subject__attributes={"person_id": 1}), record(subject__label=""), record(relationships=[{"predicate": "p"}]), "{}",
    )
    assert got[:10] == [[], ["identifier.duplicate"], ["identifier.alias_global"], [], ["evidence.model_not_inference"], ["model.receipt"], ["agent.kind"], ["identity.canonical_id_forbidden"], [], ["required.field"]]
    assert "envelope.version" in got[10] and "required.field" in got[10]
    assert lanes.lane_issues(spark.createDataFrame([], "raw string"), "raw", "creators").count() == 0
    with pytest.raises(ValueError):
        codes(spark, "books", record())


def test_attributes_and_gate(spark):
    kept = spark.range(1).select(lanes.kept_attributes(F.expr("map('a', '1', 'b', '2')"), ["a", "c"]).alias("k"), lanes.kept_attributes(F.expr("map('a', '1')"), []).alias("n")).first()
    assert kept["k"] == {"a": "1"} and kept["n"] == {}
    fixture = spark.createDataFrame([([],)], "issues array<string>")
    ok = spark.createDataFrame([("available",)], "status string")
    risks = lambda *s: spark.createDataFrame([(x,) for x in s], "severity string")
    assert lanes.release_gate(True, fixture, risks("P1", "P2"), ok).first()["valid"]
    assert not lanes.release_gate(True, fixture, risks("P0"), ok).first()["valid"] and not lanes.release_gate(False, fixture, risks(), ok).first()["valid"]
    bad = lanes.release_gate(True, fixture, risks(), spark.createDataFrame([("absent",), (None,)], "status string")).first()
    assert bad["runtime_failure_count"] == 2 and not bad["valid"]
    assert {tuple(r) for r in lanes.severity_counts(risks("P1", "P1", "P0")).collect()} == {("P1", 2), ("P0", 1)}


def test_texts(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    for raw, want in (("12", 12), (" -1_000\n", -1000), ("1__0", None), ("1.0", None), ("", 7), (None, 7), ("9" * 30, None), ("x", None)):
        assert one(text.strict_int(F.lit(raw).cast("string"), 7)) == want, raw
    for pattern, path, want in (("a/**", "a", True), ("a/**", "./a//b.py", True), ("a/**", "ab", False), ("*.py", "a/b.py", True), ("a.b", "aXb", False), ("a[!b]?", "acd", True), ("a[!b]?", "abd", False), ("A*", "a", False), ("a\\\\b", "a/b", True)):
        assert one(text.path_matches(F.lit(pattern.replace("\\\\", "\\")), F.lit(path))) is want, (pattern, path)
    assert one(text.html_escaped(F.lit("<a href=\"x\">&'"))) == "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;" and one(text.html_escaped(F.lit(None))) == ""


def test_records(spark, tmp_path):
    lines = [json.dumps(record()), "", "[1]", "  ", json.dumps(record(raw_pointer=""))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.ndjson").write_text("\r\n".join(lines) + "\n")
    (tmp_path / "in" / "b.ndjson").write_text("\n{}")
    path = str(tmp_path / "in")
    got = sorted((r["path"][-8:], r["line_number"], sorted({i["code"] for i in r["issues"]})) for r in records.read_checked(spark, path, "software").collect())
    assert [x[:2] for x in got] == [("a.ndjson", 1), ("a.ndjson", 3), ("a.ndjson", 5), ("b.ndjson", 2)] and [x[2] for x in got[:3]] == [[], ["record.object"], ["required.text"]]
    shared = {(r["path"][-8:], r["line_number"]): r["issues"] for r in records.read_checked(spark, path).collect()}
    assert shared["a.ndjson", 1] == [] and [i["code"] for i in shared["a.ndjson", 3]] == ["record.object"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        (tmp_path / "long.txt").write_text("".join(f"line {i}\n" if i % 3 else "\n" for i in range(1, 400)))
        numbered = records.numbered_lines(spark, str(tmp_path / "long.txt"))
        assert spark.read.text(str(tmp_path / "long.txt")).rdd.getNumPartitions() > 1
        assert sorted((r["line_number"], r["line"]) for r in numbered.collect()) == [(i, f"line {i}") for i in range(1, 400) if i % 3]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    good = spark.createDataFrame([(json.dumps(record()),)], "raw string")
    records.write_checked(good, "raw", str(tmp_path / "out"), "creators")
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == record()
    with pytest.raises(ValueError, match="invalid record"):
        records.write_checked(good.withColumn("raw", F.lit("{}")), "raw", str(tmp_path / "no"), "creators")
    assert not (tmp_path / "no").exists()
    (tmp_path / "doc.json").write_text('{\n"a": 1}')
    assert records.read_document(spark, str(tmp_path / "doc.json"), "a int").first()["a"] == 1
    assert [tuple(r) for r in records.receipts(spark, str(tmp_path / "doc.json")).collect()] == [("doc.json", hashlib.sha256(b'{\n"a": 1}').hexdigest())]
    tables = {"observations": good.select(F.col("raw").alias("record_json")), "other": good}
    assert records.json_seam(tables) == ("observations", "record_json") and records.seam_records(tables).first()["issues"] == [] and records.json_seam({"other": good}) is None


def test_claims(spark):
    found = spark.createDataFrame([("a", "b", "shared_external_id", 0.995, True, ["viaf=1"], []), ("a", "b", "exact_name", 0.52, False, ["name=x"], []), ("c", "d", "shared_external_id", 0.995, True, ["viaf=2", "orcid=3"], []), ("e", "f", "shared_external_id", 0.49, False, ["viaf=2"], ["kind"])], "entity_a string, entity_b string, method string, confidence double, auto_eligible boolean, evidence array<string>, conflicts array<string>")
    claims = spark.createDataFrame([("1", "a", "b", "shared_external_id", 0.1, "{}", "rejected", None, "t"), ("2", "a", "b", "shared_external_id", 0.2, "{}", "proposed", None, "t"), ("3", "x", "y", "m", 0.3, "{}", "accepted", "me", "t")], "claim_id string, person_a string, person_b string, method string, confidence double, evidence string, status string, decided_by string, created_at string")
    out = {(r["person_a"], r["person_b"], r["method"], r["claim_id"] if len(r["claim_id"]) == 1 else "new"): r for r in identity.claims_written(claims, found, "now", True).collect()}
    assert len(out) == 6
    first = out["a", "b", "shared_external_id", "1"]
    assert (first["status"], first["action"], first["decided_by"], first["confidence"], json.loads(first["evidence"])["scheme"]) == ("accepted", "accepted", "identity:auto", 0.995, "viaf")
    assert out["a", "b", "shared_external_id", "2"]["action"] == "kept" and out["x", "y", "m", "3"]["action"] == "kept" and out["a", "b", "exact_name", "new"]["status"] == "proposed"
    assert json.loads(out["c", "d", "shared_external_id", "new"]["evidence"])["scheme"] is None and out["e", "f", "shared_external_id", "new"]["status"] == "proposed"
    again = identity.claims_written(identity.claims_written(claims, found, "now", True).drop("action"), found, "later", True)
    assert {r["action"] for r in again.collect()} == {"kept"}
    assert {r["status"] for r in identity.claims_written(claims.limit(0), found, "now").collect()} == {"proposed"}


def test_proposed_and_inspected(spark):
    people = spark.createDataFrame([(1, "Ada King", "human", "book", 1815, None), (2, "Ada King", "human", "github", 1815, None), (3, "Bo", "human", "book", None, None)], "entity_id long, label string, kind string, origin string, birth_year int, death_year int")
    ids = spark.createDataFrame([(1, "viaf", "9", None), (2, "viaf", "9", None)], "entity_id long, scheme string, value string, valid_to string")
    none = spark.createDataFrame([], "claim_id string, person_a long, person_b long, method string, confidence double, evidence string, status string, decided_by string, created_at string")
    claims, counts = identity.proposed(people, ids, none, "now", True)
    assert [(r["person_a"], r["person_b"], r["status"]) for r in claims.collect()] == [(1, 2, "accepted")] and counts.first()["auto_eligible"] == 1
    members = spark.createDataFrame([(1, "k", 1), (2, "k", 1), (3, "l", 3)], "entity_id long, cluster_id string, canonical_id long")
    got = {r["entity_id"]: r for r in identity.inspected(people.select("entity_id"), people, members, ids, identity.candidates(people, ids)).collect()}
    assert got[2]["redirected"] and got[2]["members"] == [1, 2] and got[2]["identifiers"][0]["value"] == "9" and len(got[1]["candidates"]) == 1 and got[3]["candidates"] is None
    unknown = identity.resolved(members, spark.createDataFrame([(7,)], "entity_id long")).first()
    assert unknown["cluster_id"] is None and unknown["members"] is None


def test_import_people(spark):
    person = spark.createDataFrame([(p, p.upper(), None, None, None, None, None) for p in "abcde"], "person_id string, name string, kind string, origin string, birth_year int, death_year int, state string")
    old = spark.createDataFrame([("a", "github_id", "1"), ("b", "github_id", "2"), ("a", "github_login", "@Ada"), ("b", "company", "X"), ("c", "odd", "v"), ("c", "viaf", " ")], "person_id string, platform string, value string").withColumns({"confidence": F.lit(0.5), "source": F.lit(None).cast("string")})
    shared = "shared_external_id"
    claims = spark.createDataFrame(
        [("1", "b", "a", shared, '{"positive": [{"scheme": "ORCID"}]}', "accepted", None), ("2", "c", "d", shared, "company=x", "accepted", "me"), ("3", "c", "e", "exact_name", "", "accepted", "me"), ("4", "d", "e", "exact_name", None, "accepted", None), ("5", "a", "d", "exact_name", None, "rejected", None), ("6", "a", "a", "exact_name", None, "accepted", "me"), ("7", "b", "c", "exact_name", None, "odd", None)],
        "claim_id string, person_a string, person_b string, method string, evidence string, status string, decided_by string",
    ).withColumn("confidence", F.lit(0.9))
    out = imports.import_people(person, old, claims, "now")
    got = {r["claim_id"]: (r["entity_a"], r["entity_b"], r["review_state"], r["quarantined"]) for r in out.candidates.collect()}
    assert got == {"1": ("a", "b", "proposed", "legacy_transitive_identifier_conflict"), "2": ("c", "d", "proposed", "legacy_noneligible_external_id"), "3": ("c", "e", "accepted", None), "4": ("d", "e", "proposed", "no_reviewer"), "5": ("a", "d", "rejected", None), "7": ("b", "c", "proposed", None)}
    assert sorted((r["entity_a"], r["outcome"], r["decided_by"]) for r in out.decisions.collect()) == [("a", "rejected", "legacy-review"), ("c", "accepted", "me")]
    assert sorted((r["entity_id"], r["value"]) for r in out.store.identifiers.collect()) == [("a", "1"), ("b", "2")]
    assert [(r["alias"], r["stable_identifier_value"]) for r in out.store.aliases.collect()] == [("ada", "1")]
    assert sorted((r["entity_id"], r["attribute"]) for r in out.store.attributes.collect()) == [("b", "company"), ("c", "legacy_external_id:odd")]
    empty = imports.import_people(person.limit(0), old.limit(0), claims.limit(0), "now")
    assert empty.candidates.count() == 0 and empty.decisions.count() == 0 and empty.store.entities.count() == 0


def test_who_in_full(spark):
    person = spark.createDataFrame([("a", "Ada L", "human", "merged", "b", "book"), ("b", "Ada K", "human", "linked", None, "github"), ("c", "Ada X", "human", "merged", "b", "book"), ("d", "Ada Y", "human", "linked", None, "book")], "person_id string, name string, kind string, state string, merged_into string, origin string").withColumns({"birth_year": F.lit(1815), "death_year": F.lit(None).cast("int")})
    claims = spark.createDataFrame([("a", "c", "m", "accepted"), ("b", "c", "m", "rejected"), ("b", "d", "m", "proposed")], "person_a string, person_b string, method string, status string")
    values = spark.createDataFrame([("b", "orcid", "1", 1.0, "s"), ("a", "bio", "t", None, None)], "person_id string, platform string, value string, confidence double, source string")
    topics = spark.createDataFrame([("a", f"t{i}", "s", float(i)) for i in range(12)], "person_id string, topic string, scheme string, weight double")
    content = spark.createDataFrame([("a", "book", "1", "r"), ("b", "github", "2", "r")], "person_id string, domain string, content_ref string, role string")
    out = Engine(Catalog(spark, {("people", "person"): person, ("people", "identity_claim"): claims, ("people", "external_ids"): values, ("people", "person_topic"): topics, ("people", "person_content"): content})).who("ada").as_dict()
    rows = {r["cluster_id"]: r for r in out["result"]}
    assert set(rows) == {"a", "d"}
    top = rows["a"]
    assert top["representative"] == "b" and top["name"] == "Ada K" and not top["contested"] and top["cluster_size"] == 3 and top["by_domain"] == {"book": 1, "github": 1}
    assert [i["platform"] for i in top["identifiers"]] == ["bio", "orcid"] and [t["topic"] for t in top["topics"]] == ["t11", "t10", "t9", "t8", "t7", "t6"]
    pairs = lambda k: [(x["person_a"], x["person_b"], x["status"]) for x in top[k]]
    assert pairs("decisions") == [("a", "b", "legacy_merge"), ("a", "c", "accepted_identity_decision")] and pairs("refused_merges") == [("b", "c", "rejected")] and pairs("unresolved") == [("b", "d", "proposed")]
    assert len(rows["d"]["unresolved"]) == 1 and sum(g.startswith(("a merge", "proposed")) for g in out["coverage_gaps"]) == 3
