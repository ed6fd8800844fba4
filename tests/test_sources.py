"""Sources, merges, adapters, the catalogue, the engine and the streams."""

import json
import sqlite3
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from evgraph.catalog import Catalog, Config, optional
from evgraph.engine import Engine, clamped
from evgraph.operators import contracts
from evgraph.sources import adapters, records
from evgraph.streaming import observations as streams

SOURCE = {"source_id": "src", "snapshot_id": "s1", "observed_at": "2024-01-01T00:00:00Z", "retrieved_at": "2024-02-01T00:00:00Z", "terms_revision": "t1", "rights_state": "open_data"}


def test_ndjson(spark, tmp_path):
    path = tmp_path / "in.ndjson"
    path.write_text('{"a": 1, "b": "x"}\n\n[1]\nnope\n{"b": "é"}\n')
    got = [(r["a"], r["b"], r["problem"]) for r in records.read_ndjson(spark, str(path), "a int, b string").collect()]
    assert got == [(1, "x", None), (None, None, "line.not_an_object"), (None, None, "line.not_an_object"), (None, "é", None)]
    assert [r["line_number"] for r in records.numbered_lines(spark, str(path)).orderBy("line_number").collect()] == [1, 3, 4, 5]
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "z int, y string")
    records.write_ndjson(rows, str(tmp_path / "out"), ["z"])
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines) == ['{"y":"a","z":1}', '{"y":"b","z":2}']
    assert records.same_records(rows, records.read_ndjson(spark, str(tmp_path / "out"), "y string, z int").select("z", "y")).count() == 0
    assert records.same_records(rows, rows.limit(1)).count() == 1


def test_pointers(tmp_path):
    (tmp_path / "a").mkdir()
    assert records.resolve_within(str(tmp_path), "a/x.json") == (tmp_path / "a/x.json").resolve()
    for bad in ("http://x", "/etc/passwd", "../x", "a/../../x", "file:x"):
        with pytest.raises(ValueError):
            records.resolve_within(str(tmp_path), bad)


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "human"), (2, "b", "human")], "k int, v string, kind string")
    new = spark.createDataFrame([(2, "x", "unknown"), (2, "y", "unknown"), (3, None, "organisation")], old.schema)
    rows = lambda f: sorted(map(tuple, f.collect()))
    assert rows(records.keep_first(old, new, ["k"], F.col("v"))) == [(1, "a", "human"), (2, "b", "human"), (3, None, "organisation")]
    assert rows(records.keep_last(old, new, ["k"], F.desc("v"))) == [(1, "a", "human"), (2, "y", "unknown"), (3, None, "organisation")]
    assert rows(records.merge(old, new.filter("v IS NULL OR v = 'x'"), ["k"], kind=records.keep_known("kind"))) == [(1, "a", "human"), (2, "x", "human"), (3, None, "organisation")]
    seen = spark.createDataFrame([("u", "a", 1), ("u", "a", 2), ("u", "b", 3), ("u", "a", 5)], "account string, alias string, observed_at int")
    assert rows(records.alias_history(seen)) == [("u", "a", 1, 3), ("u", "a", 5, None), ("u", "b", 3, 5)]


def test_database_source(spark, tmp_path):
    path = str(tmp_path / "g.db")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE person (id INTEGER, name TEXT, score REAL)")
    con.executemany("INSERT INTO person VALUES (?,?,?)", [(i, f"n{i}", i / 2) for i in range(10)])
    con.commit()
    con.close()
    records.register(spark)
    df = spark.read.format("sqlite_ro").option("path", path).option("table", "person").option("partitions", "3").load()
    assert sorted(map(tuple, df.collect())) == [(i, f"n{i}", i / 2) for i in range(10)]


def test_xml(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A</title><guid>1</guid></item><item><title>B</title><guid>2</guid></item></channel></rss>")
    assert sorted(map(tuple, records.read_xml(spark, str(tmp_path / "f.xml"), "item", "title string, guid string").collect())) == [("A", "1"), ("B", "2")]


def checked(frame):
    """Envelopes of an adapter keep the contract, but for the shape of relationships."""
    rel = F.transform("relationships", lambda r: F.struct(r["predicate"].alias("type"), F.lit("observed").alias("review_state"), F.lit(None).cast("string").alias("method"), F.lit(None).cast("array<string>").alias("basis"), r["evidence"].alias("evidence")))
    return [[i["code"] for i in r["issues"]] for r in contracts.envelope_issues(frame.withColumn("relationships", rel)).collect()]


def test_adapters_keep_the_contract(spark):
    accounts = spark.createDataFrame([(1, "N", "ann", [("old", "2020", "2021")], "User", "Ann", None, None, None), (2, None, "org", None, "Organization", None, None, None, None)], "id long, node_id string, login string, previous_logins array<struct<login:string,valid_from:string,valid_to:string>>, type string, name string, company string, location string, bio string")
    a = adapters.code_accounts(accounts, SOURCE)
    rows = {r["subject"]["label"]: r for r in a.collect()}
    assert rows["ann"]["relationships"][0]["predicate"] == "renamed_from" and len(rows["ann"]["identifiers"]) == 3 and len(rows["org"]["identifiers"]) == 2 and rows["org"]["subject"]["kind"] == "organisation"
    packages = spark.createDataFrame([("left pad", "MIT", ["ann"], [("1.0", "2024-01-01T00:00:00Z"), ("1.1", None)])], "name string, license string, owners array<string>, versions array<struct<version:string,published_at:string>>")
    p = adapters.packages(packages, SOURCE, "npm")
    assert sorted(r["identifiers"][0]["value"] for r in p.collect()) == ["pkg:npm/left%20pad", "pkg:npm/left%20pad@1.0", "pkg:npm/left%20pad@1.1"]
    works = spark.createDataFrame([("https://doi.org/10.1/X", "T", [("Ada", "L", "https://orcid.org/0-1")], [(None, "Ed", None)])], "doi string, title string, author array<struct<given:string,family:string,orcid:string>>, editor array<struct<given:string,family:string,orcid:string>>").withColumn("translator", F.lit(None).cast("array<struct<given:string,family:string,orcid:string>>"))
    w = adapters.scholarly_works(works, SOURCE)
    assert [(c["role"], c["agent"]["source_native_id"], c["agent"]["label"]) for c in w.first()["contributions"]] == [("author", "orcid:0-1", "Ada L"), ("editor", "name:Ed", "Ed")]
    assert [[(i["scheme"], i["value"]) for i in c["agent"]["identifiers"]] for c in w.first()["contributions"]] == [[("orcid", "0-1")], []]
    notes = adapters.paired_authors(spark.createDataFrame([("n1", "T", ["A", "B"], ["~A1"])], "id string, title string, authors array<string>, authorids array<string>"), SOURCE)
    assert [c["agent"]["source_native_id"] for c in notes.first()["contributions"]] == ["~A1", "name:B"]
    person = "array<struct<name:string,role:string>>"
    shows = spark.createDataFrame([("g", "S", [("H", None)], [("i1", "One", [("G", "Guest")]), ("i2", " ", None)])], f"guid string, title string, people {person}, items array<struct<guid:string,title:string,people:{person}>>")
    f = adapters.feed_episodes(shows, SOURCE)
    assert {r["subject"]["label"]: [(c["role"], c["agent"]["label"]) for c in r["contributions"]] for r in f.collect()} == {"One": [("guest", "G")], "i2": [("host", "H")]}
    talks = spark.createDataFrame([("C", [("2024-01-01", {"R1": [("t1", "Talk", [("P", "c1"), ("Q", None)])]})])], "conference string, days array<struct<date:string,rooms:map<string,array<struct<guid:string,title:string,persons:array<struct<name:string,code:string>>>>>>>")
    t = adapters.schedule_talks(talks, SOURCE)
    assert [c["agent"]["source_native_id"] for c in t.first()["contributions"]] == ["c1", "name:Q"]
    objects = adapters.archived_objects(spark.createDataFrame([("swh:1", "dir", None, "http://o", "swh:0")], "swhid string, object_type string, visit_date string, origin string, parent_swhid string"), SOURCE)
    assert [r["predicate"] for r in objects.first()["relationships"]] == ["archives", "contained_in"]
    for frame in (a, p, w, notes, f, t, objects):
        assert all(codes == [] for codes in checked(frame))


def test_payload_digests(spark, tmp_path):
    (tmp_path / "p.json").write_bytes(b"{}")
    import hashlib

    rows = spark.createDataFrame([("p.json", (hashlib.sha256(b"{}").hexdigest(),)), ("p.json", ("0" * 64,)), ("q.json", ("0" * 64,))], "raw_pointer string, source struct<payload_sha256:string>")
    payloads = spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    assert sorted(r["code"] for r in contracts.payload_mismatches(rows, payloads).collect()) == ["payload.digest", "payload.missing"]


def graph(spark, claims=True):
    person = spark.createDataFrame(
        [("a", "Ada Lovelace", "human", "linked", None, 1815, 1852, "book"), ("b", "Ada King", "human", "merged", "a", None, None, "book"), ("c", "Charles Babbage", "human", "linked", None, 1791, 1871, "book"), ("d", "Zed Zero", "human", "tracked", None, None, None, "github")],
        "person_id string, name string, kind string, state string, merged_into string, birth_year int, death_year int, origin string",
    )
    content = spark.createDataFrame([("a", "book", "1", "author"), ("b", "book", "2", "author"), ("c", "book", "2", "editor"), ("c", "github", "x/y", "owner")], "person_id string, domain string, content_ref string, role string")
    topics = spark.createDataFrame([("a", "maths", "lcsh", 3.0), ("c", "Maths", "other", 1.0)], "person_id string, topic string, scheme string, weight double")
    tables = {("people", "person"): person, ("people", "person_content"): content, ("people", "person_topic"): topics}
    if claims:
        tables["people", "identity_claim"] = spark.createDataFrame([("a", "b", "exact_name", "accepted"), ("c", "d", "exact_name", "proposed")], "person_a string, person_b string, method string, status string")
    return Catalog(spark, tables)


def test_engine(spark):
    e = Engine(graph(spark))
    who = e.who("ada").as_dict()
    assert who["result"][0]["cluster_size"] == 2 and who["result"][0]["content_count"] == 2 and who["result"][0]["lived"] == "1815-1852" and who["page"]["total_matched"] == 1 and not who["page"]["truncated"]
    assert "absent: people.external_ids" in who["coverage_gaps"] and who["execution"]["search_path"] == "phrase"
    assert [r["content_ref"] for r in e.works("Lovelace").as_dict()["result"]] == ["1", "2"]
    assert [(r["person_id"], r["shared"]) for r in e.relationships("Lovelace").as_dict()["result"]] == [("c", 1)]
    assert e.path("Lovelace", "Babbage").as_dict()["result"][0]["hops"] == 1
    assert [r["contemporary_id"] for r in e.contemporaries("Lovelace").as_dict()["result"]] == ["c"]
    assert [r["scheme"] for r in e.about("MATHS").as_dict()["result"]] == ["lcsh", "other"]
    assert [r["person_b"] for r in e.claims("proposed").as_dict()["result"]] == ["d"]
    assert {r["table"]: r["rows"] for r in e.inventory().as_dict()["result"]}["person"] == 4 and e.source().as_dict()["result"] == []
    part = e.who("e", limit=1).as_dict()
    assert part["page"]["truncated"] and part["page"]["returned"] == 1 and part["execution"]["search_path"] == "scan"
    assert e.who("%").as_dict()["result"] == [] and e.works("nobody").as_dict()["result"] == []
    json.dumps(who)


def test_engine_without_tables(spark):
    out = Engine(Catalog(spark)).who("x").as_dict()
    assert out["warnings"] and out["result"] == []
    alone = Engine(graph(spark, claims=False))
    assert alone.catalog.identity_mode() == "none" and alone.who("ada").as_dict()["page"]["total_matched"] == 2
    assert (clamped(0, 1, 500), clamped(900, 1, 500), clamped(7, 1, 500)) == (1, 500, 7)


def test_config_and_catalogue(spark, tmp_path):
    (tmp_path / "people").mkdir()
    spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / "people/person.parquet"))
    (tmp_path / "c.json").write_text('{"books": "/b", "github": "/file"}')
    got = Config.load({"github": "/explicit"}, str(tmp_path / "c.json"), {"EVGRAPH_AWESOME": "/env"}, str(tmp_path))
    assert got.origins == {"people": "default", "books": "file", "github": "explicit", "awesome": "environment"}
    found = Catalog.open(spark, got)
    assert found.has("people", "person") and any("books" in n for n in found.notes)
    row = found.get("people", "person").select(optional(found.get("people", "person"), "nope"), optional(found.get("people", "person"), "x", "int")).first()
    assert tuple(row) == (None, 1)


def drained(frame, mode, name):
    q = frame.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        q.processAllAvailable()
        return frame.sparkSession.table(name).collect()
    finally:
        q.stop()


def test_streams(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    rows = [("u", "a", at(1), "h1", 1.0), ("u", "a", at(2), "h1", 2.0), ("u", "b", at(3), "h2", 3.0), ("v", "c", at(4), "h3", 4.0), ("u", "c", at(5), "h4", 5.0)]
    spark.createDataFrame(rows, "account string, alias string, observed_at timestamp, payload_sha256 string, value double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("account string, alias string, observed_at timestamp, payload_sha256 string, value double").parquet(str(tmp_path / "in"))
    assert len(drained(streams.deduplicated(stream(), "observed_at"), "append", "dedup")) == 4
    status = streams.latest_status(stream(), "account", "observed_at", "alias")
    assert {r["account"]: r["alias"] for r in drained(status, "complete", "latest")} == {"u": "c", "v": "c"}
    assert sum(r["n"] for r in drained(streams.counts(stream(), "observed_at", "account"), "complete", "counts")) == 5
    streams.append_sink(stream(), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_merge_of_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, s string, n int")
    incoming = spark.createDataFrame([(1, "x", None, 1), (1, None, 7, 2), (1, "y", None, 3), (3, None, None, 1), (3, "z", 1, 2)], "k int, s string, n int, at int")
    assert sorted(map(tuple, records.merge(target, incoming, ["k"], F.col("at")).collect())) == [(1, "y", 7), (2, "b", 5), (3, "z", 1)]
    assert sorted(map(tuple, records.merge(target, incoming.drop("at"), ["k"], n=F.greatest("old_n", "new_n")).collect())) == [(1, "y", 7), (2, "b", 5), (3, "z", 1)]
