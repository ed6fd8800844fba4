"""More adapters, and imports into the identity store."""

from pyspark.sql import functions as F

from evgraph.sources import adapters, imports
from tests.test_sources import SOURCE, checked

PEOPLE = [("a", "Ada", "human", "linked"), ("b", "Bo", "human", "linked")]


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_repositories_and_releases(spark):
    repos = spark.createDataFrame(
        [(1, "N", "o/r", (9, "o", "Organization"), [(2, "c", None)], [(3, "old", "2020")], [("pkg:npm/x", None)], ["swh:1"], None, "MIT"), (2, None, "p/q", (8, "p", "User"), None, None, None, None, None, None)],
        "id long, node_id string, full_name string, owner struct<id:long,login:string,type:string>, contributors array<struct<id:long,login:string,role:string>>, transfers array<struct<from_owner_id:long,from_owner_login:string,at:string>>, dependencies array<struct<purl:string,name:string>>, swhids array<string>, description string, license string",
    )
    out = adapters.code_repositories(repos, SOURCE)
    got = {r["subject"]["label"]: r for r in out.collect()}
    assert [(c["role"], c["order"], c["agent"]["kind"]) for c in got["o/r"]["contributions"]] == [("repository_owner", 1, "organisation"), ("contributor", 1, "account")]
    assert [x["predicate"] for x in got["o/r"]["relationships"]] == ["transferred_from", "depends_on", "archived_as"] and len(got["p/q"]["contributions"]) == 1 and got["p/q"]["relationships"] == []
    rel = adapters.code_releases(spark.createDataFrame([(5, 1, "o/r", "v1", "2024-01-01T00:00:00Z", (2, "c")), (6, 1, "o/r", "v2", None, None)], "id long, repository_id long, repository string, tag string, published_at string, author struct<id:long,login:string>"), SOURCE)
    assert sorted((r["subject"]["label"], len(r["contributions"])) for r in rel.collect()) == [("o/r@v1", 1), ("o/r@v2", 0)]
    assert all(c == [] for c in checked(out) + checked(rel))


def test_media_and_library(spark):
    channels = adapters.video_channels(spark.createDataFrame([("C", " ", "@c", None, None), ("D", "Dee", None, None, None)], "id string, title string, custom_url string, published_at string, country string"), SOURCE)
    assert sorted((r["subject"]["label"], len(r["identifiers"])) for r in channels.collect()) == [("C", 2), ("Dee", 1)]
    clips = adapters.videos(spark.createDataFrame([("V", "T", "C", "", "2024", "PT1S"), ("W", "", None, None, None, None)], "id string, title string, channel_id string, channel_title string, published_at string, duration string"), SOURCE)
    assert sorted((r["subject"]["label"], len(r["contributions"]), len(r["relationships"])) for r in clips.collect()) == [("T", 1, 1), ("W", 0, 0)]
    people = adapters.authority_people(spark.createDataFrame([("A1", "Ada", "https://orcid.org/0-1"), ("A2", None, " ")], "id string, name string, orcid string"), SOURCE, "openalex_author_id")
    assert sorted((r["subject"]["label"], [i["value"] for i in r["identifiers"]]) for r in people.collect()) == [("A2", ["A2"]), ("Ada", ["A1", "0-1"])]
    works = adapters.library_works(spark.createDataFrame([("W1", "T", ["P1", "P2"], None), ("E1", " ", None, "W1")], "key string, title string, authors array<string>, edition_of string"), SOURCE, "open_library_key")
    assert sorted((r["subject"]["label"], [c["order"] for c in r["contributions"]], len(r["relationships"])) for r in works.collect()) == [("E1", [], 1), ("T", [0, 1], 0)]
    models = adapters.model_repositories(spark.createDataFrame([("model", "m", "o", ["c"], [("trained_on", "dataset:d")], [("abc", None)])], "repo_type string, id string, owner string, contributors array<string>, links array<struct<predicate:string,target:string>>, revisions array<struct<sha:string,at:string>>"), SOURCE)
    assert sorted((r["subject"]["label"], [c["role"] for c in r["contributions"]], [x["predicate"] for x in r["relationships"]]) for r in models.collect()) == [("m", ["repository_owner", "contributor"], ["trained_on"]), ("m@abc", [], ["version_of"])]
    for frame in (channels, clips, people, works, models):
        assert all(c in ([], ["identifier.handle_unique"]) for c in checked(frame))


def test_graph_rows(spark):
    person = spark.createDataFrame(PEOPLE, "person_id string, name string, kind string, state string")
    content = spark.createDataFrame([("a", "book", "1", "author"), ("b", "book", "1", "editor")], "person_id string, domain string, content_ref string, role string")
    w = adapters.work_rows(person, content, SOURCE).collect()
    assert len(w) == 1 and [(c["role"], c["agent"]["label"]) for c in w[0]["contributions"]] == [("author", "Ada"), ("editor", "Bo")]
    topics = spark.createDataFrame([("a", "x", "s1"), ("b", "x", "s2"), ("b", "x", "s1")], "person_id string, topic string, scheme string")
    assert sorted(r["subject"]["source_native_id"] for r in adapters.topic_rows(topics, SOURCE).collect()) == ["s1:x", "s2:x"]
    claims = spark.createDataFrame([("b", "a", "m", 0.9, "accepted", None), ("a", "c", "m", 0.5, "accepted", "me"), ("a", "d", "m", 0.5, "rejected", None)], "person_a string, person_b string, method string, confidence double, status string, decided_by string")
    assert rows(adapters.decision_stream(claims).select("a", "b", "state")) == [("a", "b", "proposed"), ("a", "c", "accepted"), ("a", "d", "rejected")]


def test_import_splits_by_the_registry(spark):
    people = adapters.authority_people(spark.createDataFrame([("A1", "Ada", "0000-0002-1825-0097"), ("A1", "Ada", "0000-0002-1825-0097")], "id string, name string, orcid string"), SOURCE, "openalex_author_id")
    extra = people.withColumn("identifiers", F.concat("identifiers", F.array(adapters.identifier("GitHub_Login", F.lit("@Ada")), adapters.identifier("made_up", F.lit("1")), adapters.identifier("viaf", F.lit(" "))).cast(adapters.IDENTIFIER)))
    store = imports.import_envelopes(extra)
    assert store.entities.count() == 1 and store.entities.first()["entity_id"].startswith("obs:src:person:")
    assert sorted((r["scheme"], r["value"], r["auto_eligible"], r["absent"]) for r in store.identifiers.collect()) == [("openalex_author_id", "a1", True, False), ("orcid", "0000-0002-1825-0097", True, False)]
    assert [(r["scheme"], r["alias"]) for r in store.aliases.collect()] == [("github_login", "ada")]
    assert {r["attribute"] for r in store.attributes.collect()} == {"observed_identifier:made_up", "name", "raw_pointer"}


def test_claims_and_profiles(spark):
    claims = spark.createDataFrame(
        [("a", "b", "m", "accepted", None, '{"scheme": "orcid", "value": "0000-1"}'), ("a", "c", "m", "accepted", None, "scheme=github_id; value=0"), ("a", "d", "m", "accepted", None, "scheme=name; value=x"), ("a", "e", "m", "accepted", "me", "scheme=name; value=x"), ("a", "f", "m", "rejected", None, None)],
        "person_a string, person_b string, method string, status string, decided_by string, evidence string",
    )
    got = {r["person_b"]: (r["status"], r["quarantined"]) for r in imports.import_claims(claims).collect()}
    assert got == {"b": ("accepted", None), "c": ("proposed", "value stands for absence"), "d": ("proposed", "scheme may not decide"), "e": ("accepted", None), "f": ("rejected", None)}
    profiles = spark.createDataFrame([("e", 1, None, "ada", "Ada", None, "", None, None, "adax", "User", 5, None)], "entity_id string, id long, node_id string, login string, name string, company string, location string, bio string, blog string, twitter_username string, type string, followers int, created_at string")
    found = {(r["kind"], r["scheme"]): r["status"] for r in imports.profile_rows(profiles).collect()}
    assert len(found) == 12 and found["identifier", "github_id"] == "present" and found["identifier", "github_node_id"] == found["attribute", "location"] == "absent"
    people = spark.createDataFrame([("gh:Ada", "x"), ("p", "Name"), ("q", "n")], "person_id string, name string")
    seen = spark.createDataFrame([("q", "github_login", "old", 1), ("q", "github_login", "new", 2)], "person_id string, platform string, value string, seq int")
    assert rows(imports.requested_login(people, seen)) == [("gh:Ada", "Ada"), ("p", "Name"), ("q", "new")]


def test_policies(spark):
    registry = imports.policies(spark, [("yt", "restricted", "r1", 30)])
    frame = spark.createDataFrame([("yt", "2024-01-01T00:00:00Z"), ("yt", "2024-03-01T00:00:00Z"), ("zz", "2020-01-01T00:00:00Z")], "source_id string, retrieved_at string")
    assert sorted((r["source_id"], r["rights_state"]) for r in imports.with_policy(frame, registry).collect()) == [("yt", "restricted"), ("yt", "restricted"), ("zz", "pending")]
    assert [r["retrieved_at"] for r in imports.stale(frame, registry, "2024-03-05T00:00:00Z").collect()] == ["2024-01-01T00:00:00Z"]
