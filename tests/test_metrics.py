"""Metrics over envelopes, and adapters of packages, a scholarly catalogue and podcasts."""

from pyspark.sql import functions as F

from evgraph.operators import graph, metrics, rollups
from evgraph.sources import adapters, imports
from tests.test_sources import SOURCE

VERSIONS = "versions array<struct<version:string,published_at:string>>"


def by_label(frame):
    return {r["subject"]["label"]: r for r in frame.collect()}


def packages(spark):
    owner = [("1", "ann", None, "organisation", None), (None, "bob", None, None, "author")]
    pypi = spark.createDataFrame([("My_Lib", "s", "MIT", None, None, owner, [("r1", "o/r")], [("1.0", "2024-01-01T00:00:00Z")]), ("bare", None, None, None, True, None, None, None)], f"name string, summary string, license string, requires_python string, abandoned boolean, owners {adapters.OWNERS}, source_repositories {adapters.PLACES}, {VERSIONS}")
    eco = spark.createDataFrame([("7", "pypi", "my-lib", "BSD", None, None, owner[:1], [("pkg:pypi/dep", None)], None), ("8", "crates", "c", None, "1", None, None, None, ("r2", "o/c"))], f"id string, ecosystem string, name string, license string, latest_release string, abandoned boolean, maintainers {adapters.OWNERS}, dependencies array<struct<purl:string,name:string>>, repository struct<native_id:string,label:string>")
    return adapters.pypi_packages(pypi, SOURCE), adapters.ecosystem_packages(eco, {**SOURCE, "source_id": "ecosystems"})


def test_packages(spark):
    pypi, eco = packages(spark)
    got = by_label(pypi)
    lib = got["My_Lib"]
    assert lib["subject"]["source_native_id"] == "pkg:pypi/my-lib" and [i["value"] for i in lib["identifiers"]] == ["pkg:pypi/my-lib", "my-lib"]
    assert [(c["role"], c["order"], c["agent"]["kind"], c["agent"]["source_native_id"]) for c in lib["contributions"]] == [("maintainer", 1, "organisation", "pypi_user:1"), ("author", 2, "account", "pypi_user:bob")]
    assert [r["predicate"] for r in lib["relationships"]] == ["source_repository"] and got["My_Lib@1.0"]["relationships"][0]["object"]["source_native_id"] == "pkg:pypi/my-lib" and got["bare"]["contributions"] == [] and len(got) == 3
    other = by_label(eco)
    assert [r["predicate"] for r in other["my-lib"]["relationships"]] == ["depends_on"] and other["c"]["subject"]["source_native_id"] == "pkg:cargo/c" and other["my-lib"]["contributions"][0]["agent"]["source_native_id"] == "pypi_maintainer:1"
    crate = adapters.crates(spark.createDataFrame([("c", None, "MIT", None, None, ("r", "o/c"), [("1", None), ("2", None)])], f"name string, description string, license string, abandoned boolean, owners {adapters.OWNERS}, repository struct<native_id:string,label:string>, {VERSIONS}"), SOURCE)
    assert sorted(by_label(crate)) == ["c", "c@1", "c@2"]


def test_catalogue_and_podcasts(spark):
    works = adapters.catalogue_works(
        spark.createDataFrame([("W1", " ", "T", None, None, None, "https://doi.org/10.1/AB", [(("A1", "Ada", None),), ((None, None, None),)]), ("W2", None, None, "book", None, None, None, None)], "id string, display_name string, title string, type string, publication_date string, updated_date string, doi string, authorships array<struct<author:struct<id:string,display_name:string,orcid:string>>>"), SOURCE
    )
    got = by_label(works)
    assert [i["value"] for i in got["T"]["identifiers"]] == ["W1", "10.1/ab"] and [(c["agent"]["source_native_id"], c["agent"]["label"]) for c in got["T"]["contributions"]] == [("A1", "Ada"), ("W1#author-1", "W1#author-1")] and '"book"' in got["W2"]["subject"]["attributes"]
    episodes = adapters.podcast_episodes(
        spark.createDataFrame([("E1", "g", None, "T", "F1", None, "http://t", [("p", "Ada", None, None), (None, "Bo", "http://b", "HOST"), (None, " ", None, None), (None, "Cy", " ", "")]), ("", "g2", None, None, None, None, None, None)], "id string, guid string, enclosure_url string, title string, feed_id string, feed_title string, transcript_url string, persons array<struct<id:string,name:string,href:string,role:string>>"), SOURCE
    )
    got = by_label(episodes)
    assert [(c["role"], c["order"], c["agent"]["source_native_id"]) for c in got["T"]["contributions"]] == [("guest", 1, "p"), ("host", 2, "http://b"), ("guest", 4, "label:Cy")]
    assert [r["predicate"] for r in got["T"]["relationships"]] == ["part_of", "has_transcript_pointer"] and [i["scheme"] for i in got["T"]["identifiers"]] == ["podcast_index_episode_id", "rss_item_guid"] and len(got["g2"]["identifiers"]) == 1
    feeds = adapters.podcast_feeds(spark.createDataFrame([(None, None, "http://f", "", "O")], "id string, podcast_guid string, url string, title string, original_title string"), SOURCE)
    assert by_label(feeds)["O"]["subject"]["source_native_id"] == "http://f" and adapters.all_records(works, episodes, feeds).count() == 5


def test_metrics(spark):
    found = adapters.all_records(*packages(spark))
    rows = {(r["metric"], r["key"]): r["n"] for r in metrics.counters(found).collect()}
    assert rows["records_by_source", "ecosystems"] == 2 and rows["works_by_type", "software_package"] == 4 and rows["contribution_roles", "maintainer"] == 2 and rows["relationship_types", "version_of"] == 1 and rows["identifier_schemes", "purl"] == 5
    one = metrics.software_summary(found).first()
    assert (one["records"], one["sources"], one["works"], one["licensed_works"], one["license_percent"], one["abandoned_works"], one["source_conflicts"], one["cross_platform_receipts"]) == (5, 2, 5, 2, 40.0, 1, 1, 0)
    assert one["stable_unique_identifiers"] == 8 and metrics.license_conflicts(found).first()["values"] == ["BSD", "MIT"]
    none = metrics.software_summary(found.limit(0)).first()
    assert (none["records"], none["identifier_observations"], none["license_percent"]) == (0, 0, 0.0)
    link = lambda frame, v: frame.withColumn("identifiers", F.array(adapters.identifier("orcid", F.lit(v), scope="global")).cast(adapters.IDENTIFIER))
    pypi, eco = packages(spark)
    made = metrics.creator_summary(link(pypi, "X").unionByName(link(eco, "x"))).first()
    assert (made["records"], made["unique_source_subjects"], made["unique_observed_entities"], made["candidates"], made["strong"], made["subjects_with_bridge"], made["mean_sources"]) == (5, 5, 8, 1, 1, 5, 2.0) and made["bridge_rate"] == 5 / 8
    assert metrics.creator_summary(pypi.limit(0)).first()["bridge_rate"] is None


def test_build_graph(spark):
    make = spark.createDataFrame
    known = make([("k1", "Plato", "registry", 1.0), ("k2", " plato ", "registry", 1.0), ("k3", "Zed", "github", None)], "person_id string, name string, origin string, rank_score double")
    moved = make([("k1", "book", "1", None, "old"), ("k1", "github", "a/b", 2.0, "t")], "person_id string, domain string, content_ref string, score double, title string")
    people = make([("p", "PLATO", -428, -348, 3, False), ("u", "United States", None, None, 9, True), ("b", "Ada  X", None, None, 1, False), ("a", "ada x", 1815, None, 2, None)], "person_key string, display_name string, birth_year int, death_year int, work_count int, is_corporate boolean")
    works = make([("p", 1, "author"), ("p", 1, "author"), ("p", 1, "editor"), ("u", 2, "author"), ("b", 3, "author"), ("x", 4, "author")], "person_key string, gid long, role string")
    out = rollups.build_graph(known, moved, make([("k3", "orcid", "1"), ("k3", "orcid", "1")], "person_id string, platform string, value string"), people, works, make([(1, "Republic")], "gid long, title string"), make([(1, "Politics")], "gid long, subject string"), "now")
    assert sorted((r["person_id"], r["birth_year"], r["state"], r["name"]) for r in out.person.collect()) == [("bk:a", 1815, "linked", "ada x"), ("k1", -428, "linked", "Plato"), ("k2", None, "tracked", " plato "), ("k3", None, "tracked", "Zed")]
    assert sorted((r["person_id"], r["content_ref"], r["role"], r["source"], r["title"]) for r in out.content.collect()) == [("bk:a", "3", "author", "gutenberg", None), ("k1", "1", "author", "gutenberg", "Republic"), ("k1", "1", "editor", "gutenberg", "Republic"), ("k1", "a/b", "author", "v1_migration", "t")]
    assert [(r["topic"], r["weight"]) for r in out.topics.collect()] == [("Politics", 2.0)]
    assert {r["what"]: r["n"] for r in out.summary().collect()} == {"person": 4, "with_life_dates": 2, "person_content": 4, "person_topic": 1, "external_ids": 1, "multi_domain": 1, "state:linked": 2, "state:tracked": 2}


def test_relationships_and_policies(spark):
    rows = spark.createDataFrame([(1, 1, "accepted", "2020", None), (1, 1, "accepted", "2022", None), (1, 1, "proposed", None, None), (2, 1, "accepted", None, "2021"), (2, 9, "accepted", None, None)], "subject_entity_id int, relationship_type_id int, review_state string, valid_from string, valid_to string")
    types = spark.createDataFrame([(1, "n", "knows")], "relationship_type_id int, namespace string, local_name string")
    at = lambda t, s=None: sorted(r["subject_entity_id"] for r in graph.relationships_at(rows, types, F.lit(t), s).collect())
    assert at("2020") == [1, 2] and at("2021") == [1] and at("2023") == [1, 1] and at("2020", rows.filter("subject_entity_id = 2")) == [2]
    text = {c: "x" for c in imports.POLICY_TEXTS} | {"rights_state_default": "open_data", "recommended_state": "pilot_now"}
    policies = [{**text, "official_docs": ["https://a"]}, {**text, "source_id": "y", "attribution": None, "official_docs": ["http://a"]}, {**text, "rights_state_default": "free", "recommended_state": "now", "official_docs": []}]
    schema = ", ".join(f"{c} string" for c in imports.POLICY_TEXTS) + ", official_docs array<string>"
    got = imports.policy_problems(spark.createDataFrame([tuple(p[c] for c in (*imports.POLICY_TEXTS, "official_docs")) for p in policies], schema), spark.createDataFrame([("x",)], "source_id string")).collect()
    assert sorted(r["problems"] for r in got) == [[], ["missing:attribution", "source.unknown", "official_docs"], ["rights_state", "recommended_state", "official_docs"]]


def test_rss(spark):
    xml = """<?xml version="1.0"?><rss version="2.0" xmlns:podcast="p" xmlns:atom="a" xmlns:itunes="i"><channel><title>Show</title><podcast:guid>G</podcast:guid><atom:link href=" "/><atom:link href="http://s"/>
 <itunes:author>Ann</itunes:author>
 <item><title>One</title><guid isPermaLink="false">g1</guid><link>http://l</link><podcast:person role="Guest" href="http://b">Bo</podcast:person><podcast:person>Cy</podcast:person><podcast:person> </podcast:person><podcast:transcript url="http://t" type="text/vtt"/><podcast:transcript url=""/><enclosure url="http://m" type="audio/mpeg" length="1"/></item>
 <item><enclosure url="http://m2"/></item><item><title> </title></item></channel></rss>"""
    feeds = spark.createDataFrame([("http://f", xml), ("http://bad", "<rss"), ("http://none", None)], "feed_url string, xml string")
    got = {r["subject"]["source_native_id"]: r for r in adapters.rss_feeds(feeds, SOURCE).collect()}
    assert sorted(got) == ["G", "G:item:2", "g1", "http://bad", "http://m2", "http://none"]
    assert [i["value"] for i in got["G"]["identifiers"]] == ["http://f", "G", "http://s"] and [(c["role"], c["agent"]["source_native_id"]) for c in got["G"]["contributions"]] == [("host", "label:Ann")] and got["G"]["subject"]["label"] == "Show"
    one = got["g1"]
    assert [(c["role"], c["order"], c["agent"]["source_native_id"]) for c in one["contributions"]] == [("guest", 1, "http://b"), ("host", 2, "label:Cy")]
    assert [(r["predicate"], r["object"]["source_native_id"]) for r in one["relationships"]] == [("part_of", "G"), ("has_transcript_pointer", "http://t"), ("has_media_pointer", "http://m")] and [i["scheme"] for i in one["identifiers"]] == ["rss_item_guid", "episode_url"]
    assert got["http://m2"]["contributions"] == got["G"]["contributions"] and got["G:item:2"]["subject"]["label"] == "G:item:2" and got["http://none"]["identifiers"][0]["value"] == "http://none"
