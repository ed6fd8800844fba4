"""Source payloads to observation envelopes: each a projection of nested records, so all of it stays in the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import canonical_of
from ..functions.urls import package_url
from ..operators.contracts import VERSION

IDENTIFIER = "array<struct<scheme:string,value:string,scope:string,stability:string,uniqueness:string,evidence:string>>"
CONTRIBUTION = "array<struct<role:string,order:int,agent:struct<kind:string,source_native_id:string,label:string,identifiers:array<struct<scheme:string,value:string,scope:string,stability:string,uniqueness:string,evidence:string>>>,observed_at:string,evidence:string>>"
RELATION = "array<struct<predicate:string,object:struct<kind:string,source_native_id:string,label:string>,observed_at:string,evidence:string>>"
EVIDENCE = "array<struct<kind:string,locator:string,observed_at:string>>"


def identifier(scheme: str, value: Column, stability: str = "stable", uniqueness: str = "unique", scope: str = "source", evidence: str | Column = "source field") -> Column:
    proof = F.lit(evidence) if isinstance(evidence, str) else evidence
    return F.struct(F.lit(scheme).alias("scheme"), value.cast("string").alias("value"), F.lit(scope).alias("scope"), F.lit(stability).alias("stability"), F.lit(uniqueness).alias("uniqueness"), proof.alias("evidence"))


def agent(kind: str | Column, native: Column, label: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), native.cast("string").alias("source_native_id"), label.cast("string").alias("label"))


def contribution(role: str | Column, who: Column, at: Column, order: Column | None = None, evidence: str | Column = "source field", identifiers: Column | None = None) -> Column:
    """Who did what, by an agent and the identifiers that the record gives of it."""
    known = F.coalesce(F.array_compact(identifiers).cast(IDENTIFIER), F.array().cast(IDENTIFIER)) if identifiers is not None else F.array().cast(IDENTIFIER)
    proof = F.lit(evidence) if isinstance(evidence, str) else evidence
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), (order if order is not None else F.lit(None)).cast("int").alias("order"), who.withField("identifiers", known).alias("agent"), at.cast("string").alias("observed_at"), proof.alias("evidence"))


def relation(predicate: str, what: Column, at: Column, evidence: str = "source field") -> Column:
    return F.struct(F.lit(predicate).alias("predicate"), what.alias("object"), at.cast("string").alias("observed_at"), F.lit(evidence).alias("evidence"))


def envelope(
    records: DataFrame, source: dict[str, str], record: Column, kind: str | Column, native: Column, label: Column, attributes: Column, identifiers: Column | None = None, contributions: Column | None = None, relationships: Column | None = None,
    raw: Column | None = None, observed_at: Column | None = None, pointer: Column | None = None, payload: Column | None = None,
) -> DataFrame:
    """Envelopes of records. source: source_id, snapshot_id, observed_at, retrieved_at, terms_revision, rights_state. With `payload`, the
    digest of what each record is from, a snapshot is known by it; else the digest is of `raw`, or of the whole record."""
    at = observed_at if observed_at is not None else F.lit(source["observed_at"])
    of = payload if payload is not None else F.sha2(canonical_of(records, raw if raw is not None else F.struct(*records.columns)), 256)
    snapshot = F.concat(F.lit("sha256:"), payload) if payload is not None else F.lit(source["snapshot_id"])
    none = lambda kind_: F.array().cast(kind_)
    return records.select(
        F.lit(VERSION).alias("envelope_version"),
        F.struct(
            F.lit(source["source_id"]).alias("source_id"), snapshot.alias("snapshot_id"), record.cast("string").alias("record_native_id"), at.cast("string").alias("observed_at"), F.lit(source["retrieved_at"]).alias("retrieved_at"),
            F.lit(source["terms_revision"]).alias("terms_revision"), F.lit(source["rights_state"]).alias("rights_state"), of.alias("payload_sha256"),
        ).alias("source"),
        F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), native.cast("string").alias("source_native_id"), label.cast("string").alias("label"), F.to_json(attributes).alias("attributes")).alias("subject"),
        (F.array_compact(identifiers) if identifiers is not None else none(IDENTIFIER)).cast(IDENTIFIER).alias("identifiers"),
        (F.array_compact(contributions) if contributions is not None else none(CONTRIBUTION)).cast(CONTRIBUTION).alias("contributions"),
        (F.array_compact(relationships) if relationships is not None else none(RELATION)).cast(RELATION).alias("relationships"),
        F.array(F.struct(F.lit("source_record").alias("kind"), F.concat(F.lit(f"{source['source_id']}:"), snapshot, F.lit("#"), record.cast("string")).alias("locator"), at.cast("string").alias("observed_at"))).cast(EVIDENCE).alias("evidence"),
        (pointer if pointer is not None else F.concat(F.lit(f"{source['source_id']}/"), record.cast("string"))).alias("raw_pointer"),
    )


def code_accounts(accounts: DataFrame, source: dict[str, str]) -> DataFrame:
    """Accounts of a code host (id, node_id, login, previous_logins[login, valid_from, valid_to], type, name, company, location, bio)."""
    at = F.lit(source["observed_at"])
    renamed = F.transform(F.coalesce("previous_logins", F.array().cast("array<struct<login:string,valid_from:string,valid_to:string>>")), lambda a: relation("renamed_from", agent("account", F.concat(F.lit("github:login:"), a["login"]), a["login"]), at, "login history"))
    ids = F.array(identifier("github_account_id", F.col("id")), F.when(F.col("node_id").isNotNull(), identifier("github_node_id", F.col("node_id"))), identifier("github_login", F.col("login"), "mutable", "unknown"))
    return envelope(accounts, source, F.concat(F.lit("account:"), F.col("id").cast("string"), F.lit(f":{source['snapshot_id']}")), F.when(F.col("type") == "Organization", "organisation").otherwise("account"), F.concat(F.lit("github:account:"), F.col("id").cast("string")), F.col("login"), F.struct("type", "login", "name", "company", "location", "bio"), ids, None, renamed)


def archive_events(events: DataFrame, source: dict[str, str]) -> DataFrame:
    """Events of an archive (id, type, created_at, actor{id, login}, repo{id, name}): who performed them on what."""
    at = F.col("created_at")
    made = F.array(relation("performed_by", agent("account", F.concat(F.lit("github:account:"), F.col("actor.id").cast("string")), F.col("actor.login")), at), relation("occurred_on", agent("work", F.concat(F.lit("github:repository:"), F.col("repo.id").cast("string")), F.col("repo.name")), at))
    return envelope(events, source, F.col("id"), "event", F.concat(F.lit("gharchive:event:"), F.col("id").cast("string")), F.col("type"), F.struct("type", "created_at"), F.array(identifier("github_event_id", F.col("id"))), None, made, observed_at=at)


def packages(rows: DataFrame, source: dict[str, str], registry: str) -> DataFrame:
    """Packages (name, license, owners[], versions[version, published_at]): one envelope for a package and one for each release."""
    at, none = F.lit(source["observed_at"]), F.lit(None).cast("string")
    owners = F.transform(F.coalesce("owners", F.array().cast("array<string>")), lambda o, i: contribution("owner", agent("account", F.concat(F.lit(f"{registry}:user:"), o), o), at, i))
    native = F.concat(F.lit(f"{registry}:package:"), F.col("name"))
    whole = envelope(rows, source, F.col("name"), "work", native, F.col("name"), F.struct("license"), F.array(identifier("purl", package_url(F.lit(registry), F.col("name"), none), scope="global")), owners)
    each = rows.select("name", F.explode("versions").alias("v"))
    label = F.concat_ws("@", "name", "v.version")
    made = F.array(relation("version_of", agent("work", native, F.col("name")), at))
    return whole.unionByName(envelope(each, source, label, "work", F.concat(F.lit(f"{registry}:release:"), label), label, F.struct("v.published_at"), F.array(identifier("purl", package_url(F.lit(registry), F.col("name"), F.col("v.version")), scope="global")), None, made, observed_at=F.coalesce("v.published_at", at)))


def archived_objects(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Archived objects (swhid, object_type, visit_date, origin, parent_swhid)."""
    at = F.coalesce("visit_date", F.lit(source["observed_at"]))
    made = F.array(F.when(F.col("origin").isNotNull(), relation("archives", agent("work", F.col("origin"), F.col("origin")), at)), F.when(F.col("parent_swhid").isNotNull(), relation("contained_in", agent("work", F.col("parent_swhid"), F.col("parent_swhid")), at)))
    return envelope(rows, source, F.col("swhid"), "work", F.col("swhid"), F.col("swhid"), F.struct("object_type"), F.array(identifier("swhid", F.col("swhid"), scope="global")), None, made, observed_at=at)


def scholarly_works(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Works (doi, title, author[], editor[], translator[] of {given, family, orcid}): people in order with their roles."""
    people = "array<struct<given:string,family:string,orcid:string>>"

    def of(role: str) -> Column:
        def one(p, i):
            name = F.concat_ws(" ", F.nullif(F.trim(p["given"]), F.lit("")), F.nullif(F.trim(p["family"]), F.lit("")))
            orcid = F.regexp_replace(F.lower(p["orcid"]), "^https?://orcid.org/", "")
            return contribution(role, agent("person", F.coalesce(F.concat(F.lit("orcid:"), orcid), F.concat(F.lit("name:"), name)), name), F.lit(source["observed_at"]), i, identifiers=F.array(F.when(orcid.isNotNull(), identifier("orcid", orcid, scope="global"))))

        return F.transform(F.coalesce(F.col(role).cast(people), F.array().cast(people)), one)

    doi = F.lower(F.regexp_replace("doi", "^https?://(?:dx\\.)?doi.org/", ""))
    return envelope(rows, source, doi, "work", F.concat(F.lit("doi:"), doi), F.col("title"), F.struct("title"), F.array(identifier("doi", doi, scope="global")), F.concat(of("author"), of("editor"), of("translator")))


def paired_authors(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Notes (id, title, authors[], authorids[]): names and ids by their place; a missing id leaves the name."""
    pairs = F.arrays_zip("authors", "authorids")
    who = F.transform(pairs, lambda p, i: contribution("author", agent("person", F.coalesce(F.nullif(p["authorids"], F.lit("")), F.concat(F.lit("name:"), p["authors"])), p["authors"]), F.lit(source["observed_at"]), i))
    return envelope(rows, source, F.col("id"), "work", F.concat(F.lit("openreview:"), F.col("id")), F.col("title"), F.struct("title"), F.array(identifier("openreview_note", F.col("id"))), who)


def feed_episodes(shows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Feeds (guid, title, people[name, role], items[guid, title, people[]]): an item's people take the place of the show's."""
    rows = shows.select(F.col("guid").alias("show"), F.col("title").alias("show_title"), F.col("people").alias("hosts"), F.explode("items").alias("i"))
    people = F.when(F.size(F.coalesce(F.col("i.people"), F.array().cast("array<struct<name:string,role:string>>"))) > 0, F.col("i.people")).otherwise(F.col("hosts"))
    at = F.lit(source["observed_at"])
    who = F.transform(F.coalesce(people, F.array().cast("array<struct<name:string,role:string>>")), lambda p, n: contribution(F.lower(F.coalesce(F.nullif(F.trim(p["role"]), F.lit("")), F.lit("host"))), agent("person", F.concat(F.lit("name:"), p["name"]), p["name"]), at, n))
    made = F.array(relation("episode_of", agent("work", F.concat(F.lit("podcast:"), F.col("show")), F.col("show_title")), at))
    return envelope(rows, source, F.col("i.guid"), "work", F.concat(F.lit("podcast:episode:"), F.col("i.guid")), F.coalesce(F.nullif(F.trim("i.title"), F.lit("")), F.col("i.guid")), F.struct("show"), F.array(identifier("podcast_guid", F.col("i.guid"))), who, made)


def schedule_talks(schedules: DataFrame, source: dict[str, str]) -> DataFrame:
    """Schedules (conference, days[date, rooms map<string, array<{guid, title, persons[name, code]}>>]): talks with speakers."""
    days = schedules.select("conference", F.explode("days").alias("d"))
    rooms = days.select("conference", F.col("d.date").alias("date"), F.explode("d.rooms").alias("room", "talks"))
    talks = rooms.select("conference", "date", "room", F.explode("talks").alias("t"))
    who = F.transform("t.persons", lambda p, i: contribution("speaker", agent("person", F.coalesce(p["code"], F.concat(F.lit("name:"), p["name"])), p["name"]), F.col("date"), i))
    made = F.array(relation("presented_at", agent("event", F.col("conference"), F.col("conference")), F.col("date")))
    return envelope(talks, source, F.col("t.guid"), "work", F.concat(F.lit("talk:"), F.col("t.guid")), F.col("t.title"), F.struct("room", "date"), F.array(identifier("talk_guid", F.col("t.guid"))), who, made)


def people_rows(person: DataFrame, identifiers: DataFrame, topics: DataFrame, source: dict[str, str]) -> DataFrame:
    """People of a graph with what hangs on them, as envelopes; a person without any keeps empty lists."""
    ids = identifiers.groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct("platform", "value"))).alias("ids"))
    tops = topics.groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct("scheme", "topic"))).alias("tops"))
    rows = person.join(ids, "person_id", "left").join(tops, "person_id", "left")
    each = F.transform(F.coalesce("ids", F.array().cast("array<struct<platform:string,value:string>>")), lambda x: F.struct(x["platform"].alias("scheme"), x["value"].alias("value"), F.lit("source").alias("scope"), F.lit("unknown").alias("stability"), F.lit("unknown").alias("uniqueness"), F.lit("external id").alias("evidence")))
    made = F.transform(F.coalesce("tops", F.array().cast("array<struct<scheme:string,topic:string>>")), lambda x: relation("topic_assignment", agent("concept", F.concat_ws(":", x["scheme"], x["topic"]), x["topic"]), F.lit(source["observed_at"])))
    kind = F.when(F.col("kind") == "organisation", "organisation").otherwise("person")
    return envelope(rows, source, F.col("person_id"), kind, F.col("person_id"), F.col("name"), F.struct("state", "origin"), each, None, made, raw=F.struct("person_id", "name", "kind", "state"))


def code_repositories(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Repositories (id, node_id, full_name, owner{id, login, type}, contributors[id, login, role], transfers[from_owner_id, from_owner_login, at],
    dependencies[purl, name], swhids[], description, license)."""
    at = F.lit(source["observed_at"])
    account = lambda x: agent("account", F.concat(F.lit("github:account:"), x["id"].cast("string")), x["login"])
    owner = F.col("owner")
    first = contribution("repository_owner", agent(F.when(owner["type"] == "Organization", "organisation").otherwise("account"), F.concat(F.lit("github:account:"), owner["id"].cast("string")), owner["login"]), at, F.lit(1))
    others = F.transform(F.coalesce("contributors", F.array().cast("array<struct<id:bigint,login:string,role:string>>")), lambda c, i: contribution(F.coalesce(c["role"], F.lit("contributor")), account(c), at, i + 1))
    moved = F.transform(F.coalesce("transfers", F.array().cast("array<struct<from_owner_id:bigint,from_owner_login:string,at:string>>")), lambda t: relation("transferred_from", agent("account", F.concat(F.lit("github:account:"), t["from_owner_id"].cast("string")), t["from_owner_login"]), at, "full-name history"))
    needs = F.transform(F.coalesce("dependencies", F.array().cast("array<struct<purl:string,name:string>>")), lambda d: relation("depends_on", agent("work", d["purl"], F.coalesce(d["name"], d["purl"])), at, "dependency manifest"))
    kept = F.transform(F.coalesce("swhids", F.array().cast("array<string>")), lambda x: relation("archived_as", agent("work", x, x), at, "archival identifier"))
    ids = F.array(identifier("github_repository_id", F.col("id")), F.when(F.col("node_id").isNotNull(), identifier("github_node_id", F.col("node_id"))), identifier("github_full_name", F.col("full_name"), "mutable", "unknown"))
    return envelope(rows, source, F.concat_ws(":", F.lit("repository"), F.col("id").cast("string"), F.lit(source["snapshot_id"])), "work", F.concat(F.lit("github:repository:"), F.col("id").cast("string")), F.col("full_name"), F.struct("full_name", "description", "license"), ids, F.concat(F.array(first), others), F.concat(moved, needs, kept))


def code_releases(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Releases (id, repository_id, repository, tag, published_at, author{id, login})."""
    at = F.coalesce("published_at", F.lit(source["observed_at"]))
    who = F.array(F.when(F.col("author").isNotNull(), contribution("release_author", agent("account", F.concat(F.lit("github:account:"), F.col("author.id").cast("string")), F.col("author.login")), at, F.lit(1))))
    made = F.array(relation("version_of", agent("work", F.concat(F.lit("github:repository:"), F.col("repository_id").cast("string")), F.col("repository")), at))
    return envelope(rows, source, F.col("id"), "work", F.concat(F.lit("github:release:"), F.col("id").cast("string")), F.concat_ws("@", "repository", "tag"), F.struct("tag", "published_at"), F.array(identifier("github_release_id", F.col("id"))), who, made, observed_at=at)


def video_channels(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Channels (id, title, custom_url, published_at, country): accounts, never people."""
    ids = F.array(identifier("youtube_channel_id", F.col("id")), F.when(F.trim("custom_url") != "", identifier("youtube_handle", F.col("custom_url"), "mutable", "unknown")))
    return envelope(rows, source, F.col("id"), "account", F.col("id"), F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.col("id")), F.struct("published_at", "country"), ids)


def videos(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Videos (id, title, channel_id, channel_title, published_at, duration)."""
    at = F.lit(source["observed_at"])
    channel = agent("account", F.col("channel_id"), F.coalesce(F.nullif(F.trim("channel_title"), F.lit("")), F.col("channel_id")))
    has = F.trim("channel_id") != ""
    return envelope(rows, source, F.col("id"), "work", F.col("id"), F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.col("id")), F.struct("published_at", "duration"), F.array(identifier("youtube_video_id", F.col("id"))), F.array(F.when(has, contribution("publisher_account", channel, at))), F.array(F.when(has, relation("published_by", channel, at))))


def authority_people(rows: DataFrame, source: dict[str, str], scheme: str) -> DataFrame:
    """Author records of an authority (id, name, orcid): its own id, and an ORCID where it gives one."""
    orcid = F.nullif(F.regexp_replace(F.trim("orcid"), "^https?://orcid.org/", ""), F.lit(""))
    ids = F.array(identifier(scheme, F.col("id")), F.when(orcid.isNotNull(), identifier("orcid", orcid, scope="global")))
    return envelope(rows, source, F.col("id"), "person", F.col("id"), F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.col("id")), F.struct("name"), ids)


def library_works(rows: DataFrame, source: dict[str, str], scheme: str) -> DataFrame:
    """Catalogue works (key, title, authors[]: keys of people in order, edition_of): contributions by place, an edition points to its work."""
    at = F.lit(source["observed_at"])
    who = F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda k, i: contribution("author", agent("person", k, k), at, i))
    made = F.array(F.when(F.col("edition_of").isNotNull(), relation("edition_of", agent("work", F.col("edition_of"), F.col("edition_of")), at)))
    return envelope(rows, source, F.col("key"), "work", F.col("key"), F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.col("key")), F.struct("title"), F.array(identifier(scheme, F.col("key"))), who, made)


def model_repositories(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Models, datasets and spaces (repo_type, id, owner, contributors[], links[predicate, target], revisions[sha, at]): one envelope each and one
    for each revision."""
    at = F.lit(source["observed_at"])
    native = F.concat_ws(":", F.lit("huggingface"), "repo_type", "id")
    people = F.concat(F.array("owner"), F.coalesce("contributors", F.array().cast("array<string>")))
    who = F.transform(people, lambda p, i: contribution(F.when(i == 0, "repository_owner").otherwise("contributor"), agent("account", F.concat(F.lit("huggingface:account:"), p), p), at, i))
    links = F.transform(F.coalesce("links", F.array().cast("array<struct<predicate:string,target:string>>")), lambda x: F.struct(x["predicate"].alias("predicate"), agent("work", x["target"], x["target"]).alias("object"), at.alias("observed_at"), F.lit("repository card").alias("evidence")))
    whole = envelope(rows, source, F.concat_ws("/", "repo_type", "id"), "work", native, F.col("id"), F.struct("repo_type"), F.array(identifier("huggingface_repo", F.concat_ws("/", "repo_type", "id"))), who, links)
    each = rows.select("repo_type", "id", F.explode("revisions").alias("r"))
    version = F.concat_ws("@", native, "r.sha")
    made = F.array(relation("version_of", agent("work", native, F.col("id")), at))
    return whole.unionByName(envelope(each, source, version, "work", version, F.concat_ws("@", "id", "r.sha"), F.struct("r.sha"), F.array(identifier("huggingface_revision", F.col("r.sha"))), None, made, observed_at=F.coalesce("r.at", at)))


def work_rows(person: DataFrame, content: DataFrame, source: dict[str, str]) -> DataFrame:
    """Works of a graph with the people who contributed to them, by the role on each edge."""
    at = F.lit(source["observed_at"])
    named = content.join(person.select("person_id", "name"), "person_id").groupBy("domain", "content_ref").agg(F.array_sort(F.collect_list(F.struct("role", "person_id", "name"))).alias("by"))
    who = F.transform("by", lambda p, i: contribution(p["role"], agent("person", p["person_id"], p["name"]), at, i))
    ref = F.concat_ws(":", "domain", "content_ref")
    return envelope(named, source, ref, "work", ref, F.col("content_ref"), F.struct("domain"), F.array(identifier("work_ref", ref)), who, raw=F.struct("domain", "content_ref"))


def topic_rows(topics: DataFrame, source: dict[str, str]) -> DataFrame:
    """Topics of each vocabulary as concepts; equal words of two vocabularies stay apart."""
    each = topics.select("scheme", "topic").distinct()
    ref = F.concat_ws(":", "scheme", "topic")
    return envelope(each, source, ref, "concept", ref, F.col("topic"), F.struct("scheme"), F.array(identifier("topic_ref", ref)))


def decision_stream(claims: DataFrame) -> DataFrame:
    """Identity claims as decisions for review: accepted only where someone decided."""
    state = F.when((F.col("status") == "accepted") & F.col("decided_by").isNotNull(), "accepted").when(F.col("status") == "rejected", "rejected").otherwise("proposed")
    return claims.select(F.least("person_a", "person_b").alias("a"), F.greatest("person_a", "person_b").alias("b"), "method", "confidence", state.alias("state"), "decided_by")


OWNERS = "array<struct<id:string,login:string,name:string,kind:string,role:string>>"
PLACES = "array<struct<native_id:string,label:string>>"


def _owners(column: str, scheme: str | Column, role: str, at: Column) -> Column:
    """Owners of a package in order, by id, login or name; without a role of their own they have the registry's."""
    prefix = F.lit(scheme) if isinstance(scheme, str) else scheme

    def one(o: Column, i: Column) -> Column:
        who = F.coalesce(F.nullif(o["id"], F.lit("")), F.nullif(o["login"], F.lit("")), o["name"])
        label = F.coalesce(F.nullif(o["login"], F.lit("")), F.nullif(o["name"], F.lit("")), who)
        return contribution(F.coalesce(o["role"], F.lit(role)), agent(F.when(o["kind"] == "organisation", "organisation").otherwise("account"), F.concat(prefix, F.lit(":"), who), label), at, i + 1)

    return F.transform(F.coalesce(F.col(column).cast(OWNERS), F.array().cast(OWNERS)), one)


def _package_envelopes(rows: DataFrame, source: dict[str, str], registry: Column, name: Column, ids: Column, attributes: list[Column | str], who: Column, made: Column, versions: str | None) -> DataFrame:
    """A package's envelope, and one for each release of `versions` (version, published_at)."""
    at, none = F.lit(source["observed_at"]), F.lit(None).cast("string")
    native = package_url(registry, name, none)
    fields = F.struct(F.lit("software_package").alias("work_type"), "license", F.coalesce("abandoned", F.lit(False)).alias("abandoned"), *attributes)
    whole = envelope(rows, source, name, "work", native, F.col("name"), fields, F.concat(F.array(identifier("purl", native, scope="global")), ids), who, made)
    if versions is None:
        return whole
    each = rows.select("*", F.explode(versions).alias("_v"))
    release = package_url(registry, name, F.col("_v.version"))
    of = F.array(relation("version_of", agent("work", native, F.col("name")), at))
    return whole.unionByName(envelope(each, source, F.concat_ws("@", name, "_v.version"), "work", release, F.concat_ws("@", "name", "_v.version"), F.struct(F.lit("software_release").alias("work_type"), "_v.version", "_v.published_at"), F.array(identifier("purl", release, scope="global")), None, of, raw=F.struct("name", "_v"), observed_at=F.coalesce("_v.published_at", at)))


def _repositories(places: Column, at: Column) -> Column:
    return F.transform(F.coalesce(places.cast(PLACES), F.array().cast(PLACES)), lambda r: relation("source_repository", agent("work", r["native_id"], r["label"]), at))


def pypi_packages(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Projects (name, summary, license, requires_python, abandoned, owners[], source_repositories[], versions[]): a name's case, and
    whether it has underscores, make no other project."""
    at, name = F.lit(source["observed_at"]), F.replace(F.lower("name"), F.lit("_"), F.lit("-"))
    return _package_envelopes(rows, source, F.lit("pypi"), name, F.array(identifier("pypi_project", name)), ["summary", "requires_python"], _owners("owners", "pypi_user", "maintainer", at), _repositories(F.col("source_repositories"), at), "versions")


def crates(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Crates (name, description, license, abandoned, owners[], repository, versions[])."""
    at = F.lit(source["observed_at"])
    return _package_envelopes(rows, source, F.lit("cargo"), F.col("name"), F.array(identifier("crates_io_crate", F.col("name"))), ["description"], _owners("owners", "crates_user_id", "owner", at), _repositories(F.array_compact(F.array("repository")), at), "versions")


def ecosystem_packages(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Packages of any registry (id, ecosystem, name, license, latest_release, abandoned, maintainers[], dependencies[purl, name],
    repository); releases are not listed here."""
    at, none = F.lit(source["observed_at"]), "array<struct<purl:string,name:string>>"
    needs = F.transform(F.coalesce(F.col("dependencies").cast(none), F.array().cast(none)), lambda d: relation("depends_on", agent("work", d["purl"], F.coalesce(d["name"], d["purl"])), at))
    registry = F.when(F.col("ecosystem") == "crates", "cargo").otherwise(F.col("ecosystem"))
    who = _owners("maintainers", F.concat(F.col("ecosystem"), F.lit("_maintainer")), "maintainer", at)
    return _package_envelopes(rows, source, registry, F.col("name"), F.array(identifier("ecosystems_package_id", F.col("id"))), ["ecosystem", "latest_release"], who, F.concat(needs, _repositories(F.array_compact(F.array("repository")), at)), None)


def _text(*columns: Column | str) -> Column:
    """The first that isn't blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit("")) for c in columns])


def catalogue_works(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Works of a scholarly catalogue (id, display_name, title, type, publication_date, updated_date, doi, authorships[author{id,
    display_name, orcid}]): authors in order; one without an id is known by its place."""
    at = _text("updated_date", F.lit(source["retrieved_at"]))
    kind = "array<struct<author:struct<id:string,display_name:string,orcid:string>>>"
    doi = F.nullif(F.lower(F.replace(_text("doi"), F.lit("https://doi.org/"), F.lit(""))), F.lit(""))

    def one(a: Column, i: Column) -> Column:
        who = F.coalesce(_text(a["author"]["id"]), F.concat(F.col("id"), F.lit("#author-"), i.cast("string")))
        return contribution("author", agent("person", who, F.coalesce(_text(a["author"]["display_name"]), who)), at, i + 1)

    who = F.transform(F.coalesce(F.col("authorships").cast(kind), F.array().cast(kind)), one)
    fields = F.struct(F.coalesce(_text("type"), F.lit("scholarly_work")).alias("work_type"), "publication_date")
    return envelope(rows, source, F.col("id"), "work", F.col("id"), F.coalesce(_text("display_name", "title"), F.col("id")), fields, F.array(identifier("openalex_work_id", F.col("id")), F.when(doi.isNotNull(), identifier("doi", doi, scope="global"))), who, observed_at=at)


def podcast_feeds(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Feeds of an index (id, podcast_guid, url, title, original_title)."""
    native = _text("id", "podcast_guid", "url")
    return envelope(rows, source, native, "work", native, F.coalesce(_text("title", "original_title"), native), F.struct(F.lit("podcast_show").alias("work_type")), F.array(identifier("podcast_index_feed_id", native)))


def podcast_episodes(rows: DataFrame, source: dict[str, str]) -> DataFrame:
    """Episodes of an index (id, guid, enclosure_url, title, feed_id, feed_title, transcript_url, persons[id, name, href, role]).

    A person without a role is a guest, one without a name is left out, and one without an id or link is known by the label. A
    transcript is pointed to, never fetched.
    """
    at, kind = F.lit(source["observed_at"]), "array<struct<id:string,name:string,href:string,role:string>>"
    native = _text("id", "guid", "enclosure_url")

    def one(p: Column, i: Column) -> Column:
        label = _text(p["name"])
        who = F.coalesce(_text(p["id"], p["href"]), F.concat(F.lit("label:"), label))
        return F.when(label.isNotNull(), contribution(F.lower(F.coalesce(_text(p["role"]), F.lit("guest"))), agent("person", who, label), at, i + 1))

    who = F.transform(F.coalesce(F.col("persons").cast(kind), F.array().cast(kind)), one)
    feed, script = _text("feed_id"), _text("transcript_url")
    made = F.array(F.when(feed.isNotNull(), relation("part_of", agent("work", feed, F.coalesce(_text("feed_title"), feed)), at)), F.when(script.isNotNull(), relation("has_transcript_pointer", agent("work", script, F.lit("transcript")), at)))
    ids = F.array(identifier("podcast_index_episode_id", native), F.when(_text("guid") != native, identifier("rss_item_guid", _text("guid"))))
    return envelope(rows, source, native, "work", native, F.coalesce(_text("title"), native), F.struct(F.lit("podcast_episode").alias("work_type")), ids, who, made)


def all_records(*frames: DataFrame) -> DataFrame:
    """Envelopes of several adapters as one table."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_PERSON = "array<struct<_VALUE:string,_role:string,_href:string>>"
_ATOM_LINK = "array<struct<_href:string>>"
_ITEM = f"title:string,`podcast:guid`:string,guid:string,link:string,`atom:link`:{_ATOM_LINK},pubDate:string,`podcast:person`:{_PERSON},`podcast:transcript`:array<struct<_url:string,_type:string>>,enclosure:struct<_url:string,_type:string>"
_CHANNEL = f"title:string,`podcast:guid`:string,link:string,`atom:link`:{_ATOM_LINK},language:string,`podcast:person`:{_PERSON},`itunes:author`:string,author:string,managingEditor:string,item:array<struct<{_ITEM}>>"


def _people(persons: Column, at: Column) -> Column:
    """Named people in order; one without a role is a host, one without a link is known by the label."""

    def one(p: Column, i: Column) -> Column:
        label, href = _text(p["_VALUE"]), _text(p["_href"])
        return F.when(label.isNotNull(), contribution(F.lower(F.coalesce(_text(p["_role"]), F.lit("host"))), agent("person", F.coalesce(href, F.concat(F.lit("label:"), label)), label), at, i + 1))

    return F.array_compact(F.transform(F.coalesce(persons, F.array().cast(_PERSON)), one))


def _link(link: Column, atom: Column) -> Column:
    """The text of a link, else the first address of an Atom link."""
    found = F.filter(F.transform(atom, lambda a: _text(a["_href"])), lambda a: a.isNotNull())
    return F.coalesce(_text(link), F.get(found, 0))


def rss_feeds(feeds: DataFrame, source: dict[str, str]) -> DataFrame:
    """RSS documents (feed_url, xml) as their shows and episodes.

    An item's people take the place of the show's; without any, the show's author is its host. Transcripts and media are pointed to,
    never fetched. An item without guid, link or enclosure is known by its place. A text that isn't a channel, or null, is a show
    of the feed's address without items. A feed is one row, so a task holds one feed at a time.
    """
    at = F.lit(source["observed_at"])
    rows = feeds.select("feed_url", F.sha2("xml", 256).alias("digest"), F.from_xml("xml", f"channel struct<{_CHANNEL}>", {"rowTag": "rss"})["channel"].alias("c"))
    author = _text("c.itunes:author", "c.author", "c.managingEditor")
    own = _people(F.col("c.podcast:person"), at)
    fallback = F.array_compact(F.array(F.when(author.isNotNull(), contribution("host", agent("person", F.concat(F.lit("label:"), author), author), at))))
    guid = _text("c.podcast:guid")
    show = rows.select("feed_url", "digest", "c", guid.alias("guid"), F.coalesce(guid, F.col("feed_url")).alias("show"), F.when(F.size(own) > 0, own).otherwise(fallback).alias("hosts"), _link(F.col("c.link"), F.col("c.atom:link")).alias("site")).withColumn("show_title", F.coalesce(_text("c.title"), F.col("show")))
    raw = F.struct("feed_url", "digest")
    pointer = F.concat(F.lit("sha256:"), "digest")
    ids = F.array(identifier("rss_feed_url", F.col("feed_url"), "mutable"), F.when(F.col("guid").isNotNull(), identifier("podcast_guid", F.col("guid"), scope="global")), F.when(F.col("site").isNotNull(), identifier("official_website", F.col("site"), "unknown", "unknown", "global")))
    shows = envelope(show, source, F.col("show"), "work", F.col("show"), F.col("show_title"), F.struct(F.lit("podcast_show").alias("work_type"), F.col("c.language").alias("language")), ids, F.col("hosts"), raw=raw, pointer=pointer)

    each = show.select("feed_url", "digest", "show", "show_title", "hosts", F.posexplode("c.item").alias("n", "i"))
    episode = each.select("*", _text("i.podcast:guid", "i.guid").alias("guid"), _link(F.col("i.link"), F.col("i.atom:link")).alias("site"), _text("i.enclosure._url").alias("media"), _people(F.col("i.podcast:person"), at).alias("people"))
    episode = episode.withColumn("native", F.coalesce("guid", "site", "media", F.concat("show", F.lit(":item:"), F.col("n").cast("string"))))
    scripts = F.transform("i.podcast:transcript", lambda t: F.when(_text(t["_url"]).isNotNull(), relation("has_transcript_pointer", agent("work", _text(t["_url"]), F.coalesce(t["_type"], F.lit("transcript"))), at)))
    made = F.concat(F.array(relation("part_of", agent("work", F.col("show"), F.col("show_title")), at)), F.coalesce(scripts, F.array().cast(RELATION)).cast(RELATION), F.array(F.when(F.col("media").isNotNull(), relation("has_media_pointer", agent("work", F.col("media"), F.coalesce("i.enclosure._type", F.lit("media"))), at))).cast(RELATION))
    ids = F.array(F.when(F.col("guid").isNotNull(), identifier("rss_item_guid", F.col("guid"))), F.when(F.col("site").isNotNull(), identifier("episode_url", F.col("site"), "unknown", "unknown", "global")))
    who = F.when(F.size("people") > 0, F.col("people")).otherwise(F.col("hosts"))
    items = envelope(episode, source, F.col("native"), "work", F.col("native"), F.coalesce(_text("i.title"), F.col("native")), F.struct(F.lit("podcast_episode").alias("work_type"), _text("i.pubDate").alias("published")), ids, who, made, raw=F.struct("feed_url", "digest", "n"), pointer=pointer)
    return shows.unionByName(items)
