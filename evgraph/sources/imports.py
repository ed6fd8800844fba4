"""Envelopes and profiles into the identity store: entities, identifiers, aliases, attributes and receipts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import ELIGIBLE, absent, classified, normalised, observation_id, platform_key, semantics, stable_id
from ..operators.contracts import ATTRIBUTES as DESCRIPTIVE
from ..operators.contracts import RIGHTS
from ..operators.identity import accept
from ..plans.scratch import Scratch

PROFILE = ("name", "company", "location", "bio", "blog", "twitter_username", "type", "followers", "created_at")
# Under which attribute a profile's field is kept.
ATTRIBUTES = {"name": "real_name", "blog": "website", "company": "company", "location": "location", "bio": "biography", "type": "profile_type", "followers": "followers", "created_at": "account_created_at"}


@dataclass
class Store:
    """Rows for each table of the store."""

    entities: DataFrame
    identifiers: DataFrame
    aliases: DataFrame
    attributes: DataFrame


def import_envelopes(envelopes: DataFrame) -> Store:
    """Splits envelopes by the local registry: what an envelope declares of a scheme is evidence, not policy."""
    key = observation_id(F.col("source.source_id"), F.coalesce("subject.kind", F.lit("unknown")), F.coalesce(F.nullif(F.trim("subject.source_native_id"), F.lit("")), F.col("source.record_native_id")))
    rows = envelopes.select(key.alias("entity_id"), F.col("subject.label").alias("label"), F.col("subject.kind").alias("kind"), F.col("source.source_id").alias("origin"), F.coalesce("source.observed_at", "source.retrieved_at").alias("observed_at"), F.col("source.payload_sha256").alias("payload_sha256"), "identifiers", F.col("subject.attributes").alias("fields"), "raw_pointer")
    entities = rows.groupBy("entity_id").agg(F.max_by("label", "observed_at").alias("label"), F.max_by("kind", "observed_at").alias("kind"), F.first("origin").alias("origin"))
    each = classified(rows.select("entity_id", "origin", "observed_at", "payload_sha256", F.explode("identifiers").alias("i")).select("entity_id", "origin", "observed_at", "payload_sha256", F.lower("i.scheme").alias("scheme"), F.col("i.value").alias("raw")))
    each = each.withColumn("value", normalised(F.col("scheme"), F.col("raw")))
    ids = each.filter((F.col("category") == "identifier") & (F.col("value") != "")).select("entity_id", "scheme", "value", "uniqueness", "auto_eligible", absent(F.col("scheme"), F.col("value")).alias("absent"), "observed_at", F.lit(None).cast("string").alias("valid_to")).dropDuplicates(["entity_id", "scheme", "value"])
    aliases = each.filter((F.col("category") == "alias") & (F.col("value") != "")).select("entity_id", "scheme", F.col("value").alias("alias"), "observed_at").dropDuplicates(["entity_id", "scheme", "alias"])
    other = each.filter(~F.col("category").isin("identifier", "alias")).select("entity_id", F.concat(F.lit("observed_identifier:"), F.coalesce(F.nullif("scheme", F.lit("")), F.lit("unknown"))).alias("attribute"), F.col("raw").alias("value"), "observed_at", "payload_sha256")
    fields = rows.select("entity_id", F.explode(F.from_json("fields", "map<string,string>")).alias("attribute", "value"), "observed_at", "payload_sha256")
    pointers = rows.filter("raw_pointer IS NOT NULL").select("entity_id", F.lit("raw_pointer").alias("attribute"), F.col("raw_pointer").alias("value"), "observed_at", "payload_sha256")
    return Store(entities, ids, aliases, other.unionByName(fields).unionByName(pointers))


def import_claims(claims: DataFrame) -> DataFrame:
    """Old claims as decisions: an accepted one stays so only if it rests on an identifier that may decide; the others go back to
    review, with the reason."""
    scheme = F.coalesce(F.get_json_object("evidence", "$.scheme"), F.nullif(F.regexp_extract("evidence", r"scheme=([A-Za-z0-9_]+)", 1), F.lit("")))
    value = F.coalesce(F.get_json_object("evidence", "$.value"), F.nullif(F.regexp_extract("evidence", r"value=([^;,\s]+)", 1), F.lit("")))
    rows = classified(claims.withColumns({"scheme": scheme, "value": value}))
    unsafe = ~F.col("auto_eligible") | absent(F.col("scheme"), F.col("value"))
    state = F.when((F.col("status") == "accepted") & unsafe & F.col("decided_by").isNull(), "proposed").otherwise(F.col("status"))
    reason = F.when(state != F.col("status"), F.when(~F.col("auto_eligible"), "scheme may not decide").otherwise("value stands for absence"))
    return rows.select("person_a", "person_b", "method", "scheme", state.alias("status"), reason.alias("quarantined"))


def profile_rows(profiles: DataFrame) -> DataFrame:
    """Account profiles (entity_id, id, node_id, login, the fields of PROFILE) as long rows (entity_id, kind, scheme, value): a null
    field is a receipt of absence, not a reason to ask again."""
    of = lambda kind, scheme, c: F.struct(F.lit(kind).alias("kind"), F.lit(scheme).alias("scheme"), F.col(c).cast("string").alias("value"))
    known = [of("identifier", "github_id", "id"), of("identifier", "github_node_id", "node_id"), of("alias", "github_login", "login"), of("alias", "x_handle", "twitter_username")]
    rows = profiles.select("entity_id", F.explode(F.array(*known, *[of("attribute", a, c) for c, a in ATTRIBUTES.items()])).alias("r")).select("entity_id", "r.*")
    return rows.withColumn("status", F.when(F.trim("value") != "", "present").otherwise("absent"))


def requested_login(people: DataFrame, observed: DataFrame) -> DataFrame:
    """The login to ask for: the newest observed one, else what follows `gh:` in the id, else the name."""
    newest = observed.filter("platform = 'github_login'").groupBy("person_id").agg(F.max_by("value", "seq").alias("login"))
    suffix = F.when(F.startswith("person_id", F.lit("gh:")), F.substring("person_id", 4, 1_000_000))
    return people.join(newest, "person_id", "left").select("person_id", F.coalesce("login", suffix, "name").alias("login"))


def policies(spark: SparkSession, rows: list[tuple[str, str, str, int]]) -> DataFrame:
    """A registry of source policies (source_id, rights_state, terms_revision, refresh_days)."""
    return spark.createDataFrame(rows, "source_id string, rights_state string, terms_revision string, refresh_days int")


# The vocabularies of a source's policy.
POLICY_TEXTS = ("source_id", "official_access", "terms_revision", "rights_state_default", "attribution", "quota_or_rate_limit", "refresh_rule", "deletion_update_method", "retention_boundary", "payload_boundary", "recommended_state")
RECOMMENDED = ("pilot_now", "research_more", "discovery_only", "do_not_ingest")


def policy_problems(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Adds `problems` of source policies (POLICY_TEXTS, official_docs[]): missing fields, a source that isn't known (source_id), words
    outside the vocabularies, documents that aren't HTTPS addresses."""
    docs = F.coalesce((F.size("official_docs") > 0) & F.forall("official_docs", lambda u: F.coalesce(F.startswith(u, F.lit("https://")), F.lit(False))), F.lit(False))
    listed = known.select("source_id").distinct().withColumn("_known", F.lit(True))
    rules = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in POLICY_TEXTS]
    rules += [F.when(F.col("_known").isNull(), "source.unknown"), F.when(~F.col("rights_state_default").isin(*RIGHTS), "rights_state"), F.when(~F.col("recommended_state").isin(*RECOMMENDED), "recommended_state"), F.when(~docs, "official_docs")]
    return rows.join(listed, "source_id", "left").withColumn("problems", F.array_compact(F.array(*rules))).drop("_known")


def with_policy(frame: DataFrame, registry: DataFrame, source: Column | str = "source_id") -> DataFrame:
    """Adds each row's policy; a source without one has pending rights and unrecorded terms."""
    known = registry.select(F.col("source_id").alias("_source"), "rights_state", "terms_revision", "refresh_days")
    out = frame.join(known, (F.col(source) if isinstance(source, str) else source) == F.col("_source"), "left").drop("_source")
    return out.withColumns({"rights_state": F.coalesce("rights_state", F.lit("pending")), "terms_revision": F.coalesce("terms_revision", F.lit("documented-unknown"))})


def stale(frame: DataFrame, registry: DataFrame, now: str) -> DataFrame:
    """Rows (source_id, retrieved_at) past their source's refresh window."""
    return with_policy(frame, registry).filter(F.col("refresh_days").isNotNull() & (F.try_to_timestamp(F.lit(now)) > F.try_to_timestamp("retrieved_at") + F.make_interval(days=F.col("refresh_days"))))


# Which field of a profile an old platform's value answers.
LEGACY_FIELDS = {"github_id": "id", "github_node_id": "node_id", "github_login": "login", "real_name": "name", "x_handle": "twitter_username", "website": "blog", "company": "company", "location": "location", "biography": "bio"}
REQUIRED = ("id", "node_id", "login", *PROFILE)


def missing_fields(people: DataFrame, receipts: DataFrame, external_ids: DataFrame) -> DataFrame:
    """(entity_id, fields): what is still to be asked of each account (entity_id): the profile's fields without a receipt (entity_id,
    source, field) of that source and without an old value (person_id, platform). Those that lack nothing are left out."""
    fields = F.create_map(*[F.lit(x) for pair in LEGACY_FIELDS.items() for x in pair])
    legacy = external_ids.select(F.col("person_id").alias("entity_id"), fields[F.col("platform")].alias("field")).filter("field IS NOT NULL")
    seen = receipts.filter("source = 'github_api'").select("entity_id", "field").unionByName(legacy).groupBy("entity_id").agg(F.collect_set("field").alias("seen"))
    wanted = F.array(*[F.lit(f) for f in REQUIRED])
    left = people.select("entity_id").distinct().join(seen, "entity_id", "left").select("entity_id", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("fields"))
    return left.filter(F.size("fields") > 0)


def legacy_values(external_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old values (person_id, platform, value, confidence, source) as identifiers and as attributes of each person: a name, a place or
    a text about a person never becomes an identifier."""
    by = F.coalesce("source", F.lit("unknown"))
    rows = external_ids.withColumn("_described", F.coalesce(platform_key(F.col("platform")).isin(*DESCRIPTIVE), F.lit(False)))
    means = semantics(F.col("platform"))
    said = F.concat(F.lit("legacy external_ids literal; source="), by, F.lit("; confidence="), F.coalesce(F.col("confidence").cast("string"), F.lit("None")))
    one = F.struct(F.col("platform").alias("scheme"), F.col("value").cast("string").alias("value"), means["scope"].alias("scope"), means["stability"].alias("stability"), means["uniqueness"].alias("uniqueness"), said.alias("evidence"))
    other = F.struct(F.col("platform").alias("field"), F.col("value").cast("string").alias("value"), by.alias("source"), "confidence")
    return rows.filter("NOT _described").groupBy("person_id").agg(F.array_sort(F.collect_list(one)).alias("identifiers")), rows.filter("_described").groupBy("person_id").agg(F.array_sort(F.collect_list(other)).alias("attributes"))


def legacy_scheme(evidence: Column) -> Column:
    """The scheme that an old claim's evidence names: of a JSON object its `scheme` or `platform`, or the one scheme of all its
    `positive` entries; of other texts what stands before the first `=`."""
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(evidence)).startswith("OBJECT"), F.lit(False))
    field = lambda k: F.nullif(F.get_json_object(evidence, f"$.{k}"), F.lit(""))
    positive = F.from_json(F.get_json_object(evidence, "$.positive"), "array<struct<scheme:string>>")
    schemes = F.array_distinct(F.transform(F.filter(positive, lambda x: F.coalesce(x["scheme"] != "", F.lit(False))), lambda x: F.lower(x["scheme"])))
    only = F.when(F.size(schemes) == 1, F.get(schemes, 0))
    return F.when(is_object, F.coalesce(F.lower(F.coalesce(field("scheme"), field("platform"))), only)).otherwise(F.lower(F.nullif(F.regexp_extract(evidence, r"^([A-Za-z0-9_.:-]+)=", 1), F.lit(""))))


@dataclass
class People:
    """A person graph in the identity store: `candidates` are its claims after review of their grounds, `decisions` those that hold."""

    store: Store
    candidates: DataFrame
    decisions: DataFrame


def import_people(person: DataFrame, external_ids: DataFrame, claims: DataFrame, at: str, scratch: Scratch | None = None) -> People:
    """A person graph's rows, old values and claims in the identity store.

    person: person_id, name, kind, origin, birth_year, death_year, state. external_ids: person_id, platform, value, confidence, source.
    claims: claim_id, person_a, person_b, method, confidence, evidence, status, decided_by. Old values go by the registry: those of
    unknown platforms are kept as attributes. An accepted claim stays so if its shared identifier may decide, or if a reviewer is
    named and it doesn't rest on a shared identifier; and only if no cluster would then hold two values of a unique scheme. All
    others go back to review, with the reason in `quarantined`. A claim of a person with themselves is left out.
    """
    scratch = scratch or Scratch(person.sparkSession, "imported")
    entities = person.select(F.col("person_id").alias("entity_id"), F.col("name").alias("label"), F.coalesce("kind", F.lit("unknown")).alias("kind"), "origin", "birth_year", "death_year", F.col("state").alias("source_state")).dropDuplicates(["entity_id"])
    each = classified(external_ids.select(F.col("person_id").alias("entity_id"), "platform", F.lower(F.trim("platform")).alias("scheme"), F.col("value").alias("raw"), "confidence", F.coalesce("source", F.lit("external_ids")).alias("source")))
    each = scratch.write(each.withColumn("value", normalised(F.col("scheme"), F.col("raw"))), "values")
    none = F.lit(None).cast("string").alias("valid_to")
    ids = scratch.write(each.filter((F.col("category") == "identifier") & (F.col("value") != "")).select("entity_id", "scheme", "value", "uniqueness", "auto_eligible", absent(F.col("scheme"), F.col("value")).alias("absent"), F.lit(at).alias("observed_at"), none).dropDuplicates(["entity_id", "scheme", "value"]), "identifiers")
    account = ids.filter("scheme = 'github_id'").groupBy("entity_id").agg(F.max("value").alias("_account"))
    tied = (F.col("scheme") == "github_login") & F.col("_account").isNotNull()
    aliases = each.filter((F.col("category") == "alias") & (F.col("value") != "")).join(account, "entity_id", "left").select("entity_id", "scheme", F.col("value").alias("alias"), F.lit(at).alias("observed_at"), F.when(tied, "github_id").alias("stable_identifier_scheme"), F.when(tied, F.col("_account")).alias("stable_identifier_value")).dropDuplicates(["entity_id", "scheme", "alias"])
    named = F.when(F.col("category").isin("attribute", "metric"), F.col("platform")).otherwise(F.concat(F.lit("legacy_external_id:"), "platform"))
    attributes = each.filter(~F.col("category").isin("identifier", "alias")).select("entity_id", named.alias("attribute"), F.col("raw").alias("value"), F.lit(at).alias("observed_at"), F.sha2("raw", 256).alias("payload_sha256"))

    shared = F.col("method") == "shared_external_id"
    rows = claims.filter("person_a <> person_b").withColumns({"entity_a": F.least("person_a", "person_b"), "entity_b": F.greatest("person_a", "person_b"), "scheme": F.when(shared, legacy_scheme(F.col("evidence")))})
    safe = F.coalesce(F.col("scheme").isin(*ELIGIBLE), F.lit(False))
    state = F.when(F.col("status").isin("proposed", "accepted", "rejected"), F.col("status")).otherwise("proposed")
    holds = F.when(shared, safe).otherwise(F.coalesce(F.col("decided_by") != "", F.lit(False)))
    rows = rows.withColumns({"review_state": F.when((state == "accepted") & ~holds, "proposed").otherwise(state), "auto_eligible": safe, "quarantined": F.when((state == "accepted") & ~holds, F.when(shared, "legacy_noneligible_external_id").otherwise("no_reviewer"))})
    rows = scratch.write(rows.withColumn("candidate_id", stable_id("legacy-cand", F.col("entity_a").cast("string"), F.col("entity_b").cast("string"), F.col("method"))), "claims")
    strongest = rows.groupBy("candidate_id", "entity_a", "entity_b", "method").agg(F.max_by(F.struct("review_state", "quarantined", "confidence", "auto_eligible", "scheme", "claim_id", "decided_by"), F.struct((F.col("review_state") != "proposed").cast("int"), F.col("claim_id").cast("string"))).alias("c")).select("candidate_id", "entity_a", "entity_b", "method", "c.*")
    # sequential in meaning, so the import accepts as any batch does: components that hold a conflict replay their edges in order
    log = strongest.filter(F.lit(False)).select(F.lit("").alias("decision_id"), "candidate_id", "entity_a", "entity_b", F.lit("").alias("outcome"), F.lit(True).alias("active"), F.lit(0).cast("long").alias("seq"))
    judged = accept(strongest.filter("review_state = 'accepted'").withColumn("conflicts", F.array().cast("array<string>")), log, ids, scratch)
    refused = judged.filter("verdict <> 'accepted'").select("candidate_id", F.lit("legacy_transitive_identifier_conflict").alias("_refused"))
    final = strongest.join(refused, "candidate_id", "left").withColumns({"review_state": F.when(F.col("_refused").isNotNull(), "proposed").otherwise(F.col("review_state")), "quarantined": F.coalesce("_refused", "quarantined")}).drop("_refused")
    final = scratch.write(final, "candidates")
    by = F.coalesce(F.nullif("decided_by", F.lit("")), F.when(F.col("auto_eligible"), "legacy-safe-auto").otherwise("legacy-review"))
    decisions = final.filter("review_state <> 'proposed'").select(stable_id("legacy-decision", F.col("claim_id").cast("string"), F.col("candidate_id"), F.col("review_state")).alias("decision_id"), "candidate_id", "entity_a", "entity_b", F.col("review_state").alias("outcome"), F.lit(True).alias("active"), F.lit(1).cast("long").alias("seq"), by.alias("decided_by"))
    return People(Store(entities, ids, aliases, attributes), final, decisions)
