"""Validation: envelope rules that collect all issues, and constraints as queries for violating rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_problem
from ..functions.jsonx import is_digest, keys_at_any_depth

# The vocabularies of the observation contract.
VERSION = "pg-observation-0.1"
RIGHTS = ("public_metadata", "open_data", "restricted", "discovery_only", "pending")
SUBJECTS = ("person", "organisation", "account", "work", "event", "venue", "place", "concept", "claim")
SCOPES, STABILITIES, UNIQUENESS = ("global", "source", "organisation"), ("stable", "mutable", "unknown"), ("unique", "non_unique", "unknown")
ATTRIBUTES = ("name", "full_name", "display_name", "real_name", "company", "employer", "organisation_name", "location", "city", "country", "biography", "bio", "topic", "subject")
HANDLES = ("handle", "username", "login", "github_login", "x_handle", "mastodon_handle", "bluesky_handle", "youtube_handle")
CANONICAL_KEYS = ("canonical_id", "canonical_person_id", "canonical_entity_id", "canonical_people_graph_id", "people_graph_id", "cluster_id", "resolved_entity_id", "merged_into", "canonical_redirect")
MERGE_KEYS = ("auto_merge", "merge_on_name", "name_only_merge", "resolve_by_name", "canonicalize")
IDENTITY_RELATIONS = ("same_as", "sameas", "identity_match", "identical_to", "equivalent_to", "merged_into", "canonicalizes")
NAME_ONLY = ("name", "name_only", "exact_name", "normalised_name", "normalized_name", "surname_initial")
REVIEW_STATES = ("observed", "proposed", "needs_review", "review_only")
PRIVATE = r"^/(?:Users|home|Volumes)/|^[A-Za-z]:[\\/]|^(?i:file)://"

ISSUE = "array<struct<code:string,path:string>>"
ENVELOPE = """envelope_version string, source struct<source_id:string,snapshot_id:string,record_native_id:string,observed_at:string,retrieved_at:string,terms_revision:string,rights_state:string,payload_sha256:string>,
 subject struct<kind:string,source_native_id:string,label:string,attributes:string>, identifiers array<struct<scheme:string,value:string,scope:string,stability:string,uniqueness:string,evidence:string>>,
 contributions array<struct<role:string,order:int,agent:struct<kind:string,source_native_id:string,label:string>,observed_at:string,evidence:string>>,
 relationships array<struct<type:string,review_state:string,method:string,basis:array<string>,evidence:string>>, evidence array<struct<kind:string,locator:string,observed_at:string>>, raw_pointer string"""


def _issue(bad: Column, code: str, path: Column | str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code).alias("code"), (F.lit(path) if isinstance(path, str) else path).alias("path")))


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _identifier_issues(x: Column, i: Column) -> Column:
    at = lambda f: F.concat(F.lit("$.identifiers["), i.cast("string"), F.lit(f"].{f}"))
    key = F.regexp_replace(F.lower(F.trim(x["scheme"])), "-", "_")
    handle = key.isin(*HANDLES)
    out = [_issue(_blank(x[f]), "required.text", at(f)) for f in ("scheme", "value", "scope", "stability", "uniqueness", "evidence")]
    out += [_issue(~_blank(x[f]) & ~x[f].isin(*known), f"identifier.{f}", at(f)) for f, known in (("scope", SCOPES), ("stability", STABILITIES), ("uniqueness", UNIQUENESS))]
    out += [
        _issue(key.isin(*ATTRIBUTES), "identifier.attribute_promoted", at("scheme")), _issue(handle & (x["scope"] == "global"), "identifier.handle_global", at("scope")),
        _issue(handle & (x["stability"] == "stable"), "identifier.handle_stable", at("stability")), _issue(handle & (x["uniqueness"] == "unique"), "identifier.handle_unique", at("uniqueness")),
    ]
    return F.array(*out)


def _relationship_issues(x: Column, i: Column) -> Column:
    at = F.concat(F.lit("$.relationships["), i.cast("string"), F.lit("]"))
    kind = F.regexp_replace(F.lower(F.trim(F.coalesce(x["type"], F.lit("")))), "[- ]", "_")
    identity = kind.isin(*IDENTITY_RELATIONS)
    low = F.transform(F.coalesce(x["basis"], F.array().cast("array<string>")), lambda b: F.lower(F.trim(b)))
    by_name = F.lower(F.trim(F.coalesce(x["method"], F.lit("")))).isin(*NAME_ONLY) | ((F.size(low) > 0) & F.forall(low, lambda b: b.isin(*NAME_ONLY)))
    return F.array(
        _issue(kind == "", "relationship.type", at),
        _issue(identity & ~F.lower(F.trim(F.coalesce(x["review_state"], F.lit("")))).isin(*REVIEW_STATES), "identity.relationship_not_review_only", F.concat(at, F.lit(".review_state"))),
        _issue(identity & (by_name | _blank(x["evidence"])), "identity.name_only_merge", at),
    )


def _nested(items: Column, rules) -> Column:
    """Issues of all items of a list."""
    return F.when(items.isNotNull(), F.flatten(F.transform(items, rules))).otherwise(F.array().cast(ISSUE))


def envelope_issues(envelopes: DataFrame, raw: str | None = None) -> DataFrame:
    """Adds `issues` (code, path) of each envelope, all of them; `raw` names a column of its JSON text, searched for forbidden keys."""
    source, subject = F.col("source"), F.col("subject")
    rules = [_issue(~F.col("envelope_version").eqNullSafe(VERSION), "envelope.version", "$.envelope_version"), _issue(source.isNull(), "type.mapping", "$.source"), _issue(subject.isNull(), "type.mapping", "$.subject")]
    rules += [_issue(source.isNotNull() & _blank(source[f]), "required.text", f"$.source.{f}") for f in ("source_id", "snapshot_id", "record_native_id", "observed_at", "retrieved_at", "terms_revision", "rights_state", "payload_sha256")]
    rules += [_issue(subject.isNotNull() & _blank(subject[f]), "required.text", f"$.subject.{f}") for f in ("kind", "source_native_id", "label")]
    rules += [_issue(~_blank(source["rights_state"]) & ~source["rights_state"].isin(*RIGHTS), "source.rights_state", "$.source.rights_state"), _issue(~_blank(subject["kind"]) & ~subject["kind"].isin(*SUBJECTS), "subject.kind", "$.subject.kind")]
    rules += [_issue(~_blank(source["payload_sha256"]) & ~is_digest(source["payload_sha256"]), "format.sha256", "$.source.payload_sha256"), _issue(F.col("raw_pointer").rlike(PRIVATE), "pointer.private_path", "$.raw_pointer"), _issue(_blank(F.col("raw_pointer")), "required.text", "$.raw_pointer")]
    for f in ("observed_at", "retrieved_at"):
        problem = iso_problem(source[f])
        rules += [_issue(~_blank(source[f]) & (problem == code), code, f"$.source.{f}") for code in ("format.iso8601", "format.timezone")]
    rules += [_issue(F.col(f).isNull(), "type.list", f"$.{f}") for f in ("identifiers", "contributions", "relationships", "evidence")]
    out = F.concat(F.array(*rules), _nested(F.col("identifiers"), _identifier_issues), _nested(F.col("relationships"), _relationship_issues))
    if raw is not None:
        keys = F.col("_keys")
        canonical = F.exists(keys, lambda k: k.isin(*CANONICAL_KEYS) | F.startswith(k, F.lit("canonical_")) | F.endswith(k, F.lit("_canonical_id")))
        envelopes = envelopes.withColumn("_keys", keys_at_any_depth(F.col(raw)))
        out = F.concat(out, F.array(_issue(canonical, "identity.canonical_id_forbidden", "$"), _issue(F.exists(keys, lambda k: k.isin(*MERGE_KEYS)), "identity.merge_directive_forbidden", "$")))
    return envelopes.withColumn("issues", F.array_compact(out)).drop("_keys")


def report(checked: DataFrame) -> DataFrame:
    """One row: records, valid ones, and issues."""
    return checked.agg(F.count("*").alias("records"), F.count_if(F.size("issues") == 0).alias("valid"), F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("issues"))


def payload_mismatches(envelopes: DataFrame, payloads: DataFrame) -> DataFrame:
    """Envelopes whose payload (path, content) is missing or has another digest."""
    of = payloads.select(F.col("path").alias("raw_pointer"), F.sha2("content", 256).alias("_digest"))
    return envelopes.join(of, "raw_pointer", "left").filter(~F.col("_digest").eqNullSafe(F.col("source.payload_sha256"))).withColumn("code", F.when(F.col("_digest").isNull(), "payload.missing").otherwise("payload.digest")).drop("_digest")


def duplicates(frame: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys of several rows, of those that `where` chooses: what a partial unique index forbids."""
    return (frame if where is None else frame.filter(where)).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference isn't null and has no parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def violations(frame: DataFrame, **checks: Column) -> DataFrame:
    """Rows that fail a check, once for each failed one, with its name; a check that is null passes."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in checks.items()]))
    return frame.withColumn("violated", F.explode(failed))


def assertion_checks() -> dict[str, Column]:
    """Of an assertion: either an object or a value, an interval in order, no edge to itself."""
    return {
        "object_xor_value": F.col("object_id").isNull() != F.col("value").isNull(), "interval_order": F.col("valid_from") < F.col("valid_to"), "no_self_edge": F.col("subject_id") != F.col("object_id"),
    }


def changed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of an append-only table that were changed or removed."""
    return before.exceptAll(after.select(*before.columns)).select(key).distinct()


def blocked_accepts(decisions: DataFrame, open_conflicts: DataFrame) -> DataFrame:
    """Accepted decisions on candidates with an open conflict."""
    return decisions.filter("active AND outcome = 'accepted'").join(open_conflicts.select("candidate_id").distinct(), "candidate_id", "left_semi")


def seed_problems(seeds: DataFrame) -> DataFrame:
    """Adds `problems` of cohort seeds (seed_id, source_id, domains, stable_identifiers, living_state)."""
    ids = F.coalesce(F.col("stable_identifiers"), F.array().cast("array<struct<scheme:string,value:string>>"))
    rules = {
        "name_only": F.size(ids) == 0, "no_domain": F.coalesce(F.size("domains"), F.lit(0)) <= 0, "identifier_blank": F.exists(ids, lambda x: _blank(x["scheme"]) | _blank(x["value"])),
        "unsafe_scheme": F.exists(ids, lambda x: x["scheme"].isin("name", "real_name", "company", "location", "handle")), "living_state": ~F.coalesce(F.col("living_state").isin("living", "likely_living", "unknown"), F.lit(False)),
    }
    return seeds.withColumn("problems", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])))
