"""Rules of the two source lanes beside the shared contract: software and creators. All issues of a record are collected."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_problem
from ..functions.jsonx import is_digest, keys_at_any_depth
from .contracts import ISSUE, RIGHTS, SCOPES, STABILITIES, SUBJECTS, UNIQUENESS, VERSION

# Schemes that never identify in the software lane, and keys that it forbids.
SOFTWARE_ATTRIBUTES = ("name", "real_name", "company", "location", "biography", "bio")
SOFTWARE_FORBIDDEN = ("canonical_id", "canonical_person_id", "canonical_entity_id", "merged_into", "rank_score", "universal_score")
# Schemes that are never global in the creators lane, and keys that it forbids.
CREATOR_ALIASES = ("name", "display_name", "real_name", "company", "employer", "location", "biography", "topic", "handle", "username", "youtube_handle", "podcast_person_name")
CREATOR_FORBIDDEN = ("canonical_id", "canonical_person_id", "people_graph_id", "person_id", "merged_into", "cluster_id", "resolved_identity")
AGENTS = ("person", "organisation", "account")

_IDENTIFIERS = "array<struct<scheme:string,value:string,scope:string,stability:string,uniqueness:string,evidence:string>>"
_THING = "kind:string,source_native_id:string,label:string"
#: A record of either lane; what a lane has no use for is null.
RECORD = f"""envelope_version string, source struct<source_id:string,snapshot_id:string,record_native_id:string,observed_at:string,retrieved_at:string,terms_revision:string,rights_state:string,payload_sha256:string>,
 subject struct<{_THING},attributes:struct<metrics:array<struct<name:string,value:string,observed_at:string>>>>, identifiers {_IDENTIFIERS},
 contributions array<struct<role:string,evidence:string,observed_at:string,agent:struct<{_THING},identifiers:{_IDENTIFIERS}>>>,
 relationships array<struct<predicate:string,evidence:string,observed_at:string,object:struct<{_THING}>,valid_time:struct<`at`:string,`from`:string,`to`:string>>>,
 evidence array<struct<kind:string,locator:string,observed_at:string,inference:boolean,model:struct<name:string,version:string,input_sha256:string>>>, raw_pointer string"""


def _issue(bad: Column, code: str, path: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(code).alias("code"), path.alias("path")))


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _required(x: Column, at: Column, *fields: str) -> list[Column]:
    return [_issue(_blank(x[f]), "required.text", F.concat(at, F.lit(f".{f}"))) for f in fields]


def _times(x: Column, at: Column, *fields: str, required: bool = True) -> list[Column]:
    """A time is ISO-8601 with a timezone; a missing one is an issue where it is required."""
    out = []
    for f in fields:
        path = F.concat(at, F.lit(f".{f}"))
        if required:
            out.append(_issue(_blank(x[f]), "required.text", path))
        out += [_issue(~_blank(x[f]) & (iso_problem(x[f]) == code), code, path) for code in ("format.iso8601", "format.timezone")]
    return out


def _known(c: Column, values: Iterable[str], code: str, at: Column) -> Column:
    return _issue(~_blank(c) & ~c.isin(*values), code, at)


def _each(items: Column, path: Column, rules) -> Column:
    """Issues of all items of a list; none of a missing one."""
    of = lambda x, i: F.array_compact(F.array(*rules(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
    return F.coalesce(F.flatten(F.transform(items, of)), F.array().cast(ISSUE))


def _identifier_rules(lane: str):
    def rules(x: Column, at: Column) -> list[Column]:
        scheme = F.lower(F.trim(x["scheme"])) if lane == "software" else F.lower(x["scheme"])
        own = _issue(scheme.isin(*SOFTWARE_ATTRIBUTES), "identifier.attribute_promoted", at) if lane == "software" else _issue(scheme.isin(*CREATOR_ALIASES) & (x["scope"] == "global"), "identifier.alias_global", at)
        vocabularies = [_known(x[f], v, f"identifier.{f}", F.concat(at, F.lit(f".{f}"))) for f, v in (("scope", SCOPES), ("stability", STABILITIES), ("uniqueness", UNIQUENESS))]
        return [*_required(x, at, "scheme", "value", "scope", "stability", "uniqueness", "evidence"), *vocabularies, own]

    return rules


def _identifiers(items: Column, at: Column, lane: str) -> Column:
    found = _each(items, at, _identifier_rules(lane))
    if lane == "software":
        return found
    keys = F.transform(items, lambda x: F.struct(F.lower(x["scheme"]).alias("s"), x["value"].alias("v"), x["scope"].alias("o")))
    twice = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.concat(found, F.array_compact(F.array(_issue(twice, "identifier.duplicate", at))))


def _software(root: Column) -> Column:
    source, subject = F.col("_r.source"), F.col("_r.subject")
    order = F.try_to_timestamp(source["retrieved_at"]) < F.try_to_timestamp(source["observed_at"])
    contribution = lambda x, at: [
        *_required(x, at, "role"), *_times(x, at, "observed_at"), _issue(x["agent"].isNull(), "required.object", F.concat(at, F.lit(".agent"))), _issue(x["agent"].isNotNull() & (_blank(x["agent"]["source_native_id"]) | x["agent"]["label"].isNull()), "required.text", F.concat(at, F.lit(".agent"))),
        _issue(x["agent"].isNotNull() & ~F.coalesce(x["agent"]["kind"].isin(*AGENTS), F.lit(False)), "agent.kind", F.concat(at, F.lit(".agent.kind"))),
    ]
    relation = lambda x, at: [
        *_required(x, at, "predicate", "evidence"), *_times(x, at, "observed_at"), _issue(x["object"].isNull(), "required.object", F.concat(at, F.lit(".object"))), _issue(x["object"].isNotNull() & (_blank(x["object"]["source_native_id"]) | x["object"]["label"].isNull()), "required.text", F.concat(at, F.lit(".object"))),
        _issue(x["object"].isNotNull() & ~F.coalesce(x["object"]["kind"].isin(*SUBJECTS), F.lit(False)), "object.kind", F.concat(at, F.lit(".object.kind"))), *_times(x["valid_time"], F.concat(at, F.lit(".valid_time")), "at", "from", "to", required=False),
    ]
    proof = lambda x, at: [*_required(x, at, "kind", "locator"), *_times(x, at, "observed_at")]
    metric = lambda x, at: [_issue(x["name"].isNull() | x["value"].isNull(), "metric.fields", at), *_times(x, at, "observed_at")]
    return F.concat(
        F.array_compact(F.array(_issue(order, "source.time_order", F.lit("$.source.retrieved_at")), _issue(subject["label"].isNull(), "required.text", F.lit("$.subject.label")))),
        _each(F.col("_r.contributions"), F.lit("$.contributions"), contribution), _each(F.col("_r.relationships"), F.lit("$.relationships"), relation),
        _each(F.col("_r.evidence"), F.lit("$.evidence"), proof), _each(subject["attributes"]["metrics"], F.lit("$.subject.attributes.metrics"), metric),
    )


def _creators(root: Column) -> Column:
    agent = lambda x, at: [_issue(x["agent"].isNull(), "required.object", at), *[_issue(x["agent"].isNotNull() & _blank(x["agent"][f]), "required.text", F.concat(at, F.lit(f".{f}"))) for f in ("source_native_id", "label")], _known(x["agent"]["kind"], (*SUBJECTS, "unknown"), "agent.kind", F.concat(at, F.lit(".kind")))]
    contribution = lambda x, at: [*_required(x, at, "role", "evidence"), *agent(x, F.concat(at, F.lit(".agent")))]
    relation = lambda x, at: [_issue(x[f].isNull(), "required.field", F.concat(at, F.lit(f".{f}"))) for f in ("predicate", "object", "evidence")]
    receipt = lambda m, at: [*[_issue(_blank(m[f]), "model.receipt", F.concat(at, F.lit(f".model.{f}"))) for f in ("name", "version")], _issue(~is_digest(m["input_sha256"]), "model.receipt", F.concat(at, F.lit(".model.input_sha256")))]

    def proof(x: Column, at: Column) -> list[Column]:
        used = x["model"].isNotNull()
        return [*[_issue(x[f].isNull(), "required.field", F.concat(at, F.lit(f".{f}"))) for f in ("kind", "locator", "inference")], _issue(used & ~F.coalesce(x["inference"], F.lit(False)), "evidence.model_not_inference", at), *[F.when(used & x["inference"], i) for i in receipt(x["model"], at)]]

    return F.concat(_each(F.col("_r.contributions"), F.lit("$.contributions"), contribution), _each(F.col("_r.relationships"), F.lit("$.relationships"), relation), _each(F.col("_r.evidence"), F.lit("$.evidence"), proof))


def lane_issues(records: DataFrame, raw: str, lane: str) -> DataFrame:
    """Adds `issues` (code, path) of records given as JSON text, by the rules of `software` or `creators`.

    A missing field and a null one are the same. Keys are forbidden whatever their case. A text that is no object has the one
    issue `record.object`; a null one too. Other columns stay; an empty table gives an empty one.
    """
    if lane not in ("software", "creators"):
        raise ValueError(f"no such lane: {lane}")
    own, forbidden = (_software, SOFTWARE_FORBIDDEN) if lane == "software" else (_creators, CREATOR_FORBIDDEN)
    source, subject, root = F.col("_r.source"), F.col("_r.subject"), F.lit("$")
    at = lambda *p: F.lit(".".join(("$", *p)))
    shared = [
        _issue(~F.col("_r.envelope_version").eqNullSafe(VERSION), "envelope.version", at("envelope_version")), *[_issue(F.col(f"_r.{f}").isNull(), "required.field", at(f)) for f in ("source", "subject", "identifiers", "contributions", "relationships", "evidence")],
        *[i for i in _required(source, at("source"), "source_id", "snapshot_id", "record_native_id", "terms_revision")], *_times(source, at("source"), "observed_at", "retrieved_at"), _issue(~F.coalesce(source["rights_state"].isin(*RIGHTS), F.lit(False)), "source.rights_state", at("source", "rights_state")),
        _issue(~is_digest(source["payload_sha256"]), "format.sha256", at("source", "payload_sha256")), _issue(~F.coalesce(subject["kind"].isin(*SUBJECTS), F.lit(False)), "subject.kind", at("subject", "kind")), _issue(_blank(subject["source_native_id"]), "required.text", at("subject", "source_native_id")),
        _issue(subject["label"].isNull(), "required.text", at("subject", "label")), _issue(subject["attributes"].isNull(), "required.field", at("subject", "attributes")), _issue(_blank(F.col("_r.raw_pointer")), "required.text", at("raw_pointer")),
        _issue(F.exists("_keys", lambda k: k.isin(*forbidden)), "identity.canonical_id_forbidden", root),
    ]
    nested = F.flatten(F.transform(F.col("_r.contributions"), lambda x, i: _identifiers(x["agent"]["identifiers"], F.concat(F.lit("$.contributions["), i.cast("string"), F.lit("].agent.identifiers")), lane)))
    found = F.concat(F.array_compact(F.array(*shared)), _identifiers(F.col("_r.identifiers"), at("identifiers"), lane), F.coalesce(nested, F.array().cast(ISSUE)), own(root))
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT"), F.lit(False))
    none = F.array(F.struct(F.lit("record.object").alias("code"), root.alias("path")))
    kept = [c for c in records.columns if c != "issues"]
    parsed = records.select(*kept, F.from_json(raw, RECORD).alias("_r"), keys_at_any_depth(F.col(raw)).alias("_keys"))
    return parsed.select(*kept, F.when(whole, F.array_distinct(found)).otherwise(none).alias("issues"))


def kept_attributes(attributes: Column, keep: Iterable[str]) -> Column:
    """A map of attributes with only those that a source's terms allow."""
    allowed = list(keep)
    return F.map_filter(attributes, lambda k, _: k.isin(*allowed) if allowed else F.lit(False))


def scheme_contradictions(assignments: DataFrame, schemes: DataFrame) -> DataFrame:
    """Assignments (scheme_id, uniqueness, stability) that say more of a value than its scheme's definition does: unique where the
    scheme is neither unique nor conditional, stable where it is neither stable nor unknown. An unknown scheme contradicts nothing."""
    rules = schemes.select("scheme_id", F.col("uniqueness_class").alias("_unique"), F.col("mutability_class").alias("_mutable"))
    bad = ((F.col("uniqueness") == "unique") & ~F.col("_unique").isin("unique", "conditional")) | ((F.col("stability") == "stable") & ~F.col("_mutable").isin("stable", "unknown"))
    return assignments.join(rules, "scheme_id").filter(bad).drop("_unique", "_mutable")


def unfit_schemes(schemes: DataFrame) -> DataFrame:
    """Schemes that may decide by themselves though their values aren't both unique and stable."""
    return schemes.filter(F.col("auto_resolution_eligible") & ~((F.col("uniqueness_class") == "unique") & (F.col("mutability_class") == "stable")))


def wrong_kind(rows: DataFrame, key: str, entities: DataFrame, kind: str = "work") -> DataFrame:
    """Rows of a subtype whose entity (entity_id, entity_kind) is of another kind."""
    other = entities.filter(F.col("entity_kind") != kind).select(F.col("entity_id").alias(key))
    return rows.join(other, key, "left_semi")


def severity_counts(risks: DataFrame) -> DataFrame:
    return risks.groupBy("severity").agg(F.count("*").alias("n"))


def release_gate(lanes_valid: bool, fixture: DataFrame, risks: DataFrame, runtime: DataFrame) -> DataFrame:
    """One row: a release may go if the lanes are valid, no checked record (issues) has an issue, no risk (severity) is P0, and each
    runtime source (status) is available."""
    broken = fixture.agg(F.count_if(F.size("issues") > 0).alias("invalid_records"))
    blocking = risks.agg(F.count_if(F.col("severity") == "P0").alias("blocking_risk_count"))
    failed = runtime.agg(F.count_if(~F.col("status").eqNullSafe("available")).alias("runtime_failure_count"))
    row = broken.crossJoin(blocking).crossJoin(failed)  # one row each
    return row.withColumn("valid", F.lit(lanes_valid) & (F.col("invalid_records") == 0) & (F.col("blocking_risk_count") == 0) & (F.col("runtime_failure_count") == 0))
