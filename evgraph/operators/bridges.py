"""Bridges between sources, cohorts balanced by source, and metrics over observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import stable_id
from ..functions.urls import normalised_url

# Schemes that authorities give, that link, and that belong to one source.
AUTHORITY = ("orcid", "viaf", "isni", "wikidata")
LINKS = ("same_as_url", "official_website")
ACCOUNTS = ("github_account_id", "youtube_channel_id", "podcast_index_person_id", "openreview_profile_id", "open_library_author_id", "openalex_author_id")


def bridges(identifiers: DataFrame) -> DataFrame:
    """Candidates between sources, from identifiers that are the same in two or more of them.

    identifiers: source_id, native_id, scheme, value, stability, uniqueness. An authority's identifier is a strong signal, a link is
    for review only, and an account of one source that stands in another is a conflict.
    """
    scheme = F.lower("scheme")
    strong = scheme.isin(*AUTHORITY) & (F.col("stability") == "stable") & (F.col("uniqueness") == "unique")
    kind = F.when(strong, "shared_authority_identifier").when(scheme.isin(*LINKS), "shared_explicit_link").when(scheme.isin(*ACCOUNTS), "source_scope_collision")
    value = F.trim("value")
    keyed = identifiers.withColumn("signal", kind).filter("signal IS NOT NULL").select(
        "signal", F.when(F.col("signal") == "shared_explicit_link", "same_as_url").otherwise(scheme).alias("scheme"),
        F.when(F.col("signal") == "shared_explicit_link", normalised_url(value)).when(F.col("signal") == "shared_authority_identifier", F.lower(value)).otherwise(value).alias("value"), "source_id", "native_id",
    )
    each = keyed.groupBy("signal", "scheme", "value", "source_id", "native_id").agg(F.count("*").alias("receipts"))
    found = each.groupBy("signal", "scheme", "value").agg(F.count_distinct("source_id").alias("sources"), F.sum("receipts").alias("receipts"), F.array_sort(F.collect_list(F.concat_ws(":", "source_id", "native_id"))).alias("subjects")).filter("sources >= 2")
    strength = F.when(F.col("signal") == "shared_authority_identifier", "strong").when(F.col("signal") == "shared_explicit_link", "review_only").otherwise("invalid")
    status = F.when(F.col("signal") == "source_scope_collision", "conflicted").otherwise("proposed")
    return found.select(stable_id("bridge", F.col("signal"), F.col("scheme"), F.col("value"), length=20).alias("candidate_id"), "signal", "scheme", "value", status.alias("status"), strength.alias("strength"), F.lit(False).alias("automatic_acceptance"), "sources", "receipts", "subjects")


def reviewed_precision(reviews: DataFrame, reviewed: Column, accepted: Column, same: Column) -> DataFrame:
    """One row: reviewed, accepted, true and false positives, precision (null if nothing was accepted)."""
    yes = reviewed & accepted
    n, tp = F.count_if(yes), F.count_if(yes & same)
    return reviews.agg(F.count_if(reviewed).alias("reviewed_candidates"), n.alias("accepted_candidates"), tp.alias("true_positive"), (n - tp).alias("false_positive"), F.try_divide(tp, n).alias("precision"))


def cohort(seeds: DataFrame, target: int, targets: dict[str, int] | None = None) -> DataFrame:
    """A cohort of `target` seeds (seed_id, source_id): first each source's own target, then round-robin over all sources.

    Within a source seeds go by a digest; `place` numbers the chosen ones.
    """
    own = Window.partitionBy("source_id").orderBy("digest", "seed_id")
    caps = targets or {}
    want = F.coalesce(F.create_map(*[x for k, v in caps.items() for x in (F.lit(k), F.lit(v))])[F.col("source_id")], F.lit(0)) if caps else F.lit(0)
    ranked = seeds.withColumn("digest", F.sha2(F.concat_ws("|", "source_id", "seed_id"), 256)).withColumn("n", F.row_number().over(own)).withColumn("first", F.col("n") <= want)
    # a source's rows beyond its target start anew in the rounds; only ranks up to the target can be chosen
    ordered = ranked.filter(F.col("n") <= target).withColumn("round", F.when(F.col("first"), F.lit(0)).otherwise(F.col("n") - want))
    # by source where a target holds, by round and source elsewhere: a sort and a limit, no window over all rows
    chosen = ordered.orderBy(F.desc("first"), F.when(F.col("first"), F.col("source_id")), "round", "source_id", "n").limit(target)
    return chosen.select("seed_id", "source_id", "first", "round", "n")


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(part * 100.0, whole), 2), F.lit(0.0))


def pilot_metrics(envelopes: DataFrame) -> DataFrame:
    """One row of counts over envelopes (contracts.ENVELOPE), in one pass."""
    stable = F.filter("identifiers", lambda x: (x["stability"] == "stable") & (x["uniqueness"] == "unique"))
    return envelopes.agg(
        F.count("*").alias("records"), F.count_distinct("source.source_id").alias("sources"), F.sum(F.size("contributions")).alias("contribution_edges"), F.sum(F.size("relationships")).alias("relationships"), F.sum(F.size("identifiers")).alias("identifiers"),
        F.count_if(F.size(stable) > 0).alias("with_stable_id"), percent(F.count_if(F.size(stable) > 0), F.count("*")).alias("stable_coverage_pct"), F.count_if(F.col("subject.kind") == "work").alias("works"),
    )


def stable_ids(envelopes: DataFrame) -> DataFrame:
    """Distinct stable unique identifiers of all subjects."""
    return envelopes.select(F.explode("identifiers").alias("i")).filter("i.stability = 'stable' AND i.uniqueness = 'unique'").select("i.scheme", "i.value").distinct()


def several_values(frame: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value, and the values."""
    return frame.filter(F.col(value).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("values")).filter(F.size("values") > 1)


def overlaps(owned: DataFrame) -> DataFrame:
    """Pairs of owners (owner, path) one of whose paths lies in another's, by joining each path's own prefixes."""
    norm = owned.select("owner", F.regexp_replace("path", r"/?(?:\*\*?)?$", "").alias("path"))
    parts = F.split("path", "/")
    inner = norm.withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    a, b = norm.alias("a"), inner.alias("b")
    return a.join(b, (F.col("a.path") == F.col("b.prefix")) & (F.col("a.owner") != F.col("b.owner"))).select(F.col("a.owner").alias("outer_owner"), F.col("a.path").alias("outer_path"), F.col("b.owner").alias("inner_owner"), F.col("b.path").alias("inner_path")).distinct()


def merge_risk(changes: DataFrame) -> DataFrame:
    """Paths that several requests (request, path) change, with a severity: contracts and schemas before others."""
    shared = changes.groupBy("path").agg(F.array_sort(F.collect_set("request")).alias("requests")).filter(F.size("requests") > 1)
    return shared.withColumn("severity", F.when(F.lower("path").rlike("contract|schema|ddl"), "P0").when(F.lower("path").rlike("^sources?/|identity"), "P1").otherwise("P2"))
