"""Metrics of a pilot over envelopes (contracts.ENVELOPE): counters by key, and one row of totals for each lane."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bridges import bridges, percent, several_values

# Sources whose own account ids are no receipt of another platform, and predicates that tell of a change in time.
CODE_HOSTS = ("github_rest", "gh_archive")
CHANGES = ("renamed_from", "transferred_from")


def _attribute(name: str) -> Column:
    return F.get_json_object("subject.attributes", f"$.{name}")


def _true(name: str) -> Column:
    """Whether an attribute is there and says yes."""
    value = F.lower(_attribute(name))
    return F.coalesce(~value.isin("", "false", "0", "null", "[]", "{}"), F.lit(False))


def counters(envelopes: DataFrame) -> DataFrame:
    """(metric, key, n): records by source, kind and rights, works by type, contributions by role, relationships by predicate and
    identifiers by scheme. One shuffle of partial counts for all of them."""
    one = lambda metric, key, default: F.struct(F.lit(metric).alias("metric"), F.coalesce(key.cast("string"), F.lit(default)).alias("key"))
    each = lambda items, metric, field: F.coalesce(F.transform(items, lambda x: one(metric, x[field], "unspecified")), F.array().cast("array<struct<metric:string,key:string>>"))
    record = F.array(one("records_by_source", F.col("source.source_id"), "unknown"), one("subjects_by_kind", F.col("subject.kind"), "unknown"), one("rights_states", F.col("source.rights_state"), "unknown"), F.when(F.col("subject.kind") == "work", one("works_by_type", _attribute("work_type"), "unspecified")))
    all_ = F.concat(F.array_compact(record), each("contributions", "contribution_roles", "role"), each("relationships", "relationship_types", "predicate"), each("identifiers", "identifier_schemes", "scheme"))
    return envelopes.select(F.explode(all_).alias("c")).groupBy("c.metric", "c.key").agg(F.count("*").alias("n"))


def license_conflicts(envelopes: DataFrame) -> DataFrame:
    """Packages for which sources give several licences, and these."""
    rows = envelopes.filter(_attribute("work_type") == "software_package").select(F.col("subject.source_native_id").alias("subject"), F.nullif(_attribute("license"), F.lit("")).alias("license"))
    return several_values(rows, "subject", "license")


def software_summary(envelopes: DataFrame) -> DataFrame:
    """One row of totals of the software lane."""
    work = F.col("subject.kind") == "work"
    clear = F.coalesce((F.col("source.terms_revision") != "") & ~F.col("source.rights_state").isin("pending", "restricted"), F.lit(False))
    kind = F.coalesce(_attribute("work_type"), F.lit(""))
    total = lambda c: F.coalesce(F.sum(F.size(F.coalesce(c, F.array()))), F.lit(0)).cast("long")
    licensed, known, records = F.count_if(work & F.coalesce(_attribute("license") != "", F.lit(False))), F.count_if(clear), F.count("*")
    of_metrics = F.coalesce(F.json_array_length(_attribute("metrics")), F.lit(0))
    main = envelopes.agg(
        records.alias("records"), F.count_distinct("source.source_id").alias("sources"), total(F.col("contributions")).alias("contribution_edges"), total(F.col("relationships")).alias("relationship_edges"), total(F.col("identifiers")).alias("identifier_observations"),
        F.count_if(F.col("subject.kind") == "event").alias("temporal_events"), total(F.filter("relationships", lambda r: r["predicate"].isin(*CHANGES))).alias("temporal_relationships"), F.coalesce(F.sum(of_metrics), F.lit(0)).cast("long").alias("metric_observations"),
        F.count_if(work & (_true("archived") | kind.startswith("software_archive_"))).alias("archived_works"), F.count_if(work & (_attribute("abandoned") == "true")).alias("abandoned_works"), F.count_if(work).alias("works"), licensed.alias("licensed_works"), percent(licensed, F.count_if(work)).alias("license_percent"),
        known.alias("rights_known"), percent(known, records).alias("rights_percent"),
    )
    each = envelopes.select(F.col("source.source_id").alias("s"), F.col("subject.source_native_id").alias("n"), F.explode("identifiers").alias("i"))
    stable = (F.col("i.stability") == "stable") & (F.col("i.uniqueness") == "unique")
    across = (F.col("i.scheme") == "github_account_id") & ~F.col("s").isin(*CODE_HOSTS)
    ids = each.agg(F.count_distinct(F.when(stable, F.struct("i.scheme", "i.value"))).alias("stable_unique_identifiers"), F.count_distinct(F.when(across, F.struct("s", "i.value", "n", "i.evidence"))).alias("cross_platform_receipts"))
    return main.crossJoin(ids).crossJoin(license_conflicts(envelopes).agg(F.count("*").alias("source_conflicts")))  # one row each


def creator_summary(envelopes: DataFrame) -> DataFrame:
    """One row of totals of the creators lane. Candidates are hypotheses for review; none is accepted here."""
    subject = F.struct(F.col("source.source_id").alias("s"), F.col("subject.source_native_id").alias("n"))
    agents = F.filter(F.transform("contributions", lambda c: F.struct(F.col("source.source_id").alias("s"), c["agent"]["source_native_id"].alias("n"))), lambda x: F.coalesce(x["n"] != "", F.lit(False)))
    main = envelopes.agg(
        F.count("*").alias("records"), F.count_if(F.col("subject.kind").isin("work", "event", "venue")).alias("works_and_appearances"), F.coalesce(F.sum(F.size("contributions")), F.lit(0)).cast("long").alias("contribution_edges"),
        F.count_if(F.col("source.rights_state") == "pending").alias("rights_pending"), F.count_distinct(subject).alias("unique_source_subjects"),
    )
    seen = envelopes.select(F.explode(F.concat(F.array(subject), F.coalesce(agents, F.array().cast("array<struct<s:string,n:string>>")))).alias("e")).agg(F.count_distinct("e").alias("unique_observed_entities"))
    ids = envelopes.select(F.col("source.source_id").alias("source_id"), F.col("subject.source_native_id").alias("native_id"), F.explode("identifiers").alias("i")).select("source_id", "native_id", "i.scheme", "i.value", "i.stability", "i.uniqueness")
    found = bridges(ids)
    usable = F.col("strength").isin("strong", "review_only")
    signals = found.agg(F.count("*").alias("candidates"), F.count_if(F.col("strength") == "strong").alias("strong"), F.count_if(F.col("strength") == "review_only").alias("review_only"), F.avg(F.when(usable, F.col("sources"))).alias("mean_sources"))
    touched = found.filter(usable).select(F.explode("subjects").alias("x")).agg(F.count_distinct("x").alias("subjects_with_bridge"))
    row = main.crossJoin(seen).crossJoin(signals).crossJoin(touched)  # one row each
    return row.withColumn("bridge_rate", F.try_divide("subjects_with_bridge", "unique_observed_entities"))
