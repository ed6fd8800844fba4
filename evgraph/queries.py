"""Queries over the driver's tables, each with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import authors, dates, ids, text, urls
from .functions.jsonx import digest
from .operators import bridges, contracts, graph, identity, lanes, metrics, rollups, search
from .operators.components import clusters
from .plans.testbed import Testbed, sql
from .sources import adapters, records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None, *views: str):
    """Registers a function of a testbed under its name, with its SQL."""

    def add(f: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Testbed(spark, sf_dir))
        if oracle is not None:
            ORACLE[f.__name__] = sql(oracle, *views)
        return f

    return add


big = lambda c: F.col(c).cast("long").alias(c) if isinstance(c, str) else c.cast("long")

# ---------------------------------------------------------------- scans


@query("SELECT 'person' AS \"table\", count(*) AS rows FROM person UNION ALL SELECT 'person_content', count(*) FROM content UNION ALL SELECT 'person_topic', count(*) FROM topics", "person", "content", "topics")
def s21_inventory(t: Testbed) -> DataFrame:
    from .catalog import Catalog

    found = Catalog(t.spark, {("people", "person"): t.person(), ("people", "person_content"): t.content(), ("people", "person_topic"): t.topics()}).inventory()
    return found.select("table", "rows")


@query("SELECT person_id, name, kind, state, merged_into, birth_year, death_year, origin FROM person", "person")
def s04_person_scan(t: Testbed) -> DataFrame:
    return t.person().drop("rank_score")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def s14_keep_first(t: Testbed) -> DataFrame:
    orders = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return records.keep_first(orders.limit(0), orders, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).drop("o_orderdate")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def s15_keep_last(t: Testbed) -> DataFrame:
    orders = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return records.keep_last(orders.limit(0), orders, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).drop("o_orderdate")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'human' ELSE 'unknown' END AS kind FROM customer")
def s16_coalesce_merge(t: Testbed) -> DataFrame:
    old = t.table("customer").select("c_custkey", "c_name", F.lit("unknown").alias("kind"))
    new = t.table("customer").filter("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("c_name"), F.when(F.col("c_custkey") % 2 == 0, "human").otherwise("unknown").alias("kind"))
    return records.merge(old, new, ["c_custkey"], kind=records.keep_known("kind"))


# ---------------------------------------------------------------- filters


@query("SELECT person_id, name FROM person WHERE person_id IN ('c:1', 'c:2', 's:1', 'x:9')", "person")
def p01_in_list(t: Testbed) -> DataFrame:
    return t.person().filter(F.col("person_id").isin("c:1", "c:2", "s:1", "x:9")).select("person_id", "name")


@query("SELECT person_id, CASE WHEN state = 'merged' THEN state WHEN person_id IN (SELECT person_id FROM content) THEN 'linked' ELSE 'tracked' END AS state FROM person", "person", "content")
def p03_tracked(t: Testbed) -> DataFrame:
    return rollups.mark_tracked(t.person(), t.content()).select("person_id", "state")


@query("SELECT DISTINCT p_name FROM part WHERE lower(p_name) LIKE '%e s%' OR contains(lower(p_name), 'ar')")
def p05_contains(t: Testbed) -> DataFrame:
    part = t.table("part").select("p_name")
    return search.containing(part, "p_name", "E S").unionByName(search.containing(part, "p_name", "AR")).distinct()


@query("SELECT person_id FROM person WHERE person_id LIKE 's:1%'", "person")
def p06_prefix(t: Testbed) -> DataFrame:
    return t.person().filter(F.startswith("person_id", F.lit("s:1"))).select("person_id")


@query("SELECT c_custkey FROM customer WHERE coalesce(c_acctbal, 0) >= 5000 AND c_mktsegment <> ''")
def p09_threshold(t: Testbed) -> DataFrame:
    return t.table("customer").filter((F.coalesce("c_acctbal", F.lit(0)) >= 5000) & (F.col("c_mktsegment") != "")).select("c_custkey")


@query(r"SELECT doc_id FROM documents WHERE contains(' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{M}]+'), lambda w: w <> ''), ' ') || ' ', ' of the ')")
def p11_phrase(t: Testbed) -> DataFrame:
    return search.phrase(t.table("documents"), F.col("text"), "of the").select("doc_id")


@query("SELECT event_id FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM events) WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' AND (until IS NULL OR until > TIMESTAMP '2024-01-15 00:00:00')")
def p15_as_of(t: Testbed) -> DataFrame:
    from pyspark.sql import Window

    rows = t.observations().withColumn("until", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return rows.filter(dates.as_of(F.col("ts"), F.col("until"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))).select("event_id")


@query("SELECT a.person_id AS a, b.person_id AS b FROM person a JOIN person b ON a.person_id = 'c:1' AND b.origin = 'customer' AND NOT coalesce(abs(a.birth_year - b.birth_year) > 2, false) AND NOT coalesce(abs(a.death_year - b.death_year) > 2, false)", "person")
def p17_years_compatible(t: Testbed) -> DataFrame:
    person = t.person()
    one = person.filter("person_id = 'c:1'").select(F.col("person_id").alias("a"), F.col("birth_year").alias("ba"), F.col("death_year").alias("da"))
    return person.filter("origin = 'customer'").join(F.broadcast(one), dates.years_compatible(F.col("ba"), F.col("da"), F.col("birth_year"), F.col("death_year"))).select("a", F.col("person_id").alias("b"))  # one row


@query(
    """SELECT c_custkey, scheme, CASE WHEN v = '' OR lower(v) IN ('none','null','nil','n/a','na','unknown','undefined','ghost','deleted','deleted-user','anonymous','unclaimed','placeholder') THEN true
 WHEN scheme = 'github_id' AND (v IN ('0','-1','-99','99999999') OR TRY_CAST(v AS DECIMAL(38,0)) <= 0) THEN true WHEN scheme = 'orcid' AND regexp_full_match(v, '[0X-]+') THEN true WHEN scheme = 'wikidata' AND lower(v) IN ('q0','q') THEN true ELSE false END AS absent
 FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'github_id' WHEN 1 THEN 'orcid' WHEN 2 THEN 'wikidata' ELSE 'viaf' END AS scheme, CASE c_custkey % 7 WHEN 0 THEN '0' WHEN 1 THEN 'Ghost' WHEN 2 THEN '0000-0000' WHEN 3 THEN 'Q0' WHEN 4 THEN '-5' ELSE CAST(c_custkey AS VARCHAR) END AS v FROM customer)"""
)
def p18_absent_values(t: Testbed) -> DataFrame:
    rows = t.table("customer").selectExpr("c_custkey", "CASE c_custkey % 4 WHEN 0 THEN 'github_id' WHEN 1 THEN 'orcid' WHEN 2 THEN 'wikidata' ELSE 'viaf' END AS scheme", "CASE c_custkey % 7 WHEN 0 THEN '0' WHEN 1 THEN 'Ghost' WHEN 2 THEN '0000-0000' WHEN 3 THEN 'Q0' WHEN 4 THEN '-5' ELSE string(c_custkey) END AS v")
    return rows.select("c_custkey", "scheme", ids.absent(F.col("scheme"), F.col("v")).alias("absent"))


# ---------------------------------------------------------------- joins


@query("SELECT c.person_id, p.name, count(*) AS works FROM content c JOIN person p USING (person_id) GROUP BY c.person_id, p.name", "content", "person")
def j01_join_works(t: Testbed) -> DataFrame:
    return t.content().groupBy("person_id").agg(F.count("*").alias("works")).join(t.person().select("person_id", "name"), "person_id")


@query(
    """SELECT person_id, count(DISTINCT domain || ':' || content_ref) AS shared FROM content WHERE (domain, content_ref) IN (SELECT (domain, content_ref) FROM content WHERE person_id IN ('c:1', 's:3')) AND person_id NOT IN ('c:1', 's:3') GROUP BY person_id""",
    "content",
)
def j02_co_contributors(t: Testbed) -> DataFrame:
    return graph.co_contributors(t.content(), t.spark.createDataFrame([("c:1",), ("s:3",)], "person_id string"))


@query(
    """SELECT a.person_id, a.name, b.person_id AS contemporary_id, b.name AS contemporary_name, greatest(a.birth_year, b.birth_year) AS overlap_start, least(coalesce(a.death_year, a.birth_year + 80), coalesce(b.death_year, b.birth_year + 80)) AS overlap_end
 FROM person a JOIN person b ON a.person_id <> b.person_id AND greatest(a.birth_year, b.birth_year) < least(coalesce(a.death_year, a.birth_year + 80), coalesce(b.death_year, b.birth_year + 80))
 WHERE a.state <> 'merged' AND b.state <> 'merged' AND a.person_id = 'c:2' AND a.birth_year IS NOT NULL AND b.birth_year IS NOT NULL""",
    "person",
)
def j04_contemporaries(t: Testbed) -> DataFrame:
    return graph.contemporaries(t.person(), t.spark.createDataFrame([("c:2",)], "person_id string"), bucket=10)


@query("SELECT person_id, count(content_ref) AS n FROM person LEFT JOIN content USING (person_id) GROUP BY person_id", "person", "content")
def j05_left_works(t: Testbed) -> DataFrame:
    return t.person().select("person_id").join(t.content().groupBy("person_id").agg(F.count("*").alias("k")), "person_id", "left").select("person_id", F.coalesce("k", F.lit(0)).alias("n"))


@query("SELECT person_id, p_type AS topic, CAST(count(*) AS DOUBLE) AS weight FROM content JOIN part ON TRY_CAST(content_ref AS BIGINT) = p_partkey WHERE domain = 'part' GROUP BY person_id, p_type", "content")
def j06_cast_key(t: Testbed) -> DataFrame:
    works = t.content().filter("domain = 'part'").withColumn("domain", F.lit("book"))
    return rollups.subjects(works, t.table("part").select(F.col("p_partkey").alias("gid"), F.col("p_type").alias("subject")))


@query("SELECT n_name, coalesce(max(person_id), 'new:' || lower(n_name)) AS person_id FROM nation LEFT JOIN (SELECT 'n:' || n_nationkey AS person_id, lower(n_name) AS k FROM nation WHERE n_nationkey % 2 = 0) ON k = lower(n_name) GROUP BY n_name")
def j08_folded_key(t: Testbed) -> DataFrame:
    nation = t.table("nation")
    known = nation.filter("n_nationkey % 2 = 0").select(F.concat(F.lit("n:"), "n_nationkey").alias("person_id"), F.lower("n_name").alias("k"))
    return nation.join(known, F.lower("n_name") == F.col("k"), "left").groupBy("n_name").agg(F.coalesce(F.max("person_id"), F.concat(F.lit("new:"), F.lower("n_name"))).alias("person_id"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def j10_semi(t: Testbed) -> DataFrame:
    return t.table("customer").join(t.table("orders").filter("o_totalprice > 200000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def j11_anti(t: Testbed) -> DataFrame:
    return t.table("customer").join(t.table("orders").filter("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT a.entity_id AS a, b.entity_id AS b FROM entities a JOIN entities b ON a.digest = b.digest AND a.entity_id < b.entity_id", "entities")
def j12_block_pairs(t: Testbed) -> DataFrame:
    return identity.block_pairs(t.entities(), ["digest"]).select("a", "b")


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def j21_truth_labels(t: Testbed) -> DataFrame:
    return t.table("documents").select("doc_id").join(t.table("labels"), "doc_id", "left").select("doc_id", "quality", "toxic")


# ---------------------------------------------------------------- aggregations


@query("SELECT domain, count(*) AS n FROM content GROUP BY domain", "content")
def a02_by_domain(t: Testbed) -> DataFrame:
    return t.content().groupBy("domain").agg(F.count("*").alias("n"))


@query("SELECT state, count(*) AS n FROM person GROUP BY state", "person")
def a03_by_state(t: Testbed) -> DataFrame:
    return t.person().groupBy("state").agg(F.count("*").alias("n"))


LAYERS = """SELECT p.person_id, p.name, p.kind, p.state, p.origin, count(DISTINCT domain) AS domain_count, count(content_ref) AS content_count, string_agg(DISTINCT domain, ',' ORDER BY domain) AS domains
 FROM person p LEFT JOIN content c USING (person_id) WHERE p.state <> 'merged' GROUP BY p.person_id, p.name, p.kind, p.state, p.origin"""


@query(LAYERS, "person", "content")
def a04_person_layers(t: Testbed) -> DataFrame:
    return graph.layers(t.person(), t.content())


@query("SELECT count(*) AS n FROM (SELECT person_id FROM person JOIN content USING (person_id) WHERE state <> 'merged' GROUP BY person_id HAVING count(DISTINCT domain) >= 2)", "person", "content")
def a05_multi_domain(t: Testbed) -> DataFrame:
    return graph.layers(t.person(), t.content()).filter("domain_count >= 2").agg(F.count("*").alias("n"))


@query("SELECT * FROM topics", "topics")
def a06_topic_weight(t: Testbed) -> DataFrame:
    return t.topics()


@query("SELECT person_id, count(DISTINCT scheme) AS schemes, min(topic) AS first FROM topics GROUP BY person_id", "topics")
def a07_distinct_schemes(t: Testbed) -> DataFrame:
    return t.topics().groupBy("person_id").agg(F.count_distinct("scheme").alias("schemes"), F.min("topic").alias("first"))


@query("SELECT user_id, min(ts) AS first_seen FROM events GROUP BY user_id")
def a08_first_observed(t: Testbed) -> DataFrame:
    return t.observations().groupBy("user_id").agg(F.min("ts").alias("first_seen"))


@query("SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY o_custkey")
def a10_owner_rollup(t: Testbed) -> DataFrame:
    return t.table("orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


@query('SELECT l_suppkey AS "group", CAST(sum(n) AS BIGINT) AS rated, round(sum(coalesce(m, 0) * n) / sum(n), 6) AS value FROM (SELECT l_suppkey, l_partkey, count(*) AS n, avg(l_quantity) AS m FROM lineitem GROUP BY l_suppkey, l_partkey) GROUP BY l_suppkey')
def a11_weighted_mean(t: Testbed) -> DataFrame:
    rated = t.table("lineitem").withColumn("item", F.concat_ws("/", "l_suppkey", "l_partkey"))
    found = rollups.weighted_mean(rated, "item", F.substring_index("item", "/", 1).cast("long"), "l_quantity")
    return found.select("group", "rated", F.round("value", 6).alias("value"))


@query("SELECT digest, count(*) AS n, string_agg(DISTINCT origin, ',' ORDER BY origin) AS origins FROM entities GROUP BY digest HAVING count(DISTINCT origin) > 1", "entities")
def a16_several_values(t: Testbed) -> DataFrame:
    each = bridges.several_values(t.entities(), "digest", "origin")
    return t.entities().groupBy("digest").agg(F.count("*").alias("n")).join(each, "digest").select("digest", "n", F.array_join("values", ",").alias("origins"))


@query(
    "SELECT count(*) FILTER (quality IS NOT NULL) AS reviewed_candidates, count(*) FILTER (quality = 1) AS accepted_candidates, count(*) FILTER (quality = 1 AND toxic = 0) AS true_positive, count(*) FILTER (quality = 1 AND NOT coalesce(toxic = 0, false)) AS false_positive, round(count(*) FILTER (quality = 1 AND toxic = 0) / count(*) FILTER (quality = 1), 9) AS precision FROM labels"
)
def a21_reviewed_precision(t: Testbed) -> DataFrame:
    found = bridges.reviewed_precision(t.table("labels"), F.col("quality").isNotNull(), F.col("quality") == 1, F.col("toxic") == 0)
    return found.withColumn("precision", F.round("precision", 9))


@query("SELECT lang, count(*) AS n, count(DISTINCT source) AS sources, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def a20_source_metrics(t: Testbed) -> DataFrame:
    return t.table("documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.sum("n_chars").alias("chars"))


# ---------------------------------------------------------------- windows and order


@query("SELECT person_id, topic, weight FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY weight DESC, topic) AS n FROM topics WHERE scheme = 'brand') WHERE n <= 3", "topics")
def w02_top_topics(t: Testbed) -> DataFrame:
    return graph.top(t.topics().filter("scheme = 'brand'"), ["person_id"], [F.desc("weight"), F.asc("topic")], 3).select("person_id", "topic", "weight")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id")
def w04_latest_status(t: Testbed) -> DataFrame:
    return t.observations().groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))


@query("SELECT digest, min(entity_id) AS canonical FROM entities GROUP BY digest", "entities")
def w06_canonical(t: Testbed) -> DataFrame:
    return t.entities().groupBy("digest").agg(F.min_by("entity_id", F.struct(identity.origin_rank(F.col("origin")), "entity_id")).alias("canonical"))


@query(
    """SELECT account, alias, valid_from, lead(valid_from) OVER (PARTITION BY account ORDER BY valid_from, alias) AS valid_to FROM (SELECT user_id AS account, event_type AS alias, ts AS valid_from, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS b FROM events) WHERE b IS NULL OR b <> alias"""
)
def w07_alias_history(t: Testbed) -> DataFrame:
    return records.alias_history(t.observations().select(F.col("user_id").alias("account"), F.col("event_type").alias("alias"), F.col("ts").alias("observed_at")))


@query("SELECT seed_id, source_id, n FROM (SELECT doc_id AS seed_id, source AS source_id, row_number() OVER (PARTITION BY source ORDER BY sha256(source || '|' || doc_id), doc_id) AS n FROM documents) ORDER BY n, source_id LIMIT 50")
def w09_cohort(t: Testbed) -> DataFrame:
    return bridges.cohort(t.table("documents").select(F.col("doc_id").alias("seed_id"), F.col("source").alias("source_id")), 50).select("seed_id", "source_id", big("n"))


@query("SELECT domain, content_ref, role FROM content WHERE person_id = 'c:1' ORDER BY domain, content_ref, role LIMIT 20 OFFSET 5", "content")
def o03_paged_works(t: Testbed) -> DataFrame:
    return t.content().filter("person_id = 'c:1'").select("domain", "content_ref", "role").orderBy("domain", "content_ref", "role").offset(5).limit(20)


@query("SELECT person_id, name FROM person ORDER BY name, person_id LIMIT 25", "person")
def o02_alphabetical(t: Testbed) -> DataFrame:
    return t.person().select("person_id", "name").orderBy("name", "person_id").limit(25)


@query("SELECT person_id, rank_score FROM person ORDER BY rank_score DESC, person_id LIMIT 10", "person")
def o06_top_owners(t: Testbed) -> DataFrame:
    return t.person().select("person_id", "rank_score").orderBy(F.desc("rank_score"), "person_id").limit(10)


@query(
    "SELECT person_id, string_agg(field, ',' ORDER BY field) AS missing FROM (SELECT person_id, rank_score, field FROM person, (VALUES ('bio'), ('company'), ('location')) f(field) WHERE NOT (field = 'bio' AND state = 'linked') AND NOT (field = 'company' AND origin = 'supplier')) GROUP BY person_id, rank_score ORDER BY rank_score DESC NULLS LAST, person_id LIMIT 40",
    "person",
)
def o07_enrichment_queue(t: Testbed) -> DataFrame:
    person = t.person()
    seen = person.filter("state = 'linked'").select("person_id", F.lit("bio").alias("field")).unionByName(person.filter("origin = 'supplier'").select("person_id", F.lit("company").alias("field")))
    return rollups.enrichment_queue(person, seen, ["bio", "company", "location"], 40).select("person_id", F.array_join("missing", ",").alias("missing"))


@query("SELECT DISTINCT person_id, content_ref FROM content WHERE role = 'supplier'", "content")
def o13_distinct_edges(t: Testbed) -> DataFrame:
    return t.content().filter("role = 'supplier'").select("person_id", "content_ref").distinct()


# ---------------------------------------------------------------- functions


@query(r"""SELECT c_custkey, array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(n), '\([^)]*\)', ' ', 'g'), '[^\p{L}\p{N}\p{M}]+'), lambda w: w <> '' AND w NOT IN ('sir','dame','lord','lady','baron','baroness','earl','duke','rev','dr','prof','jr','sr','saint','st','mrs','mr','ms')), ' ') AS key
 FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Dr. ' || c_name || ' (the ' || c_mktsegment || ')' WHEN 1 THEN c_name || ', Jr.' ELSE c_name || '  of  ' || c_mktsegment END AS n FROM customer)""")
def f02_name_key(t: Testbed) -> DataFrame:
    rows = t.table("customer").selectExpr("c_custkey", "CASE c_custkey % 3 WHEN 0 THEN 'Dr. ' || c_name || ' (the ' || c_mktsegment || ')' WHEN 1 THEN c_name || ', Jr.' ELSE c_name || '  of  ' || c_mktsegment END AS n")
    return rows.select("c_custkey", text.name_key(F.col("n")).alias("key"))


@query(r"""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN lower(c_name) WHEN 2 THEN 'Q' || c_custkey ELSE 'example.com/u/' || c_custkey END AS value FROM customer""")
def f04_normalised_ids(t: Testbed) -> DataFrame:
    rows = t.table("customer").selectExpr("c_custkey", "CASE c_custkey % 4 WHEN 0 THEN 'github_id' WHEN 1 THEN 'github_login' WHEN 2 THEN 'wikidata' ELSE 'website' END AS s", "CASE c_custkey % 4 WHEN 0 THEN '00' || c_custkey WHEN 1 THEN '@' || c_name WHEN 2 THEN 'http://www.wikidata.org/entity/q' || c_custkey ELSE 'HTTPS://Example.com/u/' || c_custkey || '/' END AS v")
    return rows.select("c_custkey", ids.normalised(F.col("s"), F.col("v")).alias("value"))


@query("SELECT c_custkey, 'Customer' || c_custkey || ', ' || c_mktsegment AS name, CASE WHEN c_custkey % 3 = 1 THEN -(c_custkey % 400 + 1) WHEN c_custkey % 3 = 0 THEN 1500 + c_custkey % 400 END AS birth, CASE WHEN c_custkey % 3 = 1 THEN -(c_custkey % 300 + 1) END AS death, CASE WHEN c_custkey % 2 = 0 THEN 'editor' ELSE 'author' END AS role, false AS corporate FROM customer")
def f06_parsed_authors(t: Testbed) -> DataFrame:
    rows = t.table("customer").selectExpr("c_custkey", "'Customer' || c_custkey || ', ' || c_mktsegment || CASE c_custkey % 3 WHEN 1 THEN ', ' || (c_custkey % 400 + 1) || '? BCE-' || (c_custkey % 300 + 1) || ' BCE' WHEN 0 THEN ', ' || (1500 + c_custkey % 400) || '-' ELSE '' END || CASE WHEN c_custkey % 2 = 0 THEN ' [Editor]' ELSE '' END AS chunk")
    return rows.select("c_custkey", authors.parsed(F.col("chunk")).alias("a")).select("c_custkey", "a.name", big(F.col("a.birth")).alias("birth"), big(F.col("a.death")).alias("death"), "a.role", "a.corporate")


@query("SELECT person_id, CASE WHEN birth_year IS NULL AND death_year IS NULL THEN NULL ELSE coalesce(CAST(birth_year AS VARCHAR), '?') || '-' || coalesce(CAST(death_year AS VARCHAR), '?') END AS lived FROM person", "person")
def f10_life_span(t: Testbed) -> DataFrame:
    return t.person().select("person_id", dates.life_span(F.col("birth_year"), F.col("death_year")).alias("lived"))


@query("""SELECT c_custkey, 'cust:' || substr(sha256('"' || c_name || '"' || chr(31) || '"' || c_mktsegment || '"'), 1, 24) AS id FROM customer""")
def f16_stable_id(t: Testbed) -> DataFrame:
    return t.table("customer").select("c_custkey", ids.stable_id("cust", F.col("c_name"), F.col("c_mktsegment")).alias("id"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def f15_digests(t: Testbed) -> DataFrame:
    return t.table("documents").select("doc_id", digest(F.col("text")).alias("digest"))


URL = r"""SELECT page_id, s || '://' || h || CASE WHEN rtrim(p, '/') = '' THEN '/' ELSE rtrim(p, '/') END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS url FROM (SELECT page_id, lower(regexp_extract(url, '^([^:]+)://', 1)) AS s, lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS h, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS p,
 array_to_string(list_sort(list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')), lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END)), '&') AS q FROM pages)"""


@query(URL)
def f21_normalised_urls(t: Testbed) -> DataFrame:
    return t.table("pages").select("page_id", urls.normalised_url(F.col("url")).alias("url"))


@query("SELECT o_orderkey, 'https://www.gutenberg.org/ebooks/' || o_orderkey || '.txt.utf-8' AS first, CAST(2 AS INTEGER) AS n FROM orders")
def f11_routes(t: Testbed) -> DataFrame:
    r = urls.routes(F.lit("book"), F.col("o_orderkey").cast("string"))
    return t.table("orders").select("o_orderkey", r[0]["url"].alias("first"), F.size(r).alias("n"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def f26_json_props(t: Testbed) -> DataFrame:
    from .functions.jsonx import field

    return t.observations().select("event_id", field(F.col("props"), "$.k", "long").alias("k"))


@query("SELECT n_nationkey, 'pkg:npm/' || n_name || '@1.' || n_nationkey AS purl FROM nation WHERE NOT contains(n_name, ' ')")
def f23_package_urls(t: Testbed) -> DataFrame:
    return t.table("nation").filter("NOT contains(n_name, ' ')").select("n_nationkey", urls.package_url(F.lit("npm"), F.col("n_name"), F.concat(F.lit("1."), F.col("n_nationkey").cast("string"))).alias("purl"))


# ---------------------------------------------------------------- graph and identity

COMPONENTS = """WITH RECURSIVE edges AS (SELECT DISTINCT a.entity_id AS u, b.entity_id AS v FROM entities a JOIN entities b ON (a.digest = b.digest) AND a.entity_id <> b.entity_id),
 reach(id, r) AS (SELECT entity_id, entity_id FROM entities UNION SELECT reach.id, edges.v FROM reach JOIN edges ON reach.r = edges.u) SELECT id, min(r) AS component FROM reach GROUP BY id"""


@query(COMPONENTS, "entities")
def g01_components(t: Testbed) -> DataFrame:
    edges = identity.block_stars(t.entities(), ["digest"])
    return clusters(t.entities().select(F.col("entity_id").alias("id")), edges)


@query("SELECT least(person_id, merged_into) AS u, greatest(person_id, merged_into) AS v, 'legacy_merge' AS grade FROM person WHERE merged_into IS NOT NULL", "person")
def g03_merge_edges(t: Testbed) -> DataFrame:
    claims = t.spark.createDataFrame([], "person_a string, person_b string, status string")
    return identity.merges(t.person(), claims)


@query("SELECT CASE WHEN state = 'merged' THEN least(person_id, merged_into) WHEN person_id IN (SELECT merged_into FROM person) THEN (SELECT min(least(q.person_id, q.merged_into)) FROM person q WHERE q.merged_into = p.person_id) ELSE person_id END AS cluster_id, coalesce(max(CASE WHEN state <> 'merged' THEN person_id END), max(person_id)) AS representative, count(*) AS size FROM person p GROUP BY 1", "person")
def g06_representatives(t: Testbed) -> DataFrame:
    person = t.person()
    edges = identity.merges(person, t.spark.createDataFrame([], "person_a string, person_b string, status string")).select("u", "v")
    members = clusters(person.select(F.col("person_id").alias("id")), edges).select(F.col("id").alias("person_id"), F.col("component").alias("cluster_id"))
    none = t.spark.createDataFrame([], "person_id string, platform string, observed_at string")
    return identity.representatives(members, person, none.select("person_id", "platform"), none.select("person_id", "observed_at")).select("cluster_id", "representative", "size")


@query(
    """SELECT CASE WHEN EXISTS (SELECT 1 FROM content a JOIN content b ON a.domain = b.domain AND a.content_ref = b.content_ref WHERE a.person_id = 'c:1' AND b.person_id = 's:3') THEN 1
 WHEN EXISTS (SELECT 1 FROM content a JOIN content b ON a.domain = b.domain AND a.content_ref = b.content_ref JOIN content c ON b.person_id = c.person_id JOIN content d ON c.domain = d.domain AND c.content_ref = d.content_ref WHERE a.person_id = 'c:1' AND d.person_id = 's:3') THEN 2 ELSE 3 END AS hops""",
    "content",
)
def g11_path_hops(t: Testbed) -> DataFrame:
    one = lambda p: t.spark.createDataFrame([(p,)], "person_id string")
    return graph.path(t.content(), one("c:1"), one("s:3")).groupBy().agg(F.min("hops").alias("hops"))


@query("SELECT person_id, name, topic, scheme, weight FROM topics JOIN person USING (person_id) WHERE scheme = 'brand' AND lower(topic) = 'brand#11'", "topics", "person")
def g15_topic_people(t: Testbed) -> DataFrame:
    return graph.topic_people(t.topics(), t.person(), "BRAND#11", "brand")


@query()
def g16_candidates(t: Testbed) -> DataFrame:
    entities = t.entities().withColumns({"birth_year": F.lit(None).cast("int"), "death_year": F.lit(None).cast("int")})
    found = identity.candidates(entities, t.entities().select("entity_id", F.lit("viaf").alias("scheme"), F.col("digest").alias("value"), F.lit(None).cast("string").alias("valid_to")))
    return found.select("entity_a", "entity_b", "method", "confidence", "auto_eligible", F.array_join("conflicts", ",").alias("conflicts"))


@query()
def g18_batch_accept(t: Testbed) -> DataFrame:
    entities = t.entities().withColumns({"birth_year": F.lit(None).cast("int"), "death_year": F.lit(None).cast("int")})
    numbers = t.entities().select("entity_id", F.lit("viaf").alias("scheme"), F.col("digest").alias("value"), F.lit(None).cast("string").alias("valid_to"))
    found = identity.candidates(entities, numbers, methods=("shared_external_id",)).filter("auto_eligible")  # no other method may be
    log = t.spark.createDataFrame([], "decision_id string, candidate_id string, entity_a long, entity_b long, outcome string, active boolean, seq long")
    return identity.accept(found, log, numbers).select("entity_a", "entity_b", "verdict")


@query("SELECT l_partkey, count(*) AS sources FROM (SELECT DISTINCT l_partkey, l_suppkey % 3 AS s FROM lineitem) GROUP BY l_partkey HAVING count(*) >= 2")
def g24_bridges(t: Testbed) -> DataFrame:
    rows = t.table("lineitem").select((F.col("l_suppkey") % 3).cast("string").alias("source_id"), F.col("l_suppkey").cast("string").alias("native_id"), F.lit("ORCID").alias("scheme"), F.col("l_partkey").cast("string").alias("value"), F.lit("stable").alias("stability"), F.lit("unique").alias("uniqueness"))
    return bridges.bridges(rows).select(F.col("value").cast("long").alias("l_partkey"), "sources")


@query("SELECT DISTINCT p_brand AS outer_owner, p_brand || ' ' || p_type AS inner_owner FROM part")
def g31_ownership_overlaps(t: Testbed) -> DataFrame:
    part = t.table("part")
    owned = part.select(F.col("p_brand").alias("owner"), F.concat("p_brand", F.lit("/**")).alias("path")).unionByName(part.select(F.concat_ws(" ", "p_brand", "p_type").alias("owner"), F.concat_ws("/", "p_brand", "p_type", F.lit("x.py")).alias("path"))).distinct()
    return bridges.overlaps(owned).select("outer_owner", "inner_owner")


@query("SELECT CAST(l_partkey AS VARCHAR) AS path, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def g32_merge_risk(t: Testbed) -> DataFrame:
    changes = t.table("lineitem").select(F.col("l_suppkey").alias("request"), F.col("l_partkey").cast("string").alias("path"))
    return bridges.merge_risk(changes).select("path", F.size("requests").cast("long").alias("n"))


# ---------------------------------------------------------------- observations and constraints

SOURCE = {"source_id": "events", "snapshot_id": "s1", "observed_at": "2024-01-01T00:00:00Z", "retrieved_at": "2024-02-01T00:00:00Z", "terms_revision": "t1", "rights_state": "open_data"}


def event_envelopes(t: Testbed) -> DataFrame:
    user = F.struct(F.col("user_id").alias("id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("login"))
    rows = t.observations().select(F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"), user.alias("actor"), F.struct(F.lit(1).alias("id"), F.lit("repo").alias("name")).alias("repo"))
    return adapters.archive_events(rows, SOURCE)


@query("SELECT CAST(event_id AS VARCHAR) AS record, 'gharchive:event:' || event_id AS subject, event_type AS label, 'github:account:' || user_id AS performer, CAST(2 AS INTEGER) AS relations FROM events")
def e04_event_envelopes(t: Testbed) -> DataFrame:
    e = event_envelopes(t)
    return e.select(F.col("source.record_native_id").alias("record"), F.col("subject.source_native_id").alias("subject"), F.col("subject.label").alias("label"), F.element_at("relationships", 1)["object"]["source_native_id"].alias("performer"), F.size("relationships").alias("relations"))


@query("SELECT person_id AS subject, CAST(count(topic) AS INTEGER) AS relations FROM person LEFT JOIN topics USING (person_id) GROUP BY person_id", "person", "topics")
def e21_person_envelopes(t: Testbed) -> DataFrame:
    e = adapters.people_rows(t.person(), t.person().select("person_id", F.lit("origin").alias("platform"), F.col("origin").alias("value")), t.topics(), SOURCE)
    return e.select(F.col("subject.source_native_id").alias("subject"), F.size("relationships").alias("relations"))


@query("SELECT count(*) AS records, count(*) FILTER (event_id % 5 <> 0) AS valid, CAST(count(*) FILTER (event_id % 5 = 0) AS BIGINT) AS issues FROM events")
def v01_envelope_report(t: Testbed) -> DataFrame:
    e = event_envelopes(t)
    relations = F.transform("relationships", lambda r: F.struct(r["predicate"].alias("type"), F.lit("observed").alias("review_state"), F.lit(None).cast("string").alias("method"), F.lit(None).cast("array<string>").alias("basis"), r["evidence"].alias("evidence")))
    broken = e.withColumn("relationships", relations).withColumn("raw_pointer", F.when(F.col("source.record_native_id").cast("long") % 5 == 0, "/home/x").otherwise(F.col("raw_pointer")))
    return contracts.report(contracts.envelope_issues(broken))


#: What an envelope of each remainder of its event's id is broken by; the last is whole.
BROKEN = (
    "envelope.version", "required.text", "source.rights_state", "subject.kind", "format.sha256", "pointer.private_path", "format.iso8601", "format.timezone", "type.list", "required.text", "type.mapping", "identifier.attribute_promoted", "identifier.handle_global", "identifier.handle_stable",
    "identifier.handle_unique", "identifier.scope", "identifier.stability", "identifier.uniqueness", "relationship.type", "identity.relationship_not_review_only", "identity.name_only_merge", "identity.canonical_id_forbidden", "identity.merge_directive_forbidden", "",
)


@query(f"SELECT code, count(*) AS n FROM (SELECT [{', '.join(repr(c) for c in BROKEN)}][event_id % 24 + 1] AS code FROM events) WHERE code <> '' GROUP BY code")
def v01_every_code(t: Testbed) -> DataFrame:
    """Envelopes of all events, each broken in one way or none: how often each code is raised."""
    m = F.pmod(F.col("source.record_native_id").cast("long"), F.lit(24))
    at = lambda cases, other: reduce(lambda c, kv: F.when(m.isin(kv[0]) if isinstance(kv[0], int) else m.isin(*kv[0]), F.lit(kv[1])).otherwise(c), cases.items(), other)
    source, subject = F.col("source"), F.col("subject")
    source = source.withField("source_id", at({1: " "}, source["source_id"])).withField("rights_state", at({2: "any"}, source["rights_state"])).withField("payload_sha256", at({4: "12"}, source["payload_sha256"])).withField("observed_at", at({6: "yesterday", 7: "2024-01-01T00:00:00"}, source["observed_at"]))
    subject = subject.withField("kind", at({3: "any"}, subject["kind"])).withField("label", at({9: " "}, subject["label"]))
    ids = F.transform(
        "identifiers", lambda x: x.withField("scheme", at({11: "name", (12, 13, 14): "login"}, x["scheme"])).withField("scope", at({12: "global", 15: "any"}, x["scope"])).withField("stability", at({(12, 14): "mutable", 16: "any"}, x["stability"])).withField("uniqueness", at({(12, 13): "unknown", 17: "any"}, x["uniqueness"]))
    )
    none = F.lit(None).cast("string")
    relations = F.transform(
        F.slice("relationships", 1, 1), lambda r: F.struct(at({18: "", (19, 20): "same_as"}, r["predicate"]).alias("type"), at({19: "accepted"}, F.lit("proposed")).alias("review_state"), at({19: "orcid", 20: "exact_name"}, none).alias("method"), F.lit(None).cast("array<string>").alias("basis"), r["evidence"].alias("evidence"))
    )
    e = event_envelopes(t).select(
        at({0: "other"}, F.col("envelope_version")).alias("envelope_version"), source.alias("source"), F.when(m != 10, subject).alias("subject"), F.when(m != 8, ids).alias("identifiers"), "contributions", relations.alias("relationships"), "evidence",
        at({5: "/home/x"}, F.col("raw_pointer")).alias("raw_pointer"), at({21: '{"a": [{"Canonical_ID": 1}]}', 22: '{"b": {"auto_merge": true}}'}, F.lit("{}")).alias("raw"),
    )
    return contracts.envelope_issues(e, "raw").select(F.explode("issues.code").alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query("SELECT source, n_chars, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY source, n_chars HAVING count(*) > 1")
def v09_duplicate_keys(t: Testbed) -> DataFrame:
    return contracts.duplicates(t.table("documents"), ["source", "n_chars"], F.col("lang") == "en")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0)")
def v11_orphans(t: Testbed) -> DataFrame:
    return contracts.orphans(t.table("lineitem"), "l_suppkey", t.table("supplier").filter("s_suppkey % 10 <> 0"), "s_suppkey").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, 'price' AS violated FROM orders WHERE NOT o_totalprice < 300000 UNION ALL SELECT o_orderkey, 'status' FROM orders WHERE NOT o_orderstatus IN ('O', 'F')")
def v12_checks(t: Testbed) -> DataFrame:
    return contracts.violations(t.table("orders"), price=F.col("o_totalprice") < 300000, status=F.col("o_orderstatus").isin("O", "F")).select("o_orderkey", "violated")


@query("SELECT count(*) AS records, 1 AS sources, CAST(2 * count(*) AS BIGINT) AS relationships, CAST(count(*) AS BIGINT) AS identifiers FROM events")
def a18_pilot_metrics(t: Testbed) -> DataFrame:
    return bridges.pilot_metrics(event_envelopes(t)).select("records", F.col("sources").cast("int").alias("sources"), "relationships", "identifiers")


# ---------------------------------------------------------------- the rest of the inventory


@query("SELECT DISTINCT person_id FROM content WHERE person_id <> 'c:1' AND content_ref IN (SELECT content_ref FROM content WHERE person_id = 'c:1' AND domain = 'part') AND domain = 'part'", "content")
def p02_not_members(t: Testbed) -> DataFrame:
    works = t.content().filter("domain = 'part'")
    mine = works.filter("person_id = 'c:1'").select("content_ref")
    return works.filter("person_id <> 'c:1'").join(mine, "content_ref", "left_semi").select("person_id").distinct()


@query("SELECT entity_id FROM entities WHERE digest IN (SELECT digest FROM entities GROUP BY digest HAVING count(*) > 1)", "entities")
def p04_same_cluster(t: Testbed) -> DataFrame:
    many = contracts.duplicates(t.entities(), ["digest"])
    return t.entities().join(many, "digest", "left_semi").select("entity_id")


CARDS = """SELECT CASE WHEN p_partkey % 11 = 0 THEN 'solo' || p_partkey ELSE 'Owner' || (p_partkey % 97) || CASE WHEN p_partkey % 5 = 0 THEN '-labs' ELSE '' END || '/repo' || p_partkey END AS full_name, CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS stars, p_brand AS language,
 CASE WHEN p_partkey % 3 = 0 THEN '' ELSE repeat(p_name || ' ', 20) END AS description, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'oops' ELSE '["' || p_type || '", "CLI", "' || p_name || '"]' END AS topics_json, CASE p_partkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '0' END AS fork FROM part"""


def cards(t: Testbed) -> DataFrame:
    """Parts as cards of repositories, in all forms that the loaders have to bear."""
    t.table("part").createOrReplaceTempView("_part")
    return t.spark.sql(CARDS.replace("FROM part", "FROM _part"))


REPOS = f"SELECT *, lower(split_part(full_name, '/', 1)) AS k FROM ({CARDS}) WHERE contains(full_name, '/') AND coalesce(fork, '') IN ('', '0')"


@query(f"SELECT full_name FROM ({CARDS}) WHERE contains(full_name, '/') AND coalesce(fork, '') IN ('', '0') AND coalesce(stars, 0) >= 10")
def p08_repositories(t: Testbed) -> DataFrame:
    return rollups.repositories(cards(t), 10).select("full_name")


@query(f"SELECT full_name FROM ({CARDS}) WHERE contains(full_name, '/') AND coalesce(fork, '') IN ('', '0')")
def p07_with_slash(t: Testbed) -> DataFrame:
    return rollups.repositories(cards(t)).select("full_name")


@query(f"SELECT 'gh:' || arg_min(split_part(full_name, '/', 1), full_name) AS person_id, count(*) AS repos, CAST(sum(coalesce(stars, 0)) AS BIGINT) AS stars, string_agg(DISTINCT language, ',' ORDER BY language) AS languages, CASE WHEN contains(k, '-labs') THEN 'organisation' ELSE 'unknown' END AS kind FROM ({REPOS}) GROUP BY k")
def g28_owners(t: Testbed) -> DataFrame:
    known = t.spark.createDataFrame([], "login string, person_id string, priority int")
    return rollups.owners(cards(t), known)[0].select("person_id", "repos", big("stars"), F.array_join("languages", ",").alias("languages"), "kind")


@query(f"SELECT 'gh:' || split_part(full_name, '/', 1) AS person_id, full_name AS content_ref, CAST(coalesce(stars, 0) AS DOUBLE) AS score, nullif(substr(description, 1, 200), '') AS title FROM ({REPOS})")
def f12_owner_edges(t: Testbed) -> DataFrame:
    known = t.spark.createDataFrame([], "login string, person_id string, priority int")
    return rollups.owners(cards(t), known)[1].select("person_id", "content_ref", "score", "title")


@query(
    f"""SELECT person_id, topic, scheme, CAST(weight AS DOUBLE) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY scheme, person_id ORDER BY weight DESC, topic) AS n FROM (
 SELECT 'gh:' || k AS person_id, topic, 'github_topic' AS scheme, count(*) AS weight FROM (SELECT lower(split_part(full_name, '/', 1)) AS k, unnest([lower(trim(p)) FOR p IN string_split(substr(topics_json, 3, length(topics_json) - 4), '", "')]) AS topic FROM ({CARDS}) WHERE contains(full_name, '/') AND starts_with(topics_json, '[')) WHERE length(topic) > 2 AND topic <> 'cli' GROUP BY k, topic
 UNION ALL SELECT 'gh:' || lower(split_part(full_name, '/', 1)), language, 'github_lang', count(*) FROM ({CARDS}) WHERE contains(full_name, '/') GROUP BY 1, 2)) WHERE n <= CASE scheme WHEN 'github_topic' THEN 25 ELSE 8 END"""
)
def g29_owner_topics(t: Testbed) -> DataFrame:
    people = cards(t).filter("contains(full_name, '/')").select(F.concat(F.lit("gh:"), F.lower(text.before_slash(F.col("full_name")))).alias("person_id")).distinct()
    return rollups.owner_topics(cards(t), people).select("person_id", "topic", "scheme", "weight")


BOOKS = "SELECT o_orderkey AS gid, CASE WHEN o_orderkey % 4 = 0 THEN 'Various' ELSE 'Customer' || o_custkey || ', ' || o_orderpriority END || CASE WHEN o_custkey % 3 = 0 THEN ', ' || (1500 + o_custkey % 400) || '-' ELSE '' END || CASE WHEN o_orderkey % 5 = 0 THEN '; Clerk, Anne [Editor]' ELSE '' END AS authors, CASE WHEN o_orderkey % 7 = 0 THEN 'Sound' ELSE 'Text' END AS media_type FROM orders"


def books(t: Testbed) -> DataFrame:
    t.table("orders").createOrReplaceTempView("_orders")
    return t.spark.sql(BOOKS.replace("FROM orders", "FROM _orders"))


CHUNKS = rf"""SELECT gid, trim(c) AS variant, CASE WHEN ends_with(c, ']') THEN 'editor' ELSE 'author' END AS role, regexp_replace(regexp_replace(trim(c), '\s*\[Editor\]$', ''), ',\s*\d{{4}}-$', '') AS name, TRY_CAST(regexp_extract(c, ',\s*(\d{{4}})-$', 1) AS INTEGER) AS birth FROM (SELECT gid, unnest(string_split(authors, ';')) AS c FROM ({BOOKS}) WHERE media_type = 'Text')"""


@query(f"SELECT gid, name, birth, role, (NOT contains(name, ',') AND birth IS NULL) OR lower(name) = 'various' AS corporate FROM ({CHUNKS})")
def f07_author_chunks(t: Testbed) -> DataFrame:
    rows = rollups.chunks(books(t)).filter("author IS NOT NULL")
    return rows.select("gid", "author.name", "author.birth", "author.role", "author.corporate")


@query(rf"SELECT regexp_replace(lower(name), '[^a-z0-9, ]', '', 'g') || CASE WHEN birth IS NULL THEN '' ELSE '|' || birth || '-' END AS person_key, count(DISTINCT (gid, role)) AS work_count, string_agg(DISTINCT variant, ';' ORDER BY variant) AS variants FROM ({CHUNKS}) GROUP BY 1")
def g26_book_people(t: Testbed) -> DataFrame:
    return rollups.book_people(books(t))[0].select("person_key", "work_count", F.array_join("variants", ";").alias("variants"))


@query(rf"SELECT DISTINCT regexp_replace(lower(name), '[^a-z0-9, ]', '', 'g') || CASE WHEN birth IS NULL THEN '' ELSE '|' || birth || '-' END AS person_key, gid, role FROM ({CHUNKS})")
def a13_book_edges(t: Testbed) -> DataFrame:
    return rollups.book_people(books(t))[1]


@query("SELECT CASE WHEN starts_with(event_type, 'p') THEN 'p-family' ELSE event_type END AS family, count(*) AS n FROM events GROUP BY 1")
def p23_recode(t: Testbed) -> DataFrame:
    family = F.when(F.startswith("event_type", F.lit("p")), "p-family").otherwise(F.col("event_type"))
    return t.observations().groupBy(family.alias("family")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN regexp_matches(lower(login), '-org|-team|-labs|-inc|-io|foundation|institute|technologies|systems|software|group|community|project') THEN true ELSE false END AS organisational FROM (SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN '-Labs' WHEN 1 THEN ' Foundation' ELSE '' END AS login FROM customer)")
def p21_organisational(t: Testbed) -> DataFrame:
    rows = t.table("customer").selectExpr("c_custkey", "c_name || CASE c_custkey % 4 WHEN 0 THEN '-Labs' WHEN 1 THEN ' Foundation' ELSE '' END AS login")
    return rows.select("c_custkey", rollups.organisational(F.col("login")).alias("organisational"))


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND (a.s_acctbal < 0) = (b.s_acctbal < 0) AND a.s_suppkey < b.s_suppkey")
def j12_two_key_blocks(t: Testbed) -> DataFrame:
    rows = t.table("supplier").select(F.col("s_suppkey").alias("entity_id"), "s_nationkey", (F.col("s_acctbal") < 0).alias("debtor"))
    return identity.block_pairs(rows, ["s_nationkey", "debtor"], chunk=2).select("a", "b")


@query("SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey")
def j12_all_two_key_blocks(t: Testbed) -> DataFrame:
    rows = t.table("customer").withColumnRenamed("c_custkey", "entity_id")
    return identity.block_pairs(rows, ["c_nationkey", "c_mktsegment"], chunk=16).select("a", "b")


@query("SELECT person_id, string_agg(topic, ',' ORDER BY topic) AS topics, count(*) AS n FROM (SELECT DISTINCT person_id, topic FROM topics WHERE scheme = 'type') GROUP BY person_id", "topics")
def j14_collected_children(t: Testbed) -> DataFrame:
    kinds = t.topics().filter("scheme = 'type'").groupBy("person_id").agg(F.array_sort(F.collect_set("topic")).alias("t"))
    return kinds.select("person_id", F.array_join("t", ",").alias("topics"), F.size("t").cast("long").alias("n"))


@query("SELECT conv_id, role, count(*) AS turns, min(turn) AS first, max(turn) AS last FROM conversations GROUP BY conv_id, role")
def a22_contributions_by_role(t: Testbed) -> DataFrame:
    return t.table("conversations").groupBy("conv_id", "role").agg(F.count("*").alias("turns"), F.min("turn").alias("first"), F.max("turn").alias("last"))


@query("SELECT source, count(*) AS n, round(count(*) FILTER (quality IS NOT NULL) * 100.0 / count(*), 2) AS pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def a26_coverage_ratio(t: Testbed) -> DataFrame:
    rows = t.table("documents").join(t.table("labels"), "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n"), bridges.percent(F.count("quality"), F.count("*")).alias("pct"))


@query("SELECT 'github_account_id' AS scheme, CAST(c_custkey AS VARCHAR) AS value FROM customer UNION ALL SELECT 'github_node_id', 'N' || c_custkey FROM customer WHERE c_custkey % 2 = 0 UNION SELECT 'github_event_id', CAST(event_id AS VARCHAR) FROM events")
def a24_distinct_accounts(t: Testbed) -> DataFrame:
    """Stable identifiers of account and event envelopes; logins, which change, are none."""
    none, key = F.lit(None).cast("string"), F.col("c_custkey")
    rows = t.table("customer").select(key.alias("id"), F.when(key % 2 == 0, F.concat(F.lit("N"), key)).alias("node_id"), F.col("c_name").alias("login"), F.lit(None).cast("array<struct<login:string,valid_from:string,valid_to:string>>").alias("previous_logins"), F.lit("User").alias("type"), *[none.alias(c) for c in ("name", "company", "location", "bio")])
    return bridges.stable_ids(adapters.code_accounts(rows, SOURCE).unionByName(event_envelopes(t)))


@query("SELECT source, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id DESC) AS n FROM documents) WHERE n = 1")
def a25_last_subject(t: Testbed) -> DataFrame:
    return rollups.first_wins(t.table("documents").select("source", "lang", "doc_id"), ["source", "lang"], F.desc("doc_id"))


@query("SELECT count(*) AS people, count(*) FILTER (corporate) AS corporate, count(*) FILTER (years) AS with_life_years FROM (SELECT k, arg_min(NOT contains(name, ',') AND birth IS NULL OR lower(name) = 'various', gid) AS corporate, bool_or(birth IS NOT NULL) AS years FROM (SELECT *, regexp_replace(lower(name), '[^a-z0-9, ]', '', 'g') || CASE WHEN birth IS NULL THEN '' ELSE '|' || birth || '-' END AS k FROM (" + CHUNKS + ")) GROUP BY k)")
def a14_build_summary(t: Testbed) -> DataFrame:
    return rollups.build_summary(*rollups.book_people(books(t))).drop("edges")


@query("""WITH RECURSIVE k AS (SELECT c_custkey AS k FROM customer), e AS (SELECT a.k AS u, a.k + 1 AS v FROM k a JOIN k b ON b.k = a.k + 1 WHERE a.k % 12 <> 0), r(id, step) AS (SELECT k, 0 FROM k WHERE k % 12 = 1 UNION SELECT e.v, step + 1 FROM r JOIN e ON e.u = r.id WHERE step < 8)
 SELECT DISTINCT id, EXISTS (SELECT 1 FROM r JOIN e ON e.u = r.id WHERE step = 8) = FALSE AS complete FROM r""")
def g02_expansion(t: Testbed) -> DataFrame:
    """What eight steps along chains of twelve customers reach from their heads: not all of it."""
    from .operators.components import expand

    keys = t.table("customer").select(F.col("c_custkey").alias("k"))
    edges = keys.filter("k % 12 <> 0").select(F.col("k").alias("u"), (F.col("k") + 1).alias("v")).join(keys.withColumnRenamed("k", "v"), "v", "left_semi").select("u", "v")
    near, complete = expand(keys.filter("k % 12 = 1").select(F.col("k").alias("id")), edges)
    return near.select("id", F.lit(complete).alias("complete"))


@query("WITH RECURSIVE e AS (SELECT person_id AS u, merged_into AS v FROM person WHERE merged_into IS NOT NULL UNION SELECT merged_into, person_id FROM person WHERE merged_into IS NOT NULL), r(id, step) AS (SELECT merged_into, 0 FROM person WHERE merged_into IS NOT NULL UNION SELECT v, step + 1 FROM r JOIN e ON id = u WHERE step < 9) SELECT id AS person_id, (SELECT count(*) = 0 FROM r WHERE step = 9 AND id NOT IN (SELECT id FROM r WHERE step <= 8)) AS complete FROM r WHERE step <= 8 GROUP BY id", "person")
def g02_merged_expansion(t: Testbed) -> DataFrame:
    """All people within 8 steps of those that others were merged into, and whether a further step would add none;"""
    from .operators.components import expand

    merged = t.person().filter("merged_into IS NOT NULL")
    near, complete = expand(merged.select(F.col("merged_into").alias("id")), merged.select(F.col("person_id").alias("u"), F.col("merged_into").alias("v")))
    return near.select(F.col("id").alias("person_id"), F.lit(complete).alias("complete"))


@query("SELECT (SELECT count(*) FROM person WHERE name ILIKE '%customer#00000001%') AS total, count(*) AS returned FROM (SELECT person_id FROM person WHERE name ILIKE '%customer#00000001%' ORDER BY person_id LIMIT 5)", "person")
def a01_honest_total(t: Testbed) -> DataFrame:
    hits = search.containing(t.person(), "name", "customer#00000001")
    page = hits.orderBy("person_id").limit(5).agg(F.count("*").alias("returned"))
    return hits.agg(F.count("*").alias("total")).crossJoin(F.broadcast(page))  # one row each


@query("SELECT a.l_orderkey, a.l_linenumber FROM lineitem a JOIN orders o ON a.l_orderkey = o.o_orderkey WHERE a.l_shipdate < o.o_orderdate")
def p16_interval_order(t: Testbed) -> DataFrame:
    rows = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return contracts.violations(rows, order=F.col("l_shipdate") >= F.col("o_orderdate")).select("l_orderkey", "l_linenumber")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '1970-01-01T00:00:00Z' WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS at FROM events")
def f19_full_times(t: Testbed) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).when(F.col("event_id") % 3 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.observations().select("event_id", dates.full_time(raw).alias("at"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'format.iso8601' WHEN 1 THEN 'format.timezone' END AS problem FROM events")
def f20_iso_problems(t: Testbed) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.lit("someday")).when(F.col("event_id") % 3 == 1, F.lit("2024-01-01T00:00:00")).otherwise(F.lit("2024-01-01T00:00:00+01:00"))
    return t.observations().select("event_id", dates.iso_problem(raw).alias("problem"))


@query("SELECT c_custkey, lower(split_part(c_name, '#', 1)) AS surname FROM customer")
def f03_surnames(t: Testbed) -> DataFrame:
    surname, _ = text.parts_of(F.concat(F.substring_index("c_name", "#", 1), F.lit(", X")))
    return t.table("customer").select("c_custkey", surname.alias("surname"))


@query("SELECT p_partkey, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS key FROM part")
def f09_collapsed(t: Testbed) -> DataFrame:
    return t.table("part").select("p_partkey", text.collapsed(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" \t ")))).alias("key"))


@query("SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS n FROM (SELECT p_partkey, token, count(*) AS tf FROM (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS token FROM part) GROUP BY p_partkey, token) GROUP BY token")
def f01_postings(t: Testbed) -> DataFrame:
    return search.postings(t.table("part"), "p_partkey", F.col("p_name")).groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))


@query("SELECT nation.n_name, CAST(count(c_custkey) AS BIGINT) AS customers, count(*) FILTER (c_acctbal < 0) AS negative FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name")
def a17_method_histogram(t: Testbed) -> DataFrame:
    rows = t.table("nation").join(t.table("customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return rows.groupBy("n_name").agg(F.count("c_custkey").alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("negative"))


@query("SELECT 'shared_external_id' AS method, count(*) AS candidates, count(*) FILTER (a.kind = b.kind) AS auto_eligible, count(*) FILTER (a.kind <> b.kind) AS conflicted FROM entities a JOIN entities b ON a.digest = b.digest AND a.entity_id < b.entity_id HAVING count(*) > 0", "entities")
def a17_method_counts(t: Testbed) -> DataFrame:
    """Candidates of all documents by method, where labels are their own and equal texts share an identifier."""
    people = t.entities().withColumns({"label": F.concat(F.lit("n"), "entity_id"), "birth_year": F.lit(None).cast("int"), "death_year": F.lit(None).cast("int")})
    numbers = t.entities().select("entity_id", F.lit("viaf").alias("scheme"), F.col("digest").alias("value"), F.lit(None).cast("string").alias("valid_to"))
    return identity.method_counts(identity.candidates(people, numbers))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1")
def v09_repeated_status(t: Testbed) -> DataFrame:
    return contracts.duplicates(t.observations(), ["user_id", "event_type"])


@query("SELECT doc_id FROM documents WHERE doc_id % 10 = 0")
def v06_changed_rows(t: Testbed) -> DataFrame:
    before = t.table("documents").select("doc_id", "lang")
    return contracts.changed(before, before.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, "xx").otherwise(F.col("lang"))), "doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'name_only' WHEN doc_id % 5 = 1 THEN 'unsafe_scheme' ELSE '' END AS problems FROM documents")
def v14_seed_problems(t: Testbed) -> DataFrame:
    kind = "array<struct<scheme:string,value:string>>"
    ids_ = F.when(F.col("doc_id") % 5 == 0, F.array().cast(kind)).otherwise(F.array(F.struct(F.when(F.col("doc_id") % 5 == 1, "name").otherwise("orcid").alias("scheme"), F.lit("1").alias("value"))))
    seeds = t.table("documents").select("doc_id", F.array(F.lit("d")).alias("domains"), ids_.alias("stable_identifiers"), F.lit("living").alias("living_state"))
    return contracts.seed_problems(seeds).select("doc_id", F.array_join("problems", ",").alias("problems"))


@query("SELECT c_custkey, 'source_observation' AS grade, c_mktsegment AS source FROM customer")
def v16_evidence(t: Testbed) -> DataFrame:
    from .engine import evidence

    return t.table("customer").select("c_custkey", evidence("source_observation", F.col("c_mktsegment")).alias("e")).select("c_custkey", "e.grade", "e.source")


@query("SELECT 'talk:' || l_orderkey || '-' || l_linenumber AS subject, CAST(1 AS INTEGER) AS speakers FROM lineitem")
def e18_all_schedule_envelopes(t: Testbed) -> DataFrame:
    talk = F.struct(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("guid"), F.lit("t").alias("title"), F.array(F.struct(F.col("l_returnflag").alias("name"), F.lit(None).cast("string").alias("code"))).alias("persons"))
    rows = t.table("lineitem").select(F.col("l_orderkey").cast("string").alias("conference"), F.array(F.struct(F.lit("2024-01-01").alias("date"), F.create_map(F.lit("room"), F.array(talk)).alias("rooms"))).alias("days"))
    return adapters.schedule_talks(rows, SOURCE).select(F.col("subject.source_native_id").alias("subject"), F.size("contributions").alias("speakers"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS subject, CAST(1 + count(l_orderkey) AS BIGINT) AS envelopes FROM part LEFT JOIN (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) ON p_partkey = l_partkey GROUP BY p_partkey")
def e05_all_package_envelopes(t: Testbed) -> DataFrame:
    made = t.table("lineitem").select("l_partkey", "l_orderkey").distinct().groupBy("l_partkey").agg(F.collect_list(F.struct(F.col("l_orderkey").cast("string").alias("version"), F.lit("2024-01-01T00:00:00Z").alias("published_at"))).alias("versions"))
    rows = t.table("part").join(made, F.col("p_partkey") == F.col("l_partkey"), "left").select(F.col("p_partkey").cast("string").alias("name"), F.lit("MIT").alias("license"), F.array(F.col("p_brand")).alias("owners"), "versions")
    e = adapters.packages(rows, SOURCE, "npm")
    return e.groupBy(F.substring_index("subject.label", "@", 1).alias("subject")).agg(F.count("*").alias("envelopes"))


@query("SELECT n_name, (SELECT count(*) FROM nation WHERE n_regionkey <> 2) AS total FROM nation WHERE n_regionkey <> 2 ORDER BY n_name LIMIT 7")
def w01_total_beside_page(t: Testbed) -> DataFrame:
    rows = t.table("nation").filter("n_regionkey <> 2").select("n_name")
    return rows.orderBy("n_name").limit(7).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))  # one row


@query("SELECT person_id, content_ref, p_name AS title FROM content LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = content_ref WHERE domain = 'part' AND role = 'supplier'", "content")
def j07_titles(t: Testbed) -> DataFrame:
    titles = t.table("part").select(F.col("p_partkey").cast("string").alias("content_ref"), F.col("p_name").alias("title"))
    return t.content().filter("domain = 'part' AND role = 'supplier'").join(titles, "content_ref", "left").select("person_id", "content_ref", "title")


@query("SELECT name, domain, count(*) AS n FROM person JOIN content USING (person_id) WHERE kind = 'organisation' GROUP BY name, domain", "person", "content")
def j13_person_content(t: Testbed) -> DataFrame:
    return t.person().filter("kind = 'organisation'").join(t.content(), "person_id").groupBy("name", "domain").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'R' WHERE o_orderstatus = 'F'")
def j15_work_versions(t: Testbed) -> DataFrame:
    versions = t.table("lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    return t.table("orders").filter("o_orderstatus = 'F'").join(versions, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber")


@query("SELECT doc_id, item_id FROM documents JOIN benchmark ON TRY_CAST('0' || item_id AS BIGINT) = doc_id")
def j18_locator_lookup(t: Testbed) -> DataFrame:
    places = t.table("benchmark").select("item_id", F.concat(F.lit("0"), F.col("item_id").cast("string")).try_cast("bigint").alias("doc_id"))
    return t.table("documents").select("doc_id").join(places, "doc_id")


@query("SELECT o_orderkey, o_custkey % 7 = o_orderkey % 7 AS known FROM orders")
def j19_pair_probe(t: Testbed) -> DataFrame:
    pairs = t.spark.range(7).select(F.col("id").alias("x"), F.col("id").alias("y"), F.lit(True).alias("hit"))
    rows = t.table("orders").select("o_orderkey", F.least(F.col("o_custkey") % 7, F.col("o_orderkey") % 7).alias("x"), F.greatest(F.col("o_custkey") % 7, F.col("o_orderkey") % 7).alias("y"))
    return rows.join(pairs, ["x", "y"], "left").select("o_orderkey", F.coalesce("hit", F.lit(False)).alias("known"))


@query("SELECT topic, weight FROM topics WHERE person_id = 'c:7' ORDER BY weight DESC, scheme, topic LIMIT 6", "topics")
def o04_top_topics(t: Testbed) -> DataFrame:
    return t.topics().filter("person_id = 'c:7'").orderBy(F.desc("weight"), "scheme", "topic").limit(6).select("topic", "weight")


@query("SELECT person_id, n FROM (SELECT person_id, count(*) AS n FROM content GROUP BY person_id) ORDER BY n DESC, person_id LIMIT 30", "content")
def o05_by_coverage(t: Testbed) -> DataFrame:
    return t.content().groupBy("person_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "person_id").limit(30)


@query("SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def o10_union(t: Testbed) -> DataFrame:
    return t.table("orders").select(F.col("o_custkey").alias("k")).union(t.table("customer").select("c_custkey")).distinct()


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b, len(list_intersect(string_split(a.n_name, ''), string_split(b.n_name, ''))) > 0 AS meet FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def o11_arrays_meet(t: Testbed) -> DataFrame:
    n = t.table("nation").select("n_nationkey", "n_regionkey", F.split("n_name", "").alias("w"))
    a, b = n.alias("a"), n.alias("b")
    met = a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey")))
    return met.select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"), F.arrays_overlap("a.w", "b.w").alias("meet"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 50000")
def o12_difference(t: Testbed) -> DataFrame:
    rich = t.table("orders").filter("o_totalprice > 50000").select(F.col("o_custkey").alias("k"))
    return t.table("customer").select(F.col("c_custkey").alias("k")).join(rich, "k", "left_anti")


@query("SELECT gid, authors FROM (" + BOOKS + ") WHERE media_type = 'Text' AND authors <> ''")
def p10_text_books(t: Testbed) -> DataFrame:
    return books(t).filter("media_type = 'Text' AND authors <> ''").select("gid", "authors")


@query("SELECT a, b FROM (SELECT o_orderkey AS a, o_custkey AS b FROM orders) WHERE a IN (1, 5, 9) OR b IN (1, 5, 9)")
def p12_either_endpoint(t: Testbed) -> DataFrame:
    edges = t.table("orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"))
    return edges.filter(F.col("a").isin(1, 5, 9) | F.col("b").isin(1, 5, 9))


@query("SELECT doc_id FROM labels WHERE quality = 1 ORDER BY toxic DESC, doc_id LIMIT 15")
def p13_review_queue(t: Testbed) -> DataFrame:
    rows = t.table("labels").select(F.col("doc_id").alias("candidate_id"), F.col("toxic").alias("auto_eligible"), F.lit(0.5).alias("confidence"), F.when(F.col("quality") == 1, "proposed").otherwise("done").alias("review_state"))
    return identity.review_queue(rows, "proposed", 15).select(F.col("candidate_id").alias("doc_id"))


@query("SELECT scheme, n, scheme IN ('github_id', 'orcid') AS auto FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN 'github_id' WHEN 1 THEN 'orcid' WHEN 2 THEN 'github_login' ELSE 'made_up' END AS scheme, count(*) AS n FROM customer GROUP BY 1)")
def f05_registry(t: Testbed) -> DataFrame:
    rows = t.table("customer").selectExpr("CASE c_custkey % 4 WHEN 0 THEN 'github_id' WHEN 1 THEN 'orcid' WHEN 2 THEN 'github_login' ELSE 'made_up' END AS scheme").groupBy("scheme").agg(F.count("*").alias("n"))
    return ids.classified(rows).select("scheme", "n", F.col("auto_eligible").alias("auto"))


@query("SELECT p_partkey, CASE WHEN lower(p_type) IN ('cli', 'web', 'tools') OR length(p_type) <= 2 THEN false ELSE true END AS telling FROM part")
def p20_noise_words(t: Testbed) -> DataFrame:
    word = F.lower("p_type")
    return t.table("part").select("p_partkey", ((F.length(word) > 2) & ~word.isin(*rollups.NOISE)).alias("telling"))


@query("SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9, ]', '', 'g') || CASE WHEN c_custkey % 2 = 0 THEN '|' || (1000 + c_custkey) || '-' ELSE '' END AS key FROM customer")
def f08_person_keys(t: Testbed) -> DataFrame:
    birth = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") + 1000)
    return t.table("customer").select("c_custkey", authors.person_key(F.concat("c_name", F.lit(" (x)")), birth, F.lit(None).cast("int")).alias("key"))


@query("""SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || '}') AS digest FROM events""")
def f14_canonical_digests(t: Testbed) -> DataFrame:
    from .functions.jsonx import canonical

    return t.observations().select("event_id", digest(canonical(F.col("props"))).alias("digest"))


@query("SELECT c_custkey, 'obs:src:account:' || substr(sha256('src' || chr(31) || 'account' || chr(31) || c_custkey), 1, 24) AS id FROM customer")
def f17_observation_ids(t: Testbed) -> DataFrame:
    return t.table("customer").select("c_custkey", ids.observation_id(F.lit("src"), F.lit("account"), F.col("c_custkey").cast("string")).alias("id"))


@query("SELECT n_nationkey, replace(n_name, ' ', '%20') AS locator FROM nation")
def f22_locators(t: Testbed) -> DataFrame:
    return t.table("nation").select("n_nationkey", ids.percent_encoded(F.col("n_name")).alias("locator"))


@query("SELECT event_id, 'k' AS keys FROM events")
def f25_keys(t: Testbed) -> DataFrame:
    from .functions.jsonx import keys_at_any_depth

    return t.observations().select("event_id", F.array_join(keys_at_any_depth(F.col("props")), ",").alias("keys"))


@query("SELECT p_partkey, coalesce(nullif(trim(CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_name END), ''), p_brand) AS label FROM part")
def f29_first_text(t: Testbed) -> DataFrame:
    name = F.when(F.col("p_partkey") % 3 == 0, F.lit(" ")).otherwise(F.col("p_name"))
    return t.table("part").select("p_partkey", text.first_text(name, F.col("p_brand")).alias("label"))


@query("SELECT lang, round(count(*) FILTER (source = 'src0') * 100.0 / count(*), 2) AS pct FROM documents GROUP BY lang")
def f30_percentages(t: Testbed) -> DataFrame:
    return t.table("documents").groupBy("lang").agg(bridges.percent(F.count_if(F.col("source") == "src0"), F.count("*")).alias("pct"))


@query("SELECT person_id, count(DISTINCT domain || ':' || content_ref) AS shared FROM content WHERE (domain, content_ref) IN (SELECT (domain, content_ref) FROM content WHERE person_id = 'c:5') AND person_id <> 'c:5' GROUP BY person_id ORDER BY shared DESC, person_id LIMIT 25", "content")
def g10_relationships(t: Testbed) -> DataFrame:
    return graph.co_contributors(t.content(), t.spark.createDataFrame([("c:5",)], "person_id string")).orderBy(F.desc("shared"), "person_id").limit(25)


@query("SELECT p.person_id, p.merged_into, q.person_id IS NULL AS missing FROM person p LEFT JOIN person q ON p.merged_into = q.person_id WHERE p.merged_into IS NOT NULL", "person")
def g07_members_and_missing(t: Testbed) -> DataFrame:
    person = t.person()
    pointed = person.filter("merged_into IS NOT NULL").select("person_id", "merged_into")
    there = person.select(F.col("person_id").alias("merged_into"), F.lit(False).alias("missing"))
    return pointed.join(there, "merged_into", "left").select("person_id", "merged_into", F.coalesce("missing", F.lit(True)).alias("missing"))


@query(
    """WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment AS m, CASE WHEN c_acctbal < 0 THEN 'organisation' ELSE 'human' END AS kind, birth_year AS born, CASE WHEN c_custkey % 2 = 0 THEN last_year END AS died, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 5 END AS viaf FROM customer LEFT JOIN years ON c_custkey = o_custkey)
    SELECT a.k AS a, b.k AS b, array_to_string(list_filter([CASE WHEN a.viaf <> b.viaf THEN 'conflicting_viaf' END, CASE WHEN a.kind <> b.kind THEN 'human_organisation_conflict' END, CASE WHEN abs(a.born - b.born) > 2 OR abs(a.died - b.died) > 2 THEN 'life_date_conflict' END], lambda x: x IS NOT NULL), ',') AS conflicts
    FROM c a JOIN c b ON a.n = b.n AND a.m = b.m AND a.k < b.k""",
    "years",
)
def g17_pair_conflicts(t: Testbed) -> DataFrame:
    """Pairs of customers of a nation and segment with all three reasons: kinds, life dates, identifiers."""
    years = t.table("orders").groupBy("o_custkey").agg(F.year(F.min("o_orderdate")).alias("birth_year"), F.year(F.max("o_orderdate")).alias("last_year"))
    key = F.col("c_custkey")
    people = t.table("customer").join(years, key == F.col("o_custkey"), "left").select(key.alias("entity_id"), "c_nationkey", "c_mktsegment", F.when(F.col("c_acctbal") < 0, "organisation").otherwise("human").alias("kind"), "birth_year", F.when(key % 2 == 0, F.col("last_year")).alias("death_year"))
    held = t.table("customer").filter("c_custkey % 3 > 0").select(key.alias("entity_id"), F.lit("viaf").alias("scheme"), (key % 5).cast("string").alias("value"), F.lit(None).cast("string").alias("valid_to"))
    return identity.block_conflicts(people, ["c_nationkey", "c_mktsegment"], people, held).select("a", "b", F.array_join("conflicts", ",").alias("conflicts"))


@query("SELECT a.entity_id AS a, b.entity_id AS b, CASE WHEN a.kind <> b.kind THEN 'human_organisation_conflict' ELSE '' END AS conflicts FROM entities a JOIN entities b ON a.digest = b.digest AND a.entity_id < b.entity_id", "entities")
def g17_digest_conflicts(t: Testbed) -> DataFrame:
    """The pairs of all entities that have the same digest."""
    people = t.entities().withColumns({"birth_year": F.lit(None).cast("int"), "death_year": F.lit(None).cast("int")})
    none = t.spark.createDataFrame([], "entity_id long, scheme string, value string, valid_to string")
    return identity.block_conflicts(people, ["digest"], people, none).select("a", "b", F.array_join("conflicts", ",").alias("conflicts"))


@query("SELECT entity_id, min(entity_id) OVER (PARTITION BY digest) AS canonical_id FROM entities", "entities")
def g19_generation(t: Testbed) -> DataFrame:
    people = t.entities()
    log = identity.block_stars(people, ["digest"]).select(F.lit("d").alias("decision_id"), F.lit("c").alias("candidate_id"), F.col("u").alias("entity_a"), F.col("v").alias("entity_b"), F.lit("accepted").alias("outcome"), F.lit(True).alias("active"), F.lit(1).cast("long").alias("seq"))
    none = t.spark.createDataFrame([], "entity_id long, scheme string, value string, valid_to string")
    return identity.generation(people, log, none).select("entity_id", "canonical_id")


@query("SELECT digest AS cluster_id, count(DISTINCT origin) AS n FROM entities GROUP BY digest HAVING count(DISTINCT origin) > 1", "entities")
def g21_cluster_conflicts(t: Testbed) -> DataFrame:
    members = t.entities().select("entity_id", F.col("digest").alias("cluster_id"))
    held = t.entities().select("entity_id", F.lit("viaf").alias("scheme"), F.col("origin").alias("value"), F.lit(None).cast("string").alias("valid_to"))
    return identity.cluster_conflicts(members, held).select("cluster_id", F.size("values").cast("long").alias("n"))


@query("SELECT 'github:account:' || c_custkey AS subject, CAST(CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END AS INTEGER) AS ids, CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS renames FROM customer")
def e01_account_envelopes(t: Testbed) -> DataFrame:
    before = F.array(F.struct(F.lit("old").alias("login"), F.lit("2020").alias("valid_from"), F.lit("2021").alias("valid_to")))
    none = F.lit(None).cast("string")
    rows = t.table("customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "N").alias("node_id"), F.col("c_name").alias("login"), F.when(F.col("c_custkey") % 3 == 0, before).alias("previous_logins"), F.lit("User").alias("type"), none.alias("name"), none.alias("company"), none.alias("location"), none.alias("bio"))
    return adapters.code_accounts(rows, SOURCE).select(F.col("subject.source_native_id").alias("subject"), F.size("identifiers").alias("ids"), F.size("relationships").alias("renames"))


@query("SELECT domain || ':' || content_ref AS subject, CAST(count(*) AS INTEGER) AS people FROM content JOIN person USING (person_id) GROUP BY domain, content_ref", "content", "person")
def e22_work_envelopes(t: Testbed) -> DataFrame:
    e = adapters.work_rows(t.person(), t.content(), SOURCE)
    return e.select(F.col("subject.source_native_id").alias("subject"), F.size("contributions").alias("people"))


@query("SELECT DISTINCT scheme || ':' || topic AS subject FROM topics", "topics")
def e23_topic_envelopes(t: Testbed) -> DataFrame:
    return adapters.topic_rows(t.topics(), SOURCE).select(F.col("subject.source_native_id").alias("subject"))


@query("SELECT count(*) AS entities, CAST(count(*) AS BIGINT) AS attributes FROM (SELECT DISTINCT event_id FROM events)")
def e26_imported(t: Testbed) -> DataFrame:
    from .sources.imports import import_envelopes

    store = import_envelopes(event_envelopes(t))
    raw = store.attributes.filter("attribute = 'raw_pointer'").agg(F.count("*").alias("attributes"))
    return store.entities.agg(F.count("*").alias("entities")).crossJoin(F.broadcast(raw))  # one row each


@query("SELECT c_custkey AS entity_id, CAST(12 AS BIGINT) AS receipts, CAST(CASE WHEN c_custkey % 2 = 0 THEN 4 ELSE 3 END AS BIGINT) AS present FROM customer")
def e28_profile_receipts(t: Testbed) -> DataFrame:
    from .sources.imports import profile_rows

    none = F.lit(None).cast("string")
    rows = t.table("customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_custkey").alias("id"), none.alias("node_id"), F.col("c_name").alias("login"), F.col("c_name").alias("name"), none.alias("company"), F.when(F.col("c_custkey") % 2 == 0, "here").alias("location"), *[none.alias(c) for c in ("bio", "blog", "twitter_username", "type", "followers", "created_at")])
    return profile_rows(rows).groupBy("entity_id").agg(F.count("*").alias("receipts"), F.count_if(F.col("status") == "present").alias("present"))


@query("SELECT a.event_id FROM events a WHERE a.event_type = 'click' AND a.user_id % 5 = 0")
def v07_blocked_accepts(t: Testbed) -> DataFrame:
    log = t.observations().select("event_id", F.col("user_id").alias("candidate_id"), F.lit(True).alias("active"), F.when(F.col("event_type") == "click", "accepted").otherwise("rejected").alias("outcome"))
    conflicts = t.observations().filter("user_id % 5 = 0").select(F.col("user_id").alias("candidate_id"))
    return contracts.blocked_accepts(log, conflicts).select("event_id")


# ---------------------------------------------------------------- lanes, the identity write path, old values


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'global' ELSE 'source' END AS scope, CASE c_custkey % 4 WHEN 0 THEN 'stable' WHEN 1 THEN 'stable' WHEN 2 THEN 'mutable' ELSE 'unknown' END AS stability,
 CASE WHEN c_custkey % 4 < 2 THEN 'unique' ELSE 'unknown' END AS uniqueness FROM customer""")
def f24_identifier_semantics(t: Testbed) -> DataFrame:
    platforms = F.array(*[F.lit(p) for p in (" ORCID", "GitHub-ID", "x-handle", "made up")])
    means = ids.semantics(F.get(platforms, (F.col("c_custkey") % 4).cast("int")))
    return t.table("customer").select("c_custkey", means["scope"].alias("scope"), means["stability"].alias("stability"), means["uniqueness"].alias("uniqueness"))


@query("SELECT p_partkey, p_type = 'PROMO' AS below, starts_with(p_type, 'S') AND regexp_full_match(p_brand, '[^#]*#[^1].') AS shell FROM part")
def f31_path_matches(t: Testbed) -> DataFrame:
    path = F.concat(F.lit("./"), F.concat_ws("/", "p_type", "p_brand", F.lit("x.py")))
    return t.table("part").select("p_partkey", text.path_matches(F.lit("./PROMO/**"), path).alias("below"), text.path_matches(F.lit("S*/*#[!1]?/*.py"), path).alias("shell"))


@query("SELECT doc_id, replace(replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&#x27;') AS escaped FROM documents")
def f32_html_escaped(t: Testbed) -> DataFrame:
    return t.table("documents").select("doc_id", text.html_escaped(F.col("text")).alias("escaped"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS BIGINT) WHEN 1 THEN CAST(7 AS BIGINT) END AS given, CAST(-1000 - c_custkey AS BIGINT) AS padded FROM customer")
def f34_strict_int(t: Testbed) -> DataFrame:
    key = F.col("c_custkey")
    given = F.when(key % 3 == 0, F.concat(F.lit(" +"), key.cast("string"), F.lit("\n"))).when(key % 3 == 1, "").otherwise(F.concat(key.cast("string"), F.lit(".0")))
    return t.table("customer").select("c_custkey", text.strict_int(given, 7).alias("given"), text.strict_int(F.regexp_replace((-1000 - key).cast("string"), "^-(.)", "-$1_")).alias("padded"))


@query("SELECT person_id, CAST(1 AS BIGINT) AS identifiers, CAST(CASE WHEN birth_year IS NULL THEN 1 ELSE 2 END AS BIGINT) AS attributes FROM person", "person")
def e25_legacy_values(t: Testbed) -> DataFrame:
    from .sources.imports import legacy_values

    of = lambda p, v: F.struct(F.lit(p).alias("platform"), F.col(v).cast("string").alias("value"))
    each = t.person().select("person_id", F.explode(F.array(of("GitHub-Login", "person_id"), of("Real-Name", "name"), of("bio", "birth_year"))).alias("x")).select("person_id", "x.*", F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("source"))
    found, described = legacy_values(each.filter("value IS NOT NULL"))
    return found.join(described, "person_id", "full").select("person_id", F.size("identifiers").cast("long").alias("identifiers"), F.size("attributes").cast("long").alias("attributes"))


@query("SELECT c_custkey AS entity_id, CAST(CASE WHEN c_custkey % 2 = 0 THEN 10 ELSE 11 END AS BIGINT) AS missing FROM customer")
def h01_missing_fields(t: Testbed) -> DataFrame:
    from .sources.imports import missing_fields

    people = t.table("customer").select(F.col("c_custkey").alias("entity_id"))
    receipts = people.filter("entity_id % 2 = 0").select("entity_id", F.lit("github_api").alias("source"), F.lit("bio").alias("field"))
    old = people.select(F.col("entity_id").alias("person_id"), F.lit("github_login").alias("platform"))
    return missing_fields(people, receipts, old).select("entity_id", F.size("fields").cast("long").alias("missing"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'viaf' WHEN 1 THEN NULL ELSE 'orcid' END AS scheme FROM customer")
def h03_evidence_scheme(t: Testbed) -> DataFrame:
    kinds = F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("name=x"), F.lit("viaf=1"))).when(F.col("c_custkey") % 3 == 1, F.array(F.lit("orcid=1"), F.lit("viaf=1"))).otherwise(F.array(F.lit("orcid=1"), F.lit("orcid=2")))
    return t.table("customer").select("c_custkey", identity.evidence_scheme(kinds).alias("scheme"))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey
 WHERE (l_linenumber = 1 AND p_size % 4 NOT IN (0, 1)) OR (l_linenumber <> 1 AND p_size % 2 = 1)""")
def v08_scheme_contradictions(t: Testbed) -> DataFrame:
    classes = F.array(*[F.lit(c) for c in ("unique", "conditional", "non_unique", "unknown")])
    schemes = t.table("part").select(F.col("p_partkey").alias("scheme_id"), F.get(classes, F.col("p_size") % 4).alias("uniqueness_class"), F.when(F.col("p_size") % 2 == 1, "mutable").otherwise("stable").alias("mutability_class"))
    first = F.col("l_linenumber") == 1
    given = t.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("scheme_id"), F.when(first, "unique").otherwise("non_unique").alias("uniqueness"), F.when(first, "mutable").otherwise("stable").alias("stability"))
    return lanes.scheme_contradictions(given, schemes).select("l_orderkey", "l_linenumber")


@query("SELECT p_partkey FROM part WHERE p_size % 5 = 0 AND NOT (p_size % 2 = 0 AND p_size % 3 = 0)")
def v08_unfit_schemes(t: Testbed) -> DataFrame:
    size = F.col("p_size")
    rows = t.table("part").select("p_partkey", (size % 5 == 0).alias("auto_resolution_eligible"), F.when(size % 2 == 0, "unique").otherwise("unknown").alias("uniqueness_class"), F.when(size % 3 == 0, "stable").otherwise("mutable").alias("mutability_class"))
    return lanes.unfit_schemes(rows).select("p_partkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey WHERE NOT starts_with(p_type, 'PROMO')")
def v10_wrong_kind(t: Testbed) -> DataFrame:
    entities = t.table("part").select(F.col("p_partkey").alias("entity_id"), F.when(F.startswith("p_type", F.lit("PROMO")), "work").otherwise("concept").alias("entity_kind"))
    return lanes.wrong_kind(t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", entities).select("l_orderkey", "l_linenumber")


@query("SELECT 'P2' AS severity, count(*) AS n FROM (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1) HAVING count(*) > 0")
def a23_severity_counts(t: Testbed) -> DataFrame:
    changes = t.table("lineitem").select(F.col("l_suppkey").alias("request"), F.col("l_partkey").cast("string").alias("path"))
    return lanes.severity_counts(bridges.merge_risk(changes))


def lane_records(t: Testbed, **parts) -> DataFrame:
    """Events as records of a lane; `parts` are JSON texts put into each."""
    day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    before = F.when(F.col("event_id") % 7 == 0, F.lit("1990-01-01T00:00:00Z")).otherwise(day)
    source = F.struct(F.lit("s").alias("source_id"), F.lit("p").alias("snapshot_id"), F.col("event_id").cast("string").alias("record_native_id"), day.alias("observed_at"), before.alias("retrieved_at"), F.lit("t").alias("terms_revision"), F.lit("open_data").alias("rights_state"), F.sha2(F.col("event_id").cast("string"), 256).alias("payload_sha256"))
    head = F.to_json(F.struct(F.lit("pg-observation-0.1").alias("envelope_version"), source.alias("source"), F.lit("x").alias("raw_pointer")))
    tail = F.concat(*[F.concat(F.lit(f', "{k}": '), v) for k, v in parts.items()], F.lit(', "subject": {"kind": "event", "source_native_id": "n", "label": "", "attributes": {}}}'))
    return t.observations().select("event_id", F.concat(F.regexp_replace(head, r"\}$", ""), tail).alias("raw"))


@query("""SELECT event_id, CAST(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS late, CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS agents, CAST(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS issues FROM events""")
def v02_software_issues(t: Testbed) -> DataFrame:
    agent = F.when(F.col("event_id") % 3 == 0, "work").otherwise("account")
    contributions = F.concat(F.lit('[{"role": "r", "observed_at": "2024-01-01T00:00:00Z", "agent": {"kind": "'), agent, F.lit('", "source_native_id": "a", "label": ""}}]'))
    checked = lanes.lane_issues(lane_records(t, identifiers=F.lit("[]"), contributions=contributions, relationships=F.lit("[]"), evidence=F.lit("[]")), "raw", "software")
    count = lambda code: F.size(F.filter("issues", lambda i: i["code"] == code)).cast("long")
    return checked.select("event_id", count("source.time_order").alias("late"), count("agent.kind").alias("agents"), F.size("issues").cast("long").alias("issues"))


@query("""SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS twice, CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS models, CAST(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS issues FROM events""")
def v03_creator_issues(t: Testbed) -> DataFrame:
    one = lambda v: F.concat(F.lit('{"scheme": "ORCID", "scope": "global", "stability": "stable", "uniqueness": "unique", "evidence": "e", "value": "'), v.cast("string"), F.lit('"}'))
    identifiers = F.concat(F.lit("["), one(F.col("event_id")), F.lit(","), one(F.when(F.col("event_id") % 5 == 0, F.col("event_id")).otherwise(-1)), F.lit("]"))
    evidence = F.concat(F.lit('[{"kind": "k", "locator": "l", "inference": '), F.when(F.col("event_id") % 3 == 0, "false").otherwise("true"), F.lit(', "model": {"name": "m", "version": "1", "input_sha256": "'), F.sha2(F.lit("x"), 256), F.lit('"}}]'))
    checked = lanes.lane_issues(lane_records(t, identifiers=identifiers, contributions=F.lit("[]"), relationships=F.lit("[]"), evidence=evidence), "raw", "creators")
    count = lambda code: F.size(F.filter("issues", lambda i: i["code"] == code)).cast("long")
    return checked.select("event_id", count("identifier.duplicate").alias("twice"), count("evidence.model_not_inference").alias("models"), F.size("issues").cast("long").alias("issues"))


@query("""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'old:' || c_custkey ELSE 'new' END AS claim, CASE WHEN c_custkey % 3 = 0 THEN 'accepted' WHEN c_custkey % 2 = 0 AND c_custkey % 5 = 0 THEN 'rejected' ELSE 'proposed' END AS status,
 CASE WHEN c_custkey % 2 = 1 THEN 'inserted' WHEN c_custkey % 3 = 0 THEN 'accepted' ELSE 'kept' END AS action, c_custkey FROM customer""")
def g22_claims_written(t: Testbed) -> DataFrame:
    key = F.col("c_custkey")
    found = t.table("customer").select(key.cast("string").alias("entity_a"), F.lit("z").alias("entity_b"), F.lit("shared_external_id").alias("method"), F.lit(0.995).alias("confidence"), (key % 3 == 0).alias("auto_eligible"), F.array(F.lit("viaf=1")).alias("evidence"), F.array().cast("array<string>").alias("conflicts"))
    old = t.table("customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("old:"), key).alias("claim_id"), key.cast("string").alias("person_a"), F.lit("z").alias("person_b"), F.lit("shared_external_id").alias("method"), F.lit(0.5).alias("confidence"), F.lit("{}").alias("evidence"), F.when(key % 5 == 0, "rejected").otherwise("proposed").alias("status"), F.lit(None).cast("string").alias("decided_by"), F.lit("2020").alias("created_at"))
    out = identity.claims_written(old, found, "2024", auto_accept=True)
    return out.select(F.when(F.startswith("claim_id", F.lit("old:")), F.col("claim_id")).otherwise("new").alias("claim"), "status", "action", F.col("person_a").cast("long").alias("c_custkey"))


@query("SELECT entity_id, min(entity_id) OVER (PARTITION BY digest) AS canonical_id, entity_id <> min(entity_id) OVER (PARTITION BY digest) AS redirected, count(*) OVER (PARTITION BY digest) AS members FROM entities", "entities")
def g20_resolved(t: Testbed) -> DataFrame:
    people = t.entities()
    least = people.groupBy("digest").agg(F.min("entity_id").alias("canonical_id"))
    members = people.join(least, "digest").select("entity_id", F.col("digest").alias("cluster_id"), "canonical_id")
    return identity.resolved(members, people).select("entity_id", "canonical_id", "redirected", F.size("members").cast("long").alias("members"))


@query("""SELECT person_a, person_b, CASE WHEN k % 4 = 0 THEN 'accepted' WHEN k % 4 = 3 THEN 'rejected' ELSE 'proposed' END AS review_state FROM (SELECT 'c:' || c_custkey AS person_a, 'd:' || c_custkey AS person_b, c_custkey AS k FROM customer)""")
def e27_imported_claims(t: Testbed) -> DataFrame:
    from .sources.imports import import_people

    k = F.col("c_custkey")
    base = t.table("customer")
    person = base.select(F.concat(F.lit("c:"), k).alias("person_id"), F.col("c_name").alias("name")).unionByName(base.select(F.concat(F.lit("d:"), k).alias("person_id"), F.col("c_name").alias("name")))
    person = person.select("*", *[F.lit(None).cast("string").alias(c) for c in ("kind", "origin", "state")], *[F.lit(None).cast("int").alias(c) for c in ("birth_year", "death_year")])
    # a fourth of the claims each: by a scheme that may decide, by one that may not, of nobody, and rejected
    proof = F.when(k % 4 == 0, "orcid=0000").when(k % 4 == 1, "company=x").otherwise("{}")
    claims = base.select(k.cast("string").alias("claim_id"), F.concat(F.lit("d:"), k).alias("person_a"), F.concat(F.lit("c:"), k).alias("person_b"), F.when(k % 4 < 2, "shared_external_id").otherwise("exact_name").alias("method"), F.lit(0.9).alias("confidence"), proof.alias("evidence"), F.when(k % 4 == 3, "rejected").otherwise("accepted").alias("status"), F.lit(None).cast("string").alias("decided_by"))
    old = person.select("person_id", F.lit("github_login").alias("platform"), F.col("name").alias("value"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("source"))
    found = import_people(person, old, claims, "2024-01-01T00:00:00Z").candidates
    return found.select(F.col("entity_a").alias("person_a"), F.col("entity_b").alias("person_b"), "review_state")


@query("""SELECT 'records_by_source' AS metric, 'events' AS key, count(*) AS n FROM events UNION ALL SELECT 'subjects_by_kind', 'event', count(*) FROM events UNION ALL SELECT 'rights_states', 'open_data', count(*) FROM events
 UNION ALL SELECT 'identifier_schemes', 'github_event_id', count(*) FROM events UNION ALL SELECT 'relationship_types', 'performed_by', count(*) FROM events UNION ALL SELECT 'relationship_types', 'occurred_on', count(*) FROM events""")
def a18_counters(t: Testbed) -> DataFrame:
    return metrics.counters(event_envelopes(t))


@query("""SELECT count(*) AS records, CAST(1 AS BIGINT) AS sources, CAST(0 AS BIGINT) AS contribution_edges, CAST(2 * count(*) AS BIGINT) AS relationship_edges, CAST(count(*) AS BIGINT) AS identifier_observations, count(*) AS temporal_events,
 count(DISTINCT event_id) AS stable_unique_identifiers, CAST(100.0 AS DOUBLE) AS rights_percent, CAST(0.0 AS DOUBLE) AS license_percent FROM events""")
def a18_software_summary(t: Testbed) -> DataFrame:
    return metrics.software_summary(event_envelopes(t)).select("records", "sources", "contribution_edges", "relationship_edges", "identifier_observations", "temporal_events", "stable_unique_identifiers", F.col("rights_percent").cast("double").alias("rights_percent"), F.col("license_percent").cast("double").alias("license_percent"))


@query("SELECT count(*) AS records, count(*) AS works_and_appearances, CAST(0 AS BIGINT) AS contribution_edges, count(DISTINCT event_id) AS unique_source_subjects, CAST(0 AS BIGINT) AS candidates FROM events")
def a20_creator_summary(t: Testbed) -> DataFrame:
    return metrics.creator_summary(event_envelopes(t)).select("records", "works_and_appearances", "contribution_edges", "unique_source_subjects", "candidates")


@query("SELECT 'pkg:pypi/' || lower(replace(p_brand, '#', '')) || '-' || p_partkey AS subject, CAST(2 AS INTEGER) AS ids FROM part UNION ALL SELECT 'pkg:pypi/' || lower(replace(p_brand, '#', '')) || '-' || p_partkey || '@1.' || p_size, CAST(1 AS INTEGER) FROM part")
def e05_pypi_envelopes(t: Testbed) -> DataFrame:
    none = F.lit(None)
    rows = t.table("part").select(F.concat_ws("_", F.replace("p_brand", F.lit("#"), F.lit("")), "p_partkey").alias("name"), *[none.cast("string").alias(c) for c in ("summary", "license", "requires_python")], none.cast("boolean").alias("abandoned"), none.cast(adapters.OWNERS).alias("owners"), none.cast(adapters.PLACES).alias("source_repositories"), F.array(F.struct(F.concat(F.lit("1."), "p_size").alias("version"), none.cast("string").alias("published_at"))).alias("versions"))
    return adapters.pypi_packages(rows, SOURCE).select(F.col("subject.source_native_id").alias("subject"), F.size("identifiers").alias("ids"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS subject, CAST(count(*) AS INTEGER) AS authors, CAST(max(l_linenumber) AS INTEGER) AS last FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def e16_catalogue_works(t: Testbed) -> DataFrame:
    lines = t.table("lineitem").groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("l"))
    none = lambda *c: [F.lit(None).cast("string").alias(x) for x in c]
    author = lambda x: F.struct(F.struct(x["l_suppkey"].cast("string").alias("id"), x["l_linenumber"].cast("string").alias("display_name"), F.lit(None).cast("string").alias("orcid")).alias("author"))
    e = adapters.catalogue_works(lines.select("id", *none("display_name", "title", "type", "publication_date", "updated_date", "doi"), F.transform("l", author).alias("authorships")), SOURCE)
    return e.select(F.col("subject.source_native_id").alias("subject"), F.size("contributions").alias("authors"), F.element_at("contributions", -1)["agent"]["label"].cast("int").alias("last"))


@query("SELECT CAST(event_id AS VARCHAR) AS subject, CASE WHEN event_id % 2 = 0 THEN 'host' ELSE 'guest' END AS role, CAST(user_id AS VARCHAR) AS person FROM events")
def e12_podcast_episodes(t: Testbed) -> DataFrame:
    none = lambda *c: [F.lit(None).cast("string").alias(x) for x in c]
    person = F.struct(F.col("user_id").cast("string").alias("id"), F.lit("n").alias("name"), F.lit(None).cast("string").alias("href"), F.when(F.col("event_id") % 2 == 0, "Host").alias("role"))
    e = adapters.podcast_episodes(t.observations().select(F.col("event_id").cast("string").alias("id"), *none("guid", "enclosure_url", "title", "feed_id", "feed_title", "transcript_url"), F.array(person).alias("persons")), SOURCE)
    first = F.element_at("contributions", 1)
    return e.select(F.col("subject.source_native_id").alias("subject"), first["role"].alias("role"), first["agent"]["source_native_id"].alias("person"))


@query("""SELECT 'c:' || c_custkey AS person_id, CAST(CASE WHEN c_mktsegment <> 'BUILDING' THEN 1900 END AS INTEGER) AS birth_year, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'linked' ELSE 'tracked' END AS state FROM customer
 UNION ALL SELECT 'bk:s' || s_suppkey, NULL, CASE WHEN s_suppkey IN (SELECT l_suppkey FROM lineitem) THEN 'linked' ELSE 'tracked' END FROM supplier""")
def g27_built_people(t: Testbed) -> DataFrame:
    none = lambda kind, *c: [F.lit(None).cast(kind).alias(x) for x in c]
    customer, supplier = t.table("customer"), t.table("supplier")
    known = customer.select(F.concat(F.lit("c:"), "c_custkey").alias("person_id"), F.col("c_name").alias("name"), F.lit("github").alias("origin"), *none("double", "rank_score"))
    books = customer.select(F.concat(F.lit("b"), "c_custkey").alias("person_key"), F.concat(F.lit("  "), F.upper("c_name")).alias("display_name"), F.lit(1900).alias("birth_year"), (F.col("c_mktsegment") == "BUILDING").alias("is_corporate"))
    books = books.unionByName(supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("person_key"), F.col("s_name").alias("display_name"), *none("int", "birth_year"), F.lit(False).alias("is_corporate"))).select("*", *none("int", "death_year", "work_count"))
    moved = t.table("orders").select(F.concat(F.lit("c:"), "o_custkey").alias("person_id"), F.lit("order").alias("domain"), F.col("o_orderkey").cast("string").alias("content_ref"), *none("double", "score"), *none("string", "title"))
    works = t.table("lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("person_key"), F.col("l_partkey").cast("long").alias("gid"), F.lit("author").alias("role"))
    part = t.table("part").select(F.col("p_partkey").cast("long").alias("gid"), F.col("p_name").alias("title"), F.col("p_type").alias("subject"))
    built = rollups.build_graph(known, moved, known.select("person_id", F.lit("name").alias("platform"), F.col("name").alias("value")), books, works, part.select("gid", "title"), part.select("gid", "subject"), "now")
    return built.person.select("person_id", "birth_year", "state")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus AS local_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate <= DATE '1995-06-17' AND o_orderdate > DATE '1994-01-01' AND l_returnflag = 'R'")
def j17_relationships_at(t: Testbed) -> DataFrame:
    types = t.table("orders").select(F.col("o_orderkey").alias("relationship_type_id"), F.lit("n").alias("namespace"), F.col("o_orderstatus").alias("local_name"))
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("relationship_type_id"), F.col("l_suppkey").alias("subject_entity_id"), F.when(F.col("l_returnflag") == "R", "accepted").otherwise("proposed").alias("review_state"), F.col("l_shipdate").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    late = t.table("orders").filter("o_orderdate > DATE '1994-01-01'").select(F.col("o_orderkey").alias("l_orderkey"))
    return graph.relationships_at(lines.join(late, "l_orderkey", "left_semi"), types, F.lit("1995-06-17").cast("date")).select("l_orderkey", "l_linenumber", "local_name")


FLAGSHIP = a04_person_layers
