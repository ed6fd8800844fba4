"""Queries through written structures: indexes, generations, published tables and the engine's pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import Catalog
from .engine import Engine
from .functions.jsonx import keys_at_any_depth
from .operators import identity, ownership
from .operators.generations import Generations
from .operators.published import Change, Published, Rejected, append_only, check, reference, unique
from .operators.textindex import TextIndex
from .plans.scratch import Scratch
from .plans.testbed import Testbed
from .queries import query
from .sources import linked, sinks
from .streaming import observations

#: Tokens of a text as the index has them.
TOKENS = r"list_filter(regexp_split_to_array(translate(lower(coalesce({0}, '')), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ', 'aaaaaaceeeeiiiinoooooouuuuyy'), '[^\p{{L}}\p{{N}}\p{{M}}]+'), lambda w: w <> '')"
BM25 = "CAST(floor(1000000 * ln(1 + (nn - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean))) AS BIGINT)"


def _documents(t: Testbed, what: str) -> TextIndex:
    return TextIndex.build(t.spark, Scratch(t.spark, what).root, t.table("documents"), "doc_id", F.col("text"))


def _micro(score) -> F.Column:
    return F.floor(score * 1000000).cast("long")


# ---------------------------------------------------------------- the written text index


@query(f"SELECT doc_id, CAST(len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS INTEGER) AS n, CAST(len(w) AS BIGINT) AS size FROM (SELECT doc_id, {TOKENS.format('text')} AS w FROM documents) WHERE n > 0")
def p11_indexed_phrase(t: Testbed) -> DataFrame:
    return _documents(t, "p11").phrase("of the").select(F.col("key").alias("doc_id"), "n", "size")


@query(f"WITH d AS (SELECT doc_id, {TOKENS.format('text')} AS w FROM documents), s AS (SELECT count(*) AS nn, sum(len(w)) / count(*) AS mean FROM d), h AS (SELECT doc_id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS n, len(w) AS size FROM d), k AS (SELECT * FROM h WHERE n > 0), c AS (SELECT count(*) AS df FROM k) SELECT doc_id, {BM25} AS score FROM k, s, c")
def o01_ranked_phrase(t: Testbed) -> DataFrame:
    found = _documents(t, "o01").ranked_phrase("of the")
    return found.select(F.col("key").alias("doc_id"), _micro(F.col("score")).alias("score"))


@query(f"""WITH d AS (SELECT doc_id, {TOKENS.format('text')} AS w FROM documents), s AS (SELECT count(*) AS nn, sum(len(w)) / count(*) AS mean FROM d), p AS (SELECT doc_id, len(w) AS size, unnest(w) AS token FROM d),
 h AS (SELECT doc_id, size, token, count(*) AS n FROM p WHERE token IN ('the', 'que', 'der') GROUP BY doc_id, size, token), c AS (SELECT token, count(*) AS df FROM h GROUP BY token)
 SELECT doc_id, CAST(round(sum(ln(1 + (nn - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean))) * 10000) AS BIGINT) AS score FROM h JOIN c USING (token), s GROUP BY doc_id""")
def o01_relevance(t: Testbed) -> DataFrame:
    found = _documents(t, "o01r").relevance("the que der")
    return found.select(F.col("key").alias("doc_id"), F.round(F.col("score") * 10000).cast("long").alias("score"))


@query(f"""WITH d AS (SELECT doc_id, CASE WHEN lang = 'de' THEN text || ' ' || source ELSE text END AS text FROM documents WHERE lang IS NULL OR lang <> 'es' UNION ALL SELECT doc_id + 1000000000, text || ' ' || lang FROM documents WHERE lang = 'fr')
 SELECT token, count(*) AS df, CAST(sum(n) AS BIGINT) AS n FROM (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS token FROM d) GROUP BY doc_id, token) GROUP BY token""")
def v13_index_in_step(t: Testbed) -> DataFrame:
    """The index after a batch that takes away, replaces and adds documents."""
    docs, no = t.table("documents"), F.lit(False).alias("gone")
    changes = docs.filter("lang = 'es'").select(F.col("doc_id").alias("key"), F.lit(None).cast("string").alias("text"), F.lit(True).alias("gone"))
    changes = changes.unionByName(docs.filter("lang = 'de'").select(F.col("doc_id").alias("key"), F.concat_ws(" ", "text", "source").alias("text"), no))
    changes = changes.unionByName(docs.filter("lang = 'fr'").select((F.col("doc_id") + 1_000_000_000).alias("key"), F.concat_ws(" ", "text", "lang").alias("text"), no))
    index = _documents(t, "v13").apply(changes)
    return index.counts().groupBy("token").agg(F.count("*").alias("df"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- pages of the engine


def _engine(t: Testbed) -> Engine:
    claims = t.spark.createDataFrame([], "person_a string, person_b string, status string, method string")
    catalog = Catalog(t.spark, {("people", "person"): t.person(), ("people", "person_content"): t.content(), ("people", "person_topic"): t.topics(), ("people", "identity_claim"): claims})
    catalog.indexes["people", "person_search"] = TextIndex.build(t.spark, Scratch(t.spark, "search").root, t.person(), "person_id", F.col("name"))
    return Engine(catalog)


@query("""WITH page AS (SELECT person_id FROM person WHERE contains(lower(name), 'customer') ORDER BY person_id LIMIT 500), c AS (SELECT person_id, coalesce(merged_into, person_id) AS live FROM person), m AS (SELECT person_id, live FROM c WHERE live IN (SELECT c.live FROM c JOIN page USING (person_id))),
 w AS (SELECT live, count(*) AS n FROM content JOIN m USING (person_id) GROUP BY live) SELECT least(min(person_id), live) AS cluster_id, coalesce(max(CASE WHEN person_id = live THEN live END), min(person_id)) AS representative, count(*) AS cluster_size, coalesce(max(n), 0) AS content_count FROM m LEFT JOIN w USING (live) GROUP BY live""", "person", "content")  # fmt: skip
def g08_who(t: Testbed) -> DataFrame:
    """The page of the first 500 rows of a name that all customers share, as people."""
    return _engine(t).who("customer", 500).rows.select("cluster_id", "representative", "cluster_size", "content_count")


@query("SELECT domain, content_ref, role FROM (SELECT * FROM content WHERE person_id IN ('c:39', 'c:40') ORDER BY domain, content_ref, role LIMIT 100)", "content")
def g09_works(t: Testbed) -> DataFrame:
    """The first page of the works of one person, found by name and merged of two rows."""
    return _engine(t).works("Customer#000000039").rows.select("domain", "content_ref", "role")


# ---------------------------------------------------------------- decisions and generations


def _stars(t: Testbed, keep: F.Column | None = None) -> DataFrame:
    """An acceptance of each document with the least document of the same text, active where `keep` of the first says so."""
    people = t.entities()
    stars = identity.block_stars(people, ["digest"]).join(people.select(F.col("entity_id").alias("v"), "origin"), "v")
    active = F.lit(True) if keep is None else keep
    return stars.select(F.concat(F.lit("d"), "v").alias("decision_id"), F.concat(F.lit("c"), "v").alias("candidate_id"), F.col("u").alias("entity_a"), F.col("v").alias("entity_b"), F.lit("accepted").alias("outcome"), active.alias("active"), F.lit(1).cast("long").alias("seq"), "origin")


@query("""WITH m AS (SELECT entity_id, origin, digest, min(entity_id) OVER (PARTITION BY digest) AS u FROM entities), leaf AS (SELECT *, first_value(origin) OVER (PARTITION BY digest ORDER BY entity_id) AS first FROM m WHERE entity_id > u)
 SELECT u AS entity_a, entity_id AS entity_b, CASE WHEN origin = first THEN 'accepted' ELSE 'cluster_conflict' END AS verdict FROM leaf""", "entities")  # fmt: skip
def g18_stars_accepted(t: Testbed) -> DataFrame:
    """All copies of a text at once, where each but the first bears its source as a unique identifier: the first of them decides."""
    wanted = _stars(t).select("candidate_id", "entity_a", "entity_b", F.array().cast("array<string>").alias("conflicts"))
    held = _stars(t).select(F.col("entity_b").alias("entity_id"), F.lit("viaf").alias("scheme"), F.col("origin").alias("value"), F.lit(None).cast("string").alias("valid_to"))
    log = t.spark.createDataFrame([], "decision_id string, candidate_id string, entity_a long, entity_b long, outcome string, active boolean, seq long")
    return identity.accept(wanted, log, held).select("entity_a", "entity_b", "verdict")


@query("""WITH m AS (SELECT entity_id, origin, min(entity_id) OVER (PARTITION BY digest) AS u FROM entities) SELECT 1 AS generation, entity_id, u AS canonical_id FROM m
 UNION ALL SELECT 2, entity_id, CASE WHEN origin = 'src1' THEN entity_id ELSE u END FROM m UNION ALL SELECT 3, entity_id, u FROM m""", "entities")  # fmt: skip
def g19_generations(t: Testbed) -> DataFrame:
    """Three generations read back: of all acceptances, of those whose second side is not of one source, and of all again."""
    people, none = t.entities(), t.spark.createDataFrame([], "entity_id long, scheme string, value string, valid_to string")
    last = Generations(t.spark, Scratch(t.spark, "generations").root)
    for log in (_stars(t), _stars(t, F.col("origin") != "src1"), _stars(t)):
        last = last.apply(people, log.drop("origin"), none)
    rows = [last.at(n).members().select(F.lit(n).alias("generation"), "entity_id", "canonical_id") for n in range(1, last.latest + 1)]
    return reduce(DataFrame.unionByName, rows)


# ---------------------------------------------------------------- streams


@query("SELECT account, alias, valid_from, valid_to FROM (SELECT *, lead(valid_from) OVER (PARTITION BY account ORDER BY valid_from, alias) AS valid_to FROM (SELECT user_id AS account, event_type AS alias, ts AS valid_from, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS before FROM events) WHERE before IS NULL OR before <> alias) WHERE valid_to <= (SELECT date_trunc('milliseconds', max(ts)) FROM events)")
def w07_settled_history(t: Testbed) -> DataFrame:
    """What users did as intervals, settled by a stream over all events, as far as its watermark has come: to the last millisecond."""
    scratch = Scratch(t.spark, "history")
    schema = t.table("events").schema
    events = t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/events.parquet*")
    rows = events.select(F.col("user_id").cast("string").alias("account"), F.col("event_type").alias("alias"), F.col("ts").cast("timestamp").alias("observed_at"))
    observations.append_sink(observations.alias_intervals(rows, late="0 seconds"), f"{scratch.root}/rows", f"{scratch.root}/log").awaitTermination()
    found = t.spark.read.parquet(f"{scratch.root}/rows").filter("valid_to IS NOT NULL")
    return found.select(F.col("account").cast("long").alias("account"), "alias", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))


# ---------------------------------------------------------------- published tables


@query("""SELECT 1 AS version, 'customer' AS what, count(*) AS n FROM customer UNION ALL SELECT 2, 'orders', count(*) FROM orders UNION ALL SELECT 2, 'orders.unique(o_orderkey)', count(*) FROM orders
 UNION ALL SELECT 2, 'orders.check price', count(*) FROM orders WHERE o_orderkey IS NOT NULL UNION ALL SELECT 2, 'orders.o_custkey of customer', count(*) FROM orders UNION ALL SELECT 3, 'orders', 2 * count(*) FROM orders""")  # fmt: skip
def v09_published_orders(t: Testbed) -> DataFrame:
    """Orders published under rules: those that break them leave the version as it was, those that don't make the next."""
    rules = [unique("orders", "o_orderkey"), reference("orders", "o_custkey", "customer", "c_custkey"), check("orders", price=F.col("o_totalprice") >= 0), append_only("orders", "o_orderkey")]
    store, orders = Published(t.spark, Scratch(t.spark, "published").root, rules), t.table("orders")
    store.commit({"customer": Change(t.table("customer"))})
    store.commit({"orders": Change(orders)})
    said = []
    for bad in (orders, orders.withColumns({"o_orderkey": -1 - F.col("o_orderkey"), "o_custkey": -5 - F.col("o_custkey"), "o_totalprice": -1 - F.col("o_totalprice")})):
        try:
            store.commit({"orders": Change(bad)})
        except Rejected as e:
            said += [(store.version(), rule, n) for rule, n, _ in e.findings]
    store.commit({"orders": Change(orders.unionByName(orders.withColumn("o_orderkey", -1 - F.col("o_orderkey"))), "ignore", ("o_orderkey",))})
    rows = t.spark.createDataFrame(said, "version int, what string, n long")
    for version, name in ((1, "customer"), (2, "orders"), (3, "orders")):
        rows = rows.unionByName(store.table(name, version).agg(F.count("*").alias("n")).select(F.lit(version).alias("version"), F.lit(name).alias("what"), "n"))
    return rows


# ---------------------------------------------------------------- owners of paths


@query("""WITH p AS (SELECT DISTINCT p_brand || '/' || replace(p_type, ' ', '/') || '/' || p_partkey || '.py' AS path, p_brand, p_type, p_partkey FROM part),
 o AS (SELECT DISTINCT p_brand || '/**' AS pattern, p_brand AS owner FROM part UNION SELECT DISTINCT p_brand || '/' || split_part(p_type, ' ', 1) || '/**', p_brand || ' ' || split_part(p_type, ' ', 1) FROM part WHERE p_partkey % 2 = 0 UNION SELECT '*7.py', 'sevens')
 SELECT path, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.owner = p.p_brand || ' ' || split_part(p.p_type, ' ', 1)) THEN p.p_brand || ' ' || split_part(p.p_type, ' ', 1) ELSE p.p_brand END AS owner, CAST(1 + CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.owner = p.p_brand || ' ' || split_part(p.p_type, ' ', 1)) THEN 1 ELSE 0 END + CASE WHEN p_partkey % 10 = 7 THEN 1 ELSE 0 END AS BIGINT) AS owners FROM p""")  # fmt: skip
def h20_path_owners(t: Testbed) -> DataFrame:
    """Files named by brand, type and key, owned by brands, by some types of brands and by a glob: the most specific and how many."""
    part, repo = t.table("part"), F.lit("r").alias("repository")
    first = F.split("p_type", " ")[0]
    paths = part.select(repo, F.concat("p_brand", F.lit("/"), F.replace("p_type", F.lit(" "), F.lit("/")), F.lit("/"), "p_partkey", F.lit(".py")).alias("path"))
    owned = part.select(repo, F.col("p_brand").alias("owner"), F.concat("p_brand", F.lit("/**")).alias("pattern")).unionByName(part.filter("p_partkey % 2 = 0").select(repo, F.concat_ws(" ", "p_brand", first).alias("owner"), F.concat("p_brand", F.lit("/"), first, F.lit("/**")).alias("pattern"))).distinct()
    owned = owned.unionByName(t.spark.createDataFrame([("r", "sevens", "*7.py")], "repository string, owner string, pattern string"))
    return ownership.most_specific(paths, owned).filter("owners > 0").select("path", "owner", "owners")


# ---------------------------------------------------------------- database files and lines, published as a whole


def _by_customer(t: Testbed, conflict: str) -> DataFrame:
    """Orders of three statuses, a batch each, put by customer into a table of database files."""
    path, orders = Scratch(t.spark, conflict).root, t.table("orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").cast("string").alias("day"))
    for status in ("F", "O", "P"):
        sinks.upsert_files(orders.filter(F.col("o_orderstatus") == status), path, "latest", ["o_custkey"], ["day", "o_orderkey"], conflict, batch=status)
        sinks.upsert_files(orders, path, "latest", ["o_custkey"], ["day"], conflict, batch=status)  # a batch that is there: nothing changes
    return sinks.read_files(t.spark, path, "latest")


BY_CUSTOMER = "SELECT o_custkey, o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus{0}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR){0}, o_orderkey{0}) AS n FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')) WHERE n = 1"


@query(BY_CUSTOMER.format(""))
def s14_insert_or_ignore(t: Testbed) -> DataFrame:
    return _by_customer(t, "ignore")


@query(BY_CUSTOMER.format(" DESC"))
def s15_insert_or_replace(t: Testbed) -> DataFrame:
    return _by_customer(t, "replace")


@query("SELECT '{\"customer\":' || o_custkey || ',\"day\":\"' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '\",\"order\":' || o_orderkey || ',\"status\":\"' || o_orderstatus || '\"}' AS value FROM orders")
def s07_published_lines(t: Testbed) -> DataFrame:
    """Orders as canonical NDJSON by customer and day, whole once it is there."""
    path, orders = Scratch(t.spark, "lines").root, t.table("orders")
    rows = orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("order"), F.col("o_orderdate").cast("date").cast("string").alias("day"), F.col("o_orderstatus").alias("status"))
    sinks.publish_ndjson(rows, path, ["customer", "day", "order"])
    return sinks.published_ndjson(t.spark, path)


# ---------------------------------------------------------------- linked data, and keys at any depth


def _order_pages(t: Testbed) -> DataFrame:
    """A page for each order: a graph of a book with its author, editor and organiser, and of the customer as a person."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    book = F.format_string('{"@type": ["http://schema.org/Book"], "@id": "order:%s", "name": "Order %s", "author": [{"name": "Customer %s", "sameAs": ["http://c/%s", "http://d/%s"]}], "editor": "%s", "organizer": {"@type": "Organization", "name": "%s", "url": "http://s/%s", "sameAs": null}}', k, k, c, c, c, F.col("o_orderpriority"), "o_orderstatus", "o_orderstatus")
    who = F.format_string('{"@type": "Person", "name": "Customer %s"}', c)
    html = F.concat(F.lit('<p>x</p><script type="application/ld+json">{"@graph": [['), book, F.lit("], {"), F.lit('"@graph": '), who, F.lit("}]}</script>"))
    return t.table("orders").select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("http://o/"), k).alias("url"), html.alias("html"))


PAGE_SOURCE = {"source_id": "pages", "snapshot_id": "", "observed_at": "2024-01-01T00:00:00Z", "retrieved_at": "2024-01-01T00:00:00Z", "terms_revision": "t", "rights_state": "pending"}


@query("""SELECT 'order:' || o_orderkey AS subject, 'work' AS kind, 'Order ' || o_orderkey AS label, 'author,editor,organizer' AS roles, 'label:Customer ' || o_custkey || ',label:' || o_orderpriority || ',http://s/' || o_orderstatus AS agents, 'http://o/' || o_orderkey AS page FROM orders
 UNION ALL SELECT 'http://o/' || o_orderkey || '#jsonld-node-1', 'person', 'Customer ' || o_custkey, '', '', 'http://o/' || o_orderkey || '#jsonld-node-1' FROM orders""")
def e19_page_observations(t: Testbed) -> DataFrame:
    found, each = linked.page_observations(_order_pages(t), PAGE_SOURCE), F.col("contributions")
    joined = lambda f: F.array_join(F.transform(each, f), ",")
    return found.select(F.col("subject.source_native_id").alias("subject"), "subject.kind", "subject.label", joined(lambda c: c["role"]).alias("roles"), joined(lambda c: c["agent"]["source_native_id"]).alias("agents"), F.col("identifiers")[0]["value"].alias("page"))


@query("""SELECT scheme, value, count(*) AS n FROM (SELECT 'page_url' AS scheme, 'http://o/' || o_orderkey AS value FROM orders UNION ALL SELECT 'page_url', 'http://o/' || o_orderkey || '#jsonld-node-1' FROM orders UNION ALL SELECT 'same_as_url', 'http://c/' || o_custkey FROM orders
 UNION ALL SELECT 'same_as_url', 'http://d/' || o_custkey FROM orders UNION ALL SELECT 'official_website', 'http://s/' || o_orderstatus FROM orders) GROUP BY scheme, value""")
def h29_all_identifiers(t: Testbed) -> DataFrame:
    return linked.all_identifiers(linked.page_observations(_order_pages(t), PAGE_SOURCE)).groupBy("scheme", "value").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey AS orderkey, array_to_string(list_sort(list_distinct(list_concat(['lines', 'modes', 'l_quantity'], list('tax ' || CAST(round(l_tax * 100) AS INTEGER)), list('flag \"' || lower(l_returnflag) || '\"')))), ',') AS keys FROM lineitem GROUP BY l_orderkey")
def f25_nested_keys(t: Testbed) -> DataFrame:
    """Keys of a document for each order, nested in lists and objects, some with quotes."""
    line = F.struct(F.create_map(F.concat(F.lit("Tax "), F.round(F.col("l_tax") * 100).cast("int").cast("string")), F.struct("l_quantity")).alias("modes"))
    flags = F.map_from_entries(F.transform(F.collect_set("l_returnflag"), lambda f: F.struct(F.concat(F.lit('Flag "'), f, F.lit('"')), F.array(F.lit('a": "b')))))
    text = F.concat(F.lit('{"lines": [['), F.array_join(F.collect_list(F.to_json(line)), ","), F.lit("]], \"modes\": "), F.to_json(flags), F.lit("}"))
    rows = t.table("lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(text.alias("text"))
    return rows.select("orderkey", F.array_join(keys_at_any_depth(F.col("text")), ",").alias("keys"))
