"""The graph model over the driver's tables, as DataFrames and as the same views in SQL.

Customers and suppliers are people and organisations, parts and orders are works, part types and brands are topics in two
vocabularies, documents are identity entities (exact copies share a unique identifier), events are observations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Testbed:
    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def person(self) -> DataFrame:
        years = self.table("orders").groupBy("o_custkey").agg(F.year(F.min("o_orderdate")).alias("birth_year"), F.year(F.max("o_orderdate")).alias("last_year"))
        key = F.col("c_custkey")
        customers = self.table("customer").join(years, key == F.col("o_custkey"), "left").select(
            F.concat(F.lit("c:"), key).alias("person_id"), F.col("c_name").alias("name"), F.lit("human").alias("kind"), F.when(key % 40 == 0, "merged").otherwise("linked").alias("state"),
            F.when(key % 40 == 0, F.concat(F.lit("c:"), key - 1)).alias("merged_into"), "birth_year", F.when(key % 2 == 0, F.col("last_year")).alias("death_year"), F.lit("customer").alias("origin"), F.col("c_acctbal").alias("rank_score"),
        )
        suppliers = self.table("supplier").select(
            F.concat(F.lit("s:"), F.col("s_suppkey")).alias("person_id"), F.col("s_name").alias("name"), F.lit("organisation").alias("kind"), F.lit("tracked").alias("state"), F.lit(None).cast("string").alias("merged_into"),
            F.lit(None).cast("int").alias("birth_year"), F.lit(None).cast("int").alias("death_year"), F.lit("supplier").alias("origin"), F.col("s_acctbal").alias("rank_score"),
        )
        return customers.unionByName(suppliers)

    def _works(self) -> list[tuple[str, str, str, DataFrame]]:
        """(prefix, domain, role, distinct keys of person and work): numbers are a fraction of the strings that they become."""
        lines, orders = self.table("lineitem"), self.table("orders")
        buyers = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("person"), F.col("l_partkey").alias("work"))
        sellers = lines.select(F.col("l_suppkey").alias("person"), F.col("l_partkey").alias("work"))
        owners = orders.select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("work"))
        return [(*what, keys.distinct()) for *what, keys in (("c:", "part", "buyer", buyers), ("s:", "part", "supplier", sellers), ("c:", "order", "owner", owners))]

    def content(self) -> DataFrame:
        """The three kinds differ in role, so rows are distinct within each."""
        each = [keys.select(F.concat(F.lit(prefix), "person").alias("person_id"), F.lit(domain).alias("domain"), F.col("work").cast("string").alias("content_ref"), F.lit(role).alias("role")) for prefix, domain, role, keys in self._works()]
        return reduce(DataFrame.unionByName, each)

    def topics(self) -> DataFrame:
        """A prefix has one role among parts, so what it counts by number is a person's."""
        parts = self.table("part").select(F.col("p_partkey").alias("work"), F.explode(F.array(F.struct(F.lit("type").alias("scheme"), F.col("p_type").alias("topic")), F.struct(F.lit("brand").alias("scheme"), F.col("p_brand").alias("topic")))).alias("t"))
        each = [keys.join(parts, "work").groupBy("person", F.col("t.topic").alias("topic"), F.col("t.scheme").alias("scheme")).agg(F.count("*").cast("double").alias("weight")).select(F.concat(F.lit(prefix), "person").alias("person_id"), "topic", "scheme", "weight") for prefix, domain, _, keys in self._works() if domain == "part"]
        return reduce(DataFrame.unionByName, each)

    def entities(self) -> DataFrame:
        """Identity entities: the label is a text's first two words."""
        words = F.filter(F.split(F.col("text"), r"\s+", 4), lambda w: w != "")  # the first may be empty, the last is the rest
        return self.table("documents").select(F.col("doc_id").alias("entity_id"), F.array_join(F.slice(words, 1, 2), " ").alias("label"), F.when(F.col("lang") == "en", "human").otherwise("organisation").alias("kind"), F.col("source").alias("origin"), F.sha2("text", 256).alias("digest"))

    def observations(self) -> DataFrame:
        return self.table("events").select("event_id", "ts", "user_id", "event_type", "value", "props")


#: The same views for an ANSI engine that has the driver's tables.
VIEWS = {
    "years": "SELECT o_custkey, CAST(year(min(o_orderdate)) AS INTEGER) AS birth_year, CAST(year(max(o_orderdate)) AS INTEGER) AS last_year FROM orders GROUP BY o_custkey",
    "person": """SELECT 'c:' || c_custkey AS person_id, c_name AS name, 'human' AS kind, CASE WHEN c_custkey % 40 = 0 THEN 'merged' ELSE 'linked' END AS state,
      CASE WHEN c_custkey % 40 = 0 THEN 'c:' || (c_custkey - 1) END AS merged_into, birth_year, CASE WHEN c_custkey % 2 = 0 THEN last_year END AS death_year, 'customer' AS origin, c_acctbal AS rank_score
      FROM customer LEFT JOIN years ON c_custkey = o_custkey
      UNION ALL SELECT 's:' || s_suppkey, s_name, 'organisation', 'tracked', NULL, NULL, NULL, 'supplier', s_acctbal FROM supplier""",
    "content": """SELECT DISTINCT 'c:' || o_custkey AS person_id, 'part' AS domain, CAST(l_partkey AS VARCHAR) AS content_ref, 'buyer' AS role FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      UNION SELECT 's:' || l_suppkey, 'part', CAST(l_partkey AS VARCHAR), 'supplier' FROM lineitem
      UNION SELECT 'c:' || o_custkey, 'order', CAST(o_orderkey AS VARCHAR), 'owner' FROM orders""",
    "part_topics": "SELECT CAST(p_partkey AS VARCHAR) AS content_ref, 'type' AS scheme, p_type AS topic FROM part UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'brand', p_brand FROM part",
    "topics": "SELECT person_id, topic, scheme, CAST(count(*) AS DOUBLE) AS weight FROM content JOIN part_topics USING (content_ref) WHERE domain = 'part' GROUP BY person_id, topic, scheme",
    "entities": r"""SELECT doc_id AS entity_id, array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')[1:2], ' ') AS label, CASE WHEN lang = 'en' THEN 'human' ELSE 'organisation' END AS kind, source AS origin, sha256(text) AS digest FROM documents""",
}


def sql(query: str, *views: str) -> str:
    """A query with the views that it names, and those that they need, before it."""
    needs = {"person": ("years",), "topics": ("content", "part_topics")}
    wanted: list[str] = []
    for v in views:
        wanted += [n for n in (*needs.get(v, ()), v) if n not in wanted]
    return ("WITH RECURSIVE " if "RECURSIVE" in query else "WITH ") + ", ".join(f"{v} AS ({VIEWS[v]})" for v in wanted) + (", " if query.lstrip().startswith("WITH ") else " ") + query.lstrip().removeprefix("WITH RECURSIVE ").removeprefix("WITH ") if wanted else query
