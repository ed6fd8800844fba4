"""Linked data in web pages: blocks of a page, nodes at any depth, and observations of them. All of it is built in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import ld_blocks
from ..plans.scratch import Scratch
from .adapters import IDENTIFIER, agent, contribution, envelope, identifier

# What a node's type says of its kind, and of the type of a work.
KINDS = {
    "Person": ("person", None), "Organization": ("organisation", None), "Corporation": ("organisation", None), "Article": ("work", "article"), "BlogPosting": ("work", "article"), "NewsArticle": ("work", "article"), "Book": ("work", "book"),
    "Course": ("work", "course"), "PodcastSeries": ("work", "podcast_show"), "PodcastEpisode": ("work", "podcast_episode"), "VideoObject": ("work", "video"), "CreativeWork": ("work", "creative_work"), "Event": ("event", "event"),
    "EducationEvent": ("event", "course_event"), "PublicationEvent": ("event", "publication_event"), "Place": ("place", None),
}
# Fields that name contributors, with their roles, and fields kept as attributes.
ROLES = {"author": "author", "creator": "creator", "editor": "editor", "performer": "performer", "actor": "speaker", "contributor": "contributor", "organizer": "organizer"}
KEPT = ("affiliation", "dateModified", "datePublished", "endDate", "inLanguage", "isPartOf", "jobTitle", "location", "startDate")
# Fields for a node's identity and its label, the first that is text counts.
IDENTITY, LABEL = ("@id", "url", "identifier"), ("name", "headline", "title")
# Levels of lists and graphs that are stepped into within a row.
STEPS = 4


def _get(node: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(node, f"$['{key}']", kind)


def _shape(v: Column) -> Column:
    """STRING, ARRAY<..>, OBJECT<..>, VOID and so on; empty for what is absent."""
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def _text(node: Column, key: str) -> Column:
    """A field that is text, else null."""
    return F.when(_shape(_get(node, key)) == "STRING", _get(node, key, "string"))


def _listed(v: Column) -> Column:
    """The texts of a field that is a text or a list, with their place in it; other members of the list are null."""
    many = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(_shape(v) == "STRING", F.array(F.try_variant_get(v, "$", "string"))).when(_shape(v).startswith("ARRAY"), many), none)


def _types(node: Column) -> Column:
    """Names of a node's types, without what is before their last slash."""
    v = _get(node, "@type")
    many = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string"))
    found = F.when(_shape(v) == "STRING", F.array(F.try_variant_get(v, "$", "string"))).when(_shape(v).startswith("ARRAY"), many)
    return F.coalesce(F.transform(F.array_compact(found), lambda t: F.substring_index(t, "/", -1)), F.array().cast("array<string>"))


def _links(node: Column, receipt: Column) -> Column:
    """`sameAs` links as identifiers, each with its place."""
    of = F.transform(_listed(_get(node, "sameAs")), lambda u, i: F.when(F.trim(u) != "", identifier("same_as_url", F.trim(u), "unknown", "unknown", "global", F.concat(receipt, F.lit(" sameAs["), i.cast("string"), F.lit("]")))))
    return F.array_compact(of).cast(IDENTIFIER)


def _placed(path: Column, node: Column) -> Column:
    """A node with its place and, if it is a list or has a graph, what it holds."""
    graph = F.filter(F.array(F.try_variant_get(node, '$["@graph"]', "variant")), lambda g: g.isNotNull() & ~F.is_variant_null(g))
    return F.struct(path.alias("path"), node.alias("node"), F.coalesce(F.try_variant_get(node, "$", "array<variant>"), F.when(F.size(graph) > 0, graph)).alias("holds"))


def _stepped(found: Column) -> Column:
    """Nodes with what each holds in its stead."""
    return F.flatten(F.transform(found, lambda n: F.when(n["holds"].isNull(), F.array(n)).otherwise(F.transform(n["holds"], lambda m, i: _placed(F.concat(n["path"], F.array(i)), m)))))


def nodes(pages: DataFrame, key: str = "page_id", html: str = "html", scratch: Scratch | None = None) -> DataFrame:
    """(key, block, path, node) of all nodes in the linked-data blocks of pages, as variants.

    Lists and `@graph`, nested however deep, are stepped into: STEPS levels in the row of their block, which needs no shuffle, and what
    still holds others then by a recursive query, a level of all pages at a time. Nodes are written once. `path` is a node's place. A
    block that isn't JSON, or has a key twice in an object, has no nodes.
    """
    blocks = pages.select(F.col(key).alias("key"), F.posexplode(ld_blocks(F.col(html))).alias("block", "text"))
    found = F.transform(F.array(F.try_parse_json(F.col("text"))), lambda n: _placed(F.array().cast("array<int>"), n))
    for _ in range(STEPS):
        found = _stepped(found)
    each = blocks.select("key", "block", F.explode(found).alias("n")).select("key", "block", "n.path", "n.node", F.col("n.holds").isNotNull().alias("open")).filter("node IS NOT NULL")
    each = (scratch or Scratch(pages.sparkSession, "nodes")).write(each.filter(F.col("open") | _shape(F.col("node")).startswith("OBJECT")), "nodes")
    flat, deep = each.filter("NOT open").drop("open"), each.filter("open").drop("open")
    if deep.isEmpty():
        return flat.withColumnRenamed("key", key)
    walked = pages.sparkSession.sql(
        """WITH RECURSIVE walk(key, block, path, node) MAX RECURSION LEVEL 1001 AS (
             SELECT key, block, path, node FROM {deep}
             UNION ALL
             SELECT key, block, concat(path, array(pos)), member FROM walk LATERAL VIEW posexplode(
               CASE WHEN schema_of_variant(node) LIKE 'ARRAY%' THEN try_variant_get(node, '$', 'array<variant>')
                    WHEN schema_of_variant(node) LIKE 'OBJECT%' AND NOT is_variant_null(try_variant_get(node, '$["@graph"]', 'variant')) THEN array(try_variant_get(node, '$["@graph"]', 'variant')) END) AS pos, member)
           SELECT key, block, path, node FROM walk
           WHERE schema_of_variant(node) LIKE 'OBJECT%' AND (try_variant_get(node, '$["@graph"]', 'variant') IS NULL OR is_variant_null(try_variant_get(node, '$["@graph"]', 'variant'))) LIMIT ALL""",
        deep=deep,
    )
    return flat.unionByName(walked).withColumnRenamed("key", key)


def _contributors(node: Column, page: Column, at: Column) -> Column:
    """People and organisations in the seven fields that name them, objects or plain names, with their links."""

    def of(said_in: Column) -> Column:
        v, field, shape = said_in["v"], said_in["field"], said_in["shape"]
        members = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.schema_of_variant(x).startswith("OBJECT"))
        named = F.try_parse_json(F.to_json(F.struct(F.try_variant_get(v, "$", "string").alias("name"))))
        actors = F.when(shape.startswith("OBJECT"), F.array(v)).when(shape.startswith("ARRAY"), members).when(shape == "STRING", F.array(named))

        def read(x: Column) -> Column:
            said = lambda k: F.nullif(_get(x, k, "string"), F.lit(""))
            return F.struct(x.alias("x"), said("name").alias("name"), said("@id").alias("id"), said("url").alias("url"), _shape(_get(x, "sameAs")).alias("same"))

        def one(found: Column, i: Column) -> Column:
            x, same = found["x"], found["same"]
            label = F.coalesce(found["name"], found["id"])
            address = F.coalesce(found["id"], found["url"])
            native = F.coalesce(address, F.concat(F.lit("label:"), label))
            receipt = F.concat(page, F.lit(" JSON-LD "), field, F.lit("["), i.cast("string"), F.lit("]"))
            site = F.array(identifier("official_website", native, "unknown", "unknown", "global", F.concat(receipt, F.lit(" @id|url")))).cast(IDENTIFIER)
            none = F.array().cast(IDENTIFIER)
            ids = F.when(same == "", none).when((same == "STRING") | same.startswith("ARRAY"), _links(x, receipt)).when(address.isNotNull(), site)
            kind = F.when(F.array_contains(_types(x), "Organization"), "organisation").otherwise("unknown")
            return F.when(label.isNotNull(), contribution(said_in["role"], agent(kind, native, label), at, i, receipt, ids))

        return F.array_compact(F.transform(F.transform(F.coalesce(actors, F.array().cast("array<variant>")), read), one))

    fields = F.filter(F.array(*[F.struct(_get(node, f).alias("v"), F.lit(f).alias("field"), F.lit(r).alias("role")) for f, r in ROLES.items()]), lambda s: s["v"].isNotNull())
    return F.flatten(F.transform(F.transform(fields, lambda s: F.struct(s["v"].alias("v"), s["field"].alias("field"), s["role"].alias("role"), _shape(s["v"]).alias("shape"))), of))


def page_observations(pages: DataFrame, source: dict[str, str], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Envelopes of the nodes of pages whose type is known (KINDS): an address of the node or its page and its `sameAs` links as
    identifiers, contributors by role, some fields as attributes. A snapshot is known by the digest of its page; the page itself isn't
    copied. A node without an identity of its own gets one by its place among those of its page (key, url and html) that are kept."""
    of = F.struct(F.col(key), F.coalesce(F.col(url), F.lit("")).alias("url"), F.sha2(F.coalesce(html, F.lit("")), 256).alias("digest"))
    rows = nodes(pages.select(of.alias("_page"), html), "_page", html).withColumn("_types", _types(F.col("node")))
    known = rows.withColumn("_type", F.try_element_at(F.filter("_types", lambda t: t.isin(*KINDS)), F.lit(1))).filter(F.col("_type").isNotNull())
    placed = known.withColumn("_at", F.row_number().over(Window.partitionBy("_page").orderBy("block", "path")) - 1)
    node, page, digest = F.col("node"), F.col("_page.url"), F.col("_page.digest")
    own = F.coalesce(*[F.nullif(F.trim(_text(node, k)), F.lit("")) for k in IDENTITY], F.concat(page, F.lit("#jsonld-node-"), F.col("_at").cast("string")))
    named = placed.withColumn("_native", own).withColumn("_label", F.coalesce(*[_text(node, k) for k in LABEL], F.col("_native")))
    kinds = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[0])])
    works = F.create_map(*[F.lit(x) for k, v in KINDS.items() if v[1] for x in (k, v[1])])
    attributes = F.struct(*[_get(node, k).alias(k) for k in KEPT], F.col("_types").alias("schema_types"), F.try_element_at(works, F.col("_type")).alias("work_type"))
    address = identifier("page_url", F.when(F.col("_native").startswith("http"), F.col("_native")).otherwise(page), "unknown", "unknown", "source", F.concat(page, F.lit(" JSON-LD node identity")))
    ids = F.concat(F.array(address).cast(IDENTIFIER), _links(node, F.concat(page, F.lit(" JSON-LD"))))
    return envelope(named, source, F.col("_native"), F.try_element_at(kinds, F.col("_type")), F.col("_native"), F.col("_label"), attributes, ids, _contributors(node, page, F.lit(source["observed_at"])), pointer=F.concat(F.lit("sha256:"), digest), payload=digest)


def all_identifiers(envelopes: DataFrame) -> DataFrame:
    """All identifiers anywhere in envelopes, those of a record's subject and of its contributors' agents."""
    nested = F.flatten(F.transform("contributions", lambda c: c["agent"]["identifiers"]))
    return envelopes.select(F.col("source.source_id").alias("source_id"), F.col("subject.source_native_id").alias("subject"), F.explode(F.concat("identifiers", nested)).alias("i")).select("source_id", "subject", "i.*")
