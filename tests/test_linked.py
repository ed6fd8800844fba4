"""Linked data of pages, keys of JSON at any depth, and that neither needs Python."""

import json

import pytest
from pyspark.sql import functions as F

from evgraph.functions.jsonx import keys_at_any_depth
from evgraph.plans.scratch import Scratch
from evgraph.sources import linked

SOURCE = {"source_id": "src", "snapshot_id": "s1", "observed_at": "2024-01-01T00:00:00Z", "retrieved_at": "2024-02-01T00:00:00Z", "terms_revision": "t1", "rights_state": "open_data"}


def page(*blocks):
    return "<p>x</p>" + "".join(f'<script type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>' for b in blocks)


def observed(spark, *pages):
    rows = spark.createDataFrame([(i, f"http://p{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return linked.page_observations(rows, SOURCE)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_keys(spark):
    texts = {
        '{"a":1,"a":2}': ["a"], '[1,{"B ":{"c":"x\\":y"}}]': ["b", "c"], "nope": [], '"\\"a\\":"': [], "{}": [], "[]": [], "": [], "null": [], '{"a":': [],
        '{"a\\\\":1, "q\\"" : {"\u00e9\\u0041":[{"":2}]}, "s":"\\\\", "t":"\\"k\\":"}': ["", "a\\", 'q"', "s", "t", "\u00e9a"],
        '{"top":' + "[" * 400 + '{"deep":1}' + "]" * 400 + "}": ["deep", "top"], '{"k":"' + '\\\\\\"' * 50000 + '"}': ["k"], '{"x, y":{"[":[{"Z":null}]}}': ["[", "x, y", "z"],
    }
    for text, keys in texts.items():  # what a plain walk finds
        try:
            stack, seen = [json.loads(text)], set()
        except ValueError:
            stack, seen = [], set()
        while stack:
            x = stack.pop()
            if isinstance(x, dict):
                seen |= {k.strip().lower() for k in x}
                stack += x.values()
            elif isinstance(x, list):
                stack += x
        assert sorted(seen) == keys
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", keys_at_any_depth(F.col("t")).alias("k"))
    assert {r["t"]: r["k"] for r in rows.collect()} == texts | {None: []}
    assert "Python" not in plan(rows)


def test_nodes_at_any_depth(spark):
    deep = {"@type": "Person", "@id": "deep"}
    for _ in range(50):
        deep = {"@graph": [deep]}
    got = observed(
        spark, page(deep), page([[{"@type": "Thing"}], {"@graph": {"@type": "http://schema.org/Book", "headline": "H"}}], {"@type": ["X", "Event"], "url": " http://e ", "@graph": None}), page("{not json", '{"@type":"Person","a":1,"a":2}', "7", " "), None, "",
    )
    assert "Python" not in plan(got)
    assert sorted((r["subject"]["source_native_id"], r["subject"]["kind"], r["subject"]["label"], json.loads(r["subject"]["attributes"])) for r in got.collect()) == [
        ("deep", "person", "deep", {"schema_types": ["Person"]}), ("http://e", "event", "http://e", {"schema_types": ["X", "Event"], "work_type": "event"}), ("http://p1#jsonld-node-0", "work", "H", {"schema_types": ["Book"], "work_type": "book"}),
    ]


@pytest.mark.parametrize("limit", ["1", "1000000"])
def test_no_row_limit(spark, limit):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    try:
        assert observed(spark, *[page({"@graph": [{"@type": "Person", "@id": f"{i}-{j}"} for j in range(20)]}) for i in range(20)]).count() == 400
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


def test_contributors(spark):
    node = {
        "@type": "Book", "@id": "b", "name": "B", "sameAs": ["http://x", " ", 3, "http://y "], "datePublished": "2020", "isPartOf": {"name": "S"},
        "author": ["skipped", {"name": "A", "sameAs": "http://a"}, {"@id": "p1"}, {"url": "http://nameless"}], "creator": {"name": "C", "@id": "c", "sameAs": {}}, "editor": "Ed", "performer": [], "actor": {"name": 7}, "contributor": {"name": "", "@id": "z"},
        "organizer": {"@type": "http://schema.org/Organization", "name": "O", "url": "http://o", "sameAs": None},
    }
    e = observed(spark, page(node)).first()
    assert [(c["role"], c["order"], c["agent"]["kind"], c["agent"]["source_native_id"], c["agent"]["label"], [(i["scheme"], i["value"]) for i in c["agent"]["identifiers"]]) for c in e["contributions"]] == [
        ("author", 0, "unknown", "label:A", "A", [("same_as_url", "http://a")]), ("author", 1, "unknown", "p1", "p1", []), ("creator", 0, "unknown", "c", "C", [("official_website", "c")]), ("editor", 0, "unknown", "label:Ed", "Ed", []),
        ("speaker", 0, "unknown", "label:7", "7", []), ("contributor", 0, "unknown", "z", "z", []), ("organizer", 0, "organisation", "http://o", "O", [("official_website", "http://o")]),
    ]
    assert [(i["scheme"], i["value"], i["evidence"]) for i in e["identifiers"]] == [("page_url", "http://p0", "http://p0 JSON-LD node identity"), ("same_as_url", "http://x", "http://p0 JSON-LD sameAs[0]"), ("same_as_url", "http://y", "http://p0 JSON-LD sameAs[3]")]
    assert json.loads(e["subject"]["attributes"]) == {"datePublished": "2020", "isPartOf": {"name": "S"}, "schema_types": ["Book"], "work_type": "book"}
    assert e["raw_pointer"] == e["source"]["snapshot_id"] == "sha256:" + e["source"]["payload_sha256"]
    assert sorted(r["value"] for r in linked.all_identifiers(observed(spark, page(node))).collect()) == ["c", "http://a", "http://o", "http://p0", "http://x", "http://y"]


def test_shallow_nodes_are_written_once_and_deep_ones_walked(spark):
    """Whatever the depth, nodes and their places are the same; shallow ones come without a recursive query."""
    texts = ["[" * d + '{"@type":"Person","@id":"x"}, 7' + "]" * d for d in range(1, 9)] + ['{"@graph": [{"@id": "a"}, [{"@graph": {"@id": "b"}}], null]}']
    pages = spark.createDataFrame([(i, f'<script type="application/ld+json">{t}</script>') for i, t in enumerate(texts)], "page_id int, html string")
    want = sorted([(d - 1, [0] * d) for d in range(1, 9)] + [(8, [0, 0]), (8, [0, 1, 0, 0])])
    scratch = Scratch(spark, "ld")
    assert sorted((r["page_id"], r["path"]) for r in linked.nodes(pages, scratch=scratch).select("page_id", "path").collect()) == want
    assert spark.read.parquet(f"{scratch.root}/nodes").filter("open").count() == 4
    flat = linked.nodes(pages.filter("page_id < 4"))
    assert "UnionLoop" not in flat._jdf.queryExecution().toString() and flat.count() == 4
