"""Column functions against values worked out by hand, traps among them."""

import pytest
from pyspark.sql import functions as F

from evgraph.functions import authors, dates, ids, jsonx, text, urls


def one(spark, column, **values):
    """The column's value on one row of text values."""
    cols = [(F.lit(v) if v is not None else F.lit(None).cast("string")).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*cols).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("name", "key"),
    [("Dr. José  García-López (poet)", "josé garcía lópez"), ("李, 白", "李 白"), ("ＦＵＬＬ width", "full width"), ("Straße", "strasse"), ("St. John, Sir", "john"), (None, ""), ("...", ""), ("İstanbul", "i̇stanbul")],
)
def test_name_key(spark, name, key):
    assert one(spark, text.name_key(F.col("n")), n=name) == key


@pytest.mark.parametrize(("name", "parts"), [("Kant, Immanuel", ("kant", "immanuel")), ("Immanuel von Kant", ("kant", "immanuel von")), ("Plato", ("plato", "")), ("Doe, Jane, Jr.", ("doe", "jane"))])
def test_name_parts(spark, name, parts):
    a, b = text.parts_of(F.col("n"))
    assert (one(spark, a, n=name), one(spark, b, n=name)) == parts


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Kennedy, John F. (John Fitzgerald), 1917-1963", ("Kennedy, John F. (John Fitzgerald)", 1917, 1963, "author", False)), ("Doe, Jane, 1917-", ("Doe, Jane", 1917, None, "author", False)), ("Roe, R., 1743?-1826", ("Roe, R.", 1743, 1826, "author", False)),
        ("Poe, P., b. 1900", ("Poe, P.", 1900, None, "author", False)), ("Poe, P., d. 1950", ("Poe, P.", None, 1950, "author", False)), ("Plato, 428? BCE-348? BCE", ("Plato", -428, -348, "author", False)), ("X, Y [Translator]", ("X, Y", None, None, "translator", False)),
        ("United States", ("United States", None, None, "author", True)), ("Various", ("Various", None, None, "author", True)), ("Livy, 63 BCE-14", ("Livy", -63, -14, "author", False)), ("  ", None), (None, None), ("Roe, -1826", ("Roe, -1826", None, None, "author", False)),
        ("Ion, ca. 490 B.C.-ca 1", ("Ion, ca. 490 B.C.-ca 1", None, None, "author", False)), ("Ion, ca. 490 B.C.E.-", ("Ion", -490, None, "author", False)), ("Roe, R., ca. 1743-?", ("Roe, R.", 1743, None, "author", False)),
        ("Roe, 17-1826", ("Roe, 17-1826", None, None, "author", False)), ("Roe, 1743-1826x [Ed.] ", ("Roe, 1743-1826x", None, None, "ed.", False)), ("Roe, 1743 - 1826 [Ed.]", ("Roe", 1743, 1826, "ed.", False)), ("[Editor]", None), ("Roe []", ("Roe []", None, None, "author", True)),
    ],
)
def test_parsed_authors(spark, raw, want):
    got = one(spark, authors.parsed(F.col("r")), r=raw)
    assert (tuple(got) if got else None) == want


def test_person_keys(spark):
    key = lambda n, b, d: one(spark, authors.person_key(F.col("n"), F.col("b").cast("int"), F.col("d").cast("int")), n=n, b=b, d=d)
    assert key("Kennedy, John F. (John Fitzgerald)", "1917", "1963") == "kennedy, john f|1917-1963"
    assert key("李, 白", None, None) == key("王, 維", None, None) == ","
    assert key("A", "0", None) == "a" and key("A", "-5", None) == "a|-5-"
    assert one(spark, authors.unicode_person_key(F.lit("李, 白"), F.lit(0), F.lit(None).cast("int"))) == "李, 白|0-"


@pytest.mark.parametrize(
    ("scheme", "value", "want"),
    [
        ("github_id", " 0042 ", "42"), ("github_id", "-0", "0"), ("github_id", "+7", "7"), ("github_id", "x1", "x1"), ("github_node_id", "MDQ6VXNlcjE=", "MDQ6VXNlcjE="), ("github_login", "@@OctoCat", "octocat"), ("orcid", "https://orcid.org/0000-0002-1825-009x", "0000-0002-1825-009X"),
        ("orcid", "abc", "ABC"), ("wikidata", "http://www.wikidata.org/entity/q42", "Q42"), ("viaf", "ABC ", "abc"), ("website", "HTTPS://User@Example.com:8080/A/?q=1#x", "example.com/A"), ("website", "example.org", "example.org"), ("other", "ABC", "abc"), ("viaf", "", ""), (" ORCID ", "１", "1"),
    ],
)
def test_normalised_ids(spark, scheme, value, want):
    assert one(spark, ids.normalised(F.col("s"), F.col("v")), s=scheme, v=value) == want


def test_absent_values(spark):
    absent = lambda s, v: one(spark, ids.absent(F.col("s"), F.col("v")), s=s, v=v)
    assert all(absent(*x) for x in [("github_id", "0"), ("github_id", "-7"), ("github_node_id", "-99"), ("orcid", "0000-000X"), ("wikidata", "Q0"), ("viaf", " Ghost "), ("viaf", ""), ("viaf", None)])
    assert not any(absent(*x) for x in [("github_id", "12"), ("viaf", "0"), ("orcid", "0000-0001"), ("wikidata", "Q1")])


def test_registry(spark):
    rows = {r["scheme"]: r for r in ids.classified(spark.createDataFrame([("orcid",), (" GitHub_Login",), ("nope",), (None,)], "scheme string")).collect()}
    assert rows["orcid"]["auto_eligible"] and rows[" GitHub_Login"]["category"] == "alias" and rows["nope"]["category"] == "unknown" and not rows[None]["auto_eligible"]
    assert ids.registry(spark).count() == 26 and "orcid" in ids.ELIGIBLE and "software_heritage_origin" not in ids.ELIGIBLE


def test_stable_id_is_that_of_json_parts(spark):
    import hashlib
    import json

    want = "cand:" + hashlib.sha256("\x1f".join(json.dumps(p, ensure_ascii=False) for p in ('a"b', "é\n")).encode()).hexdigest()[:24]
    assert one(spark, ids.stable_id("cand", F.col("a"), F.col("b")), a='a"b', b="é\n") == want


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://Example.COM:443/a/b/?utm_source=x&b=2&a=1#top", "https://example.com/a/b?a=1&b=2"), ("http://x.org", "http://x.org/"), ("http://x.org:8080/", "http://x.org:8080/"), ("not a url", "not a url"), (" http://x.org/?UTM_a=1 ", "http://x.org/"), ("http://x.org/?a", "http://x.org/?a="),
    ],
)
def test_normalised_urls(spark, url, want):
    assert one(spark, urls.normalised_url(F.col("u")), u=url) == want


def test_dates(spark):
    span = lambda b, d: one(spark, dates.life_span(F.col("b").cast("int"), F.col("d").cast("int")), b=b, d=d)
    assert (span("-428", "-348"), span("1632", None), span(None, "5"), span(None, None)) == ("428 BCE-348 BCE", "1632-?", "?-5", None)
    problem = lambda v: one(spark, dates.iso_problem(F.col("v")), v=v)
    assert (problem("2024-01-01T00:00:00Z"), problem("2024-01-01T00:00:00"), problem("soon"), problem(None)) == (None, "format.timezone", "format.iso8601", None)
    assert one(spark, dates.full_time(F.col("v")), v="2024-01-02") == "2024-01-02T00:00:00Z" and one(spark, dates.full_time(F.col("v")), v=None) == "1970-01-01T00:00:00Z"


def test_json(spark):
    assert one(spark, jsonx.canonical(F.col("j")), j='{"b": 1, "a": [1, {"d": "é", "c": null}]}') == '{"a":[1,{"c":null,"d":"é"}],"b":1}'
    assert one(spark, jsonx.canonical(F.col("j")), j="{") is None
    assert one(spark, jsonx.keys_at_any_depth(F.col("j")), j='{"A": [{"merged_into": 1}]}') == ["a", "merged_into"]
    assert one(spark, jsonx.string_list(F.col("j")), j='["x", "y"]') == ["x", "y"] and one(spark, jsonx.string_list(F.col("j")), j="oops") == []
    assert one(spark, jsonx.unwrapped(F.col("j"), "t"), j='{"t": {"value": "x"}}') == one(spark, jsonx.unwrapped(F.col("j"), "t"), j='{"t": "x"}') == "x"
    html = '<script type="application/ld+json">{"@graph": [{"@type": "Person", "name": "A", "sameAs": "http://a"}, {"@type": ["x/Event"], "@id": "e"}]}</script><script>1</script>'
    nodes = spark.range(1).select(F.explode(jsonx.ld_blocks(F.lit(html))).alias("b")).select(F.explode(jsonx.ld_nodes("b")).alias("n")).select("n.*").collect()
    assert [(n["types"], n["name"], n["same_as"]) for n in nodes] == [(["Person"], "A", ["http://a"]), (["Event"], None, [])]


def test_small_text(spark):
    assert one(spark, text.first_text(F.lit(" "), F.lit("x"))) == "x" and one(spark, text.first_text(F.lit(None).cast("string"), default="d")) == "d"
    assert one(spark, text.shortened(F.col("t"), 3), t="abcdef") == "abc" and one(spark, text.shortened(F.col("t")), t="") is None
    assert (one(spark, text.before_slash(F.col("t")), t="a/b/c"), one(spark, text.after_slash(F.col("t")), t="a/b/c"), one(spark, text.after_slash(F.col("t")), t="a")) == ("a", "b/c", "")
    assert one(spark, ids.percent_encoded(F.col("t")), t="a b/ü") == "a%20b%2F%C3%BC"


def test_canonical_text_of_typed_columns(spark):
    import json

    from evgraph.functions import jsonx

    kind = "b struct<z:int,a:array<struct<y:string,x:double>>>, a map<string,struct<d:int,c:string>>, n string, `é` string"
    rows = [((1, [("q", 0.5), (None, None), None]), {"k2": (1, None), "k1": None}, None, 'x "y" ü'), (None, None, "", None)]
    frame = spark.createDataFrame(rows, kind)
    got = [r["t"] for r in frame.select(jsonx.canonical_of(frame, F.struct(*frame.columns)).alias("t")).collect()]
    for (b, a, n, e), text in zip(rows, got, strict=True):
        plain = {"b": None if b is None else {"z": b[0], "a": [None if x is None else {"y": x[0], "x": x[1]} for x in b[1]]}, "a": None if a is None else {k: None if v is None else {"d": v[0], "c": v[1]} for k, v in a.items()}, "n": n, "é": e}
        assert text == json.dumps(plain, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    plan = frame.select(jsonx.canonical_of(frame, F.struct(*frame.columns)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_nodes_of_odd_linked_data(spark):
    deep = '{"@graph": ' * 3 + '[[{"@id": "a", "name": 5, "url": ["u"]}], 1, null, {"headline": "H", "url": "h", "@type": "http://s#T", "@graph": {"@id": "b"}}]' + "}" * 3
    found = [one(spark, jsonx.ld_nodes(F.col("b")), b=b) for b in (deep, "[" * 5000 + "]" * 5000, "{", "", None, "7", '{"@context": "c"}')]
    assert [(n["id"], n["types"], n["name"], n["url"]) for n in found[0]] == [("a", [], None, None), ("h", ["T"], "H", "h"), ("b", [], None, None)]
    assert found[1:] == [[]] * 6
