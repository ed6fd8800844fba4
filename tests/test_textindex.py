"""The written index against plain scans and against rebuilds, and versions against failed and competing writers."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evgraph.catalog import Catalog, Config
from evgraph.engine import Engine
from evgraph.operators import search, textindex
from evgraph.operators.textindex import TextIndex
from evgraph.plans.versions import Conflict, Versions

SCHEMA = "id long, text string, size string"


def texts(seed, n):
    dice = random.Random(seed)
    words = "the of The ölen Ada Lovelace ada-lovelace x1 日本 a".split()
    return [(i, dice.choice([None, "", *[" ".join(dice.choices(words, k=dice.randrange(1, 12))) for _ in range(12)]]), "clash") for i in range(n)]


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def content(index):
    return rows(index.postings().select("token", "key", "positions", "size")), rows(index.documents().select("key", "size")), index.manifest["documents"], index.manifest["tokens"]


@pytest.mark.parametrize("phrase", ["the", "of the", "ada lovelace", "the the", "Ölen", "nowhere at all", "--", "a of"])
def test_phrases_equal_a_scan(spark, tmp_path_factory, phrase):
    frame = spark.createDataFrame([*texts(1, 120), (None, "the", "x")], SCHEMA)
    index = TextIndex.build(spark, str(tmp_path_factory.mktemp("index")), frame, "id", F.col("text"))
    want = search.phrase(frame.filter("id IS NOT NULL"), F.col("text"), phrase)
    assert rows(index.phrase(phrase).select("key")) == rows(want.select("id"))


def test_relevance_equals_the_scan(spark, tmp_path):
    frame = spark.createDataFrame(texts(2, 80), SCHEMA)
    index = TextIndex.build(spark, str(tmp_path), frame, "id", F.col("text"))
    want = search.relevance(search.postings(frame, "id", F.col("text")), "id", "the ada", 80, index.manifest["tokens"] / 80)
    assert [(k, round(s, 9)) for k, s in rows(index.relevance("the ada"))] == [(k, round(s, 9)) for k, s in rows(want)]
    best = index.ranked_phrase("ada lovelace").orderBy(F.desc("score"), "key").collect()
    assert len(best) == index.phrase("ada lovelace").count() and all(r["score"] > 0 for r in best)


def test_batches_equal_a_rebuild(spark, tmp_path):
    dice, now = random.Random(3), {i: t for i, t, _ in texts(3, 60)}
    index = TextIndex.build(spark, f"{tmp_path}/a", spark.createDataFrame([(i, t, "") for i, t in now.items()], SCHEMA), "id", F.col("text"), buckets=4)
    for n in range(5):
        batch = [(dice.randrange(90), text, dice.random() < 0.3) for _, text, _ in texts(10 + n, 25)]
        batch += [(3, "of the the", False), (3, None, True), (4, None, True), (None, "the", False)]
        index = index.apply(spark.createDataFrame(batch, "key long, text string, gone boolean"), most=3)
        for key in {b[0] for b in batch} - {None}:
            kept = [t or "" for k, t, gone in batch if k == key and not gone]
            now.pop(key, None)
            if kept:
                now[key] = max(kept)
        again = TextIndex.build(spark, f"{tmp_path}/b{n}", spark.createDataFrame([(i, t, "") for i, t in now.items()], SCHEMA), "id", F.col("text"))
        assert content(index) == content(again)
    assert len(index.manifest["segments"]) <= 3 and content(index.compact()) == content(again)
    first = TextIndex(spark, f"{tmp_path}/a", 1)
    assert first.manifest["documents"] == 60 and first.documents().count() == 60


def test_postings_are_written_by_runs_of_texts(spark, tmp_path, monkeypatch):
    """A token of many texts is a few rows, and no text is shuffled: what is written and dealt doesn't grow with a row for each posting."""
    frame = spark.range(400).select("id", F.concat(F.lit("the end of the "), F.col("id").cast("string")).alias("text")).coalesce(2)
    index = TextIndex.build(spark, str(tmp_path), frame, "id", F.col("text"))
    stored = spark.read.parquet(f"{tmp_path}/{index.manifest['segments'][0]['name']}/postings")
    assert stored.filter("token = 'the'").count() <= 2 and index.counts(["the"]).count() == 400
    assert rows(index.counts().select("token", "key", "n", "size")) == rows(index.postings().select("token", "key", F.size("positions").alias("n"), "size"))
    assert rows(index.postings(["the"]).filter("key = 7").select("positions", "size")) == [([0, 3], 5)]
    changes = frame.select(F.col("id").alias("key"), F.lit("no more").alias("text"), (F.col("id") % 2 == 0).alias("gone")).filter("key < 300")
    monkeypatch.setattr(textindex, "BROADCAST", 0)  # keys taken away are hashed
    after = index.apply(changes)
    assert after.counts(["the"]).count() == 100 and after.counts(["more"]).count() == 150 and after.documents().count() == 250
    assert content(after.compact()) == content(after)


def test_runs_are_bounded(monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 10)
    batch = lambda texts: pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["key", "words"])
    runs = [r["words"].to_pylist() for r in textindex._runs(iter([batch(["a" * 4, "b" * 4, "c" * 4]), batch(["d" * 30, "e"]), batch([]), batch(["f"])]))]
    assert [w for r in runs for w in r] == ["aaaa", "bbbb", "cccc", "d" * 30, "e", "f"] and all(sum(map(len, r)) <= 10 or len(r) == 1 for r in runs)


def test_runs_have_a_bounded_number_of_texts(monkeypatch):
    """Short texts, such as names, would be a run of a million else, and their common word one row of as many keys."""
    monkeypatch.setattr(textindex, "BLOCK", textindex.TEXT * 4)
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(["a"] * 10)], ["key", "words"])
    assert [len(r) for r in textindex._runs(iter([batch]))] == [3, 3, 3, 1]


def test_rows_of_keys_do_not_bear_the_lists_of_their_token(spark, tmp_path):
    """A row for each key of a run waits in memory, so the lists of all keys beside each of them were as many times as many bytes."""
    frame = spark.range(40).select("id", F.lit("of the end of the").alias("text")).coalesce(1)
    index = TextIndex.build(spark, str(tmp_path), frame, "id", F.col("text"))
    for found in (index.postings(), index.postings(["the"]), index.counts(), index.phrase("of the"), index.ranked_phrase("of the"), index.relevance("of the")):
        todo, seen = [found._jdf.queryExecution().optimizedPlan()], 0
        while todo:
            node = todo.pop()
            if node.nodeName() == "Generate":
                seen += 1
                borne = node.requiredChildOutput()
                assert {borne.apply(i).name() for i in range(borne.size())} <= {"token"}
            todo += [node.children().apply(i) for i in range(node.children().size())]
        assert seen
    assert sorted(map(tuple, index.phrase("of the").collect())) == [(i, 2, 5) for i in range(40)]


def test_empty(spark, tmp_path):
    index = TextIndex.build(spark, f"{tmp_path}/a", spark.createDataFrame([], SCHEMA), "id", F.col("text"))
    assert index.phrase("the").count() == 0 and index.relevance("the").count() == 0
    after = index.apply(spark.createDataFrame([(1, "the end", False)], "key long, text string, gone boolean"))
    assert rows(after.phrase("the end")) == [(1, 1, 2)] and not TextIndex(spark, f"{tmp_path}/none").exists


def test_versions_publish_once(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    assert store.latest() == 0 and store.manifest() == {}
    assert store.publish({"a": 1}, 0) == 1 and store.publish({"a": 2}, 1) == 2
    with pytest.raises(Conflict):
        Versions(spark, str(tmp_path)).publish({"a": 3}, 1)
    assert store.manifest() == {"a": 2} and store.manifest(1) == {"a": 1} and store.numbers() == [1, 2]
    name = store.stage()
    store.write(spark.range(3).toDF("id"), name)
    store.publish({"data": name}, 2)
    lost = store.stage()
    store.write(spark.range(9).toDF("id"), lost)
    store.drop_before(3)
    assert store.numbers() == [3] and store.read(store.manifest()["data"]).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read(lost)


def test_who_reads_the_index(spark, tmp_path):
    people = [("p1", "Ada Lovelace", "linked", None), ("p2", "Ada Lovelace", "merged", "p1"), ("p3", "Ada King Lovelace", "linked", None), ("p4", "Adam Smith", "linked", None), ("p5", "Countess Ada Lovelace of somewhere", "linked", None)]
    person = spark.createDataFrame(people, "person_id string, name string, state string, merged_into string").withColumns({"kind": F.lit("human"), "origin": F.lit("book"), "birth_year": F.lit(1815), "death_year": F.lit(None).cast("int")})
    person.write.parquet(f"{tmp_path}/people/person.parquet")
    spark.createDataFrame([], "person_a string, person_b string, status string, method string").write.parquet(f"{tmp_path}/people/identity_claim.parquet")
    scan = Engine(Catalog.open(spark, Config.load({"people": f"{tmp_path}/people"}, env={}))).who("ada lovelace").as_dict()
    assert scan["execution"] == {"search_path": "phrase", "search_path_is_indexed": False}
    TextIndex.build(spark, f"{tmp_path}/people/person_search", person, "person_id", F.col("name"))
    engine = Engine(Catalog.open(spark, Config.load({"people": f"{tmp_path}/people"}, env={})))
    got = engine.who("ada lovelace").as_dict()
    assert got["execution"] == {"search_path": "index", "search_path_is_indexed": True} and got["page"]["total_matched"] == 3
    assert [r["representative"] for r in got["result"]] == ["p1", "p5"] and any("3 person rows are 2 people" in g for g in got["coverage_gaps"])
    one = engine.who("ada lovelace", limit=1).as_dict()
    assert one["page"]["truncated"] and [r["representative"] for r in one["result"]] == ["p1"]
    assert "people.person_search" not in engine.catalog.missing()
    import shutil

    shutil.rmtree(f"{tmp_path}/people/person_search/data")
    broken = engine.who("ada lovelace").as_dict()
    assert broken["execution"]["search_path"] == "phrase" and any("person_search" in w for w in broken["warnings"])
