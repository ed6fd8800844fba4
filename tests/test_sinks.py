"""Writers that publish all or nothing: database files by key, and canonical NDJSON."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evgraph.plans.versions import Conflict, Versions
from evgraph.sources import sinks

COLUMNS = "k long, part string, v string, n double, yes boolean, raw binary, at int"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def frame(spark, values):
    return spark.createDataFrame([(k, p, v, at / 2, at % 2 == 0, None if at % 3 else bytes([at % 200]), at) for k, p, v, at in values], COLUMNS)


def staged(root):
    return sorted(p.name for p in (root / "data").glob("*"))


@pytest.mark.parametrize("conflict", ["ignore", "replace"])
def test_batches_equal_a_plain_table(spark, tmp_path, conflict):
    rng, want = random.Random(5), {}
    for _ in range(3):
        # a third of all rows has one key
        batch = [(0 if rng.random() < 0.34 else rng.randrange(60), rng.choice("ab"), f"v{rng.random()}", rng.randrange(1000)) for _ in range(300)]
        version = sinks.upsert_files(frame(spark, batch).repartition(7), str(tmp_path), "t", ["k", "part"], ["at"], conflict, shards=5)
        for r in sorted(map(tuple, frame(spark, batch).collect()), key=lambda r: (r[6], r[1], r[2])):
            if conflict == "replace":
                want[r[:2]] = r
            else:
                want.setdefault(r[:2], r)
    assert version == 3
    got = sinks.read_files(spark, str(tmp_path), "t")
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "string", "string", "double", "boolean", "binary", "bigint"]
    assert rows(got) == sorted(want.values(), key=repr) and got.rdd.getNumPartitions() == 5
    assert sinks.read_files(spark, str(tmp_path), "t", 1).count() < got.count()


def test_a_failed_task_leaves_the_version(spark, tmp_path):
    good = [(i, "a", "x", i) for i in range(50)]
    assert sinks.upsert_files(frame(spark, good), str(tmp_path), "t", ["k"], ["at"], shards=4) == 1
    before, files = rows(sinks.read_files(spark, str(tmp_path), "t")), staged(tmp_path)
    with pytest.raises(Exception, match="null"):
        sinks.upsert_files(frame(spark, [*((i, "b", "y", i) for i in range(100, 150)), (None, "b", "y", 1)]), str(tmp_path), "t", ["k"], ["at"], "replace")

    def dies(parts):
        for p in parts:
            if (p["k"] == 149).any():
                raise RuntimeError("lost")
            yield p

    # one shard's task fails after the others may have written theirs
    broken = frame(spark, [(i, "b", "y", i) for i in range(100, 150)])
    with pytest.raises(Exception, match="lost"):
        sinks.upsert_files(broken.mapInPandas(dies, broken.schema), str(tmp_path), "t", ["k"], ["at"], "replace")
    assert rows(sinks.read_files(spark, str(tmp_path), "t")) == before
    assert Versions(spark, f"file://{tmp_path}").numbers() == [1] and staged(tmp_path) == files


def test_one_of_two_writers_wins(spark, tmp_path):
    import sqlite3

    a = frame(spark, [(1, "a", "x", 1)])
    sinks.upsert_files(a, str(tmp_path), "t", ["k"], ["at"], shards=2)
    schema = a.withColumn("_shard", F.lit(0)).schema
    options = {"path": str(tmp_path), "table": "t", "keys": '["k"]', "conflict": "ignore", "base": "1", "shards": "2"}
    one, two = sinks._Shards(schema, options), sinks._Shards(schema, options)
    done = [w.write(iter([(2, "a", "x", 0.5, True, None, 1, 0)])) for w in (one, two)]
    one.commit([done[0], None])
    with pytest.raises(Conflict):
        two.commit([done[1]])
    two.abort([done[1]])
    assert done[1].files[0] not in {f"data/{n}" for n in staged(tmp_path)}
    assert rows(sinks.read_files(spark, str(tmp_path), "t").select("k")) == [(1,), (2,)]
    with pytest.raises(RuntimeError, match="two tasks"):
        one.commit([sinks._Written({0: "x"}), sinks._Written({0: "y"})])
    # what a plain client sees of one file
    name = sinks._manifest(tmp_path, 2)["tables"]["t"]["files"]["0"]
    assert (2, "x") in sqlite3.connect(tmp_path / name).execute("SELECT k, v FROM t").fetchall()


def test_batches_count_once_and_tables_are_apart(spark, tmp_path):
    a = frame(spark, [(1, "a", "x", 1)])
    first = sinks.upsert_files(a, str(tmp_path), "t", ["k"], ["at"], batch="7")
    assert sinks.upsert_files(frame(spark, [(2, "a", "x", 1)]), str(tmp_path), "t", ["k"], ["at"], batch="7") == first
    assert sinks.upsert_files(frame(spark, [(2, "a", "x", 1)]), str(tmp_path), "u", ["k"], ["at"], batch="7") == first + 1
    assert rows(sinks.read_files(spark, str(tmp_path), "t").select("k")) == [(1,)] and rows(sinks.read_files(spark, str(tmp_path), "u").select("k")) == [(2,)]
    with pytest.raises(ValueError, match="other columns"):
        sinks.upsert_files(a.drop("n"), str(tmp_path), "t", ["k"], ["at"])
    with pytest.raises(ValueError, match="mounted"):
        sinks.upsert_files(a, "s3://x/y", "t", ["k"], ["at"])
    with pytest.raises(ValueError, match="no columns of"):
        sinks.upsert_files(a.withColumn("l", F.array("k")), str(tmp_path), "w", ["k"], ["at"])
    assert sinks.upsert_files(a.limit(0), str(tmp_path), "e", ["k"], ["at"]) == first + 2
    assert sinks.read_files(spark, str(tmp_path), "e").count() == 0


def test_odd_names_and_keys_alone(spark, tmp_path):
    odd = spark.createDataFrame([(1, "é", 2), (1, "é", 2), (1, "", 3)], ["k", 'a"b `c', "x y"]).drop("x y")
    sinks.upsert_files(odd, str(tmp_path), 't"q', ["k", 'a"b `c'], ["k"])
    got = sinks.read_files(spark, str(tmp_path), 't"q')
    assert got.columns == odd.columns and rows(got) == [(1, ""), (1, "é")]


def test_ndjson_is_published_in_order(spark, tmp_path):
    path = f"file://{tmp_path}/lines"
    data = spark.createDataFrame([(i, f"s{i % 7}", None if i % 5 else "é\"x") for i in range(200)], "z long, source string, note string").repartition(9)
    assert sinks.publish_ndjson(data, path, ["source", "z"]) == 1
    files = sorted((tmp_path / "lines" / Versions(spark, path).manifest()["lines"]).glob("part-*"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    want = sorted(({"z": i, "source": f"s{i % 7}", "note": None if i % 5 else "é\"x"} for i in range(200)), key=lambda r: (r["source"], r["z"]))
    assert lines == [json.dumps(r, ensure_ascii=False, sort_keys=True, separators=(",", ":")) for r in want]

    @F.pandas_udf("long")
    def dies(s: pd.Series) -> pd.Series:
        if (s == 3).any():
            raise RuntimeError("lost")
        return s

    with pytest.raises(Exception, match="lost"):
        sinks.publish_ndjson(data.withColumn("z", dies("z")), path, ["source", "z"])
    assert Versions(spark, path).numbers() == [1] and sinks.published_ndjson(spark, path).count() == 200
    assert sinks.publish_ndjson(data.limit(3), path, ["z"]) == 2 and sinks.published_ndjson(spark, path, 1).count() == 200
