"""Published tables: rules, versions, retried batches and killed streams."""

import json

import pytest
from pyspark.sql import functions as F

from evgraph.operators import contracts
from evgraph.operators.published import Change, Published, Rejected, append_only, check, reference, unique
from evgraph.plans.versions import Conflict
from evgraph.sources.imports import import_envelopes
from evgraph.streaming.imports import envelope_batch, import_stream

PERSON, CLAIM = "id string, name string", "a string, b string, status string, confidence double"


def envelope(i):
    day = f"2024-01-{i + 1:02d}T00:00:00Z"
    source = {"source_id": "s", "snapshot_id": "p", "record_native_id": f"r{i}", "observed_at": day, "retrieved_at": day, "terms_revision": "t", "rights_state": "open_data", "payload_sha256": f"{i:064x}"}
    subject = {"kind": "person", "source_native_id": f"n{i % 5}", "label": f"Name {i}", "attributes": {"bio": "x"}}
    return json.dumps({"envelope_version": contracts.VERSION, "source": source, "subject": subject, "identifiers": [{"scheme": "orcid", "value": f"0000-000{i % 5}", "scope": "global", "stability": "stable", "uniqueness": "unique", "evidence": "field"}], "contributions": [], "relationships": [], "evidence": [{"kind": "k", "locator": "l", "observed_at": day}], "raw_pointer": f"s/r{i}"})


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    rules = [unique("person", "id"), reference("claim", "a", "person", "id"), reference("claim", "b", "person", "id"), unique("claim", "a", "b", where=F.col("status") == "accepted"), append_only("claim", "a")]
    rules.append(check("claim", share=F.col("confidence").between(0, 1), order=F.col("a") < F.col("b")))
    return Published(spark, str(tmp_path), rules)


def test_changes_that_break_a_rule_leave_no_trace(spark, store):
    person = lambda *r: spark.createDataFrame(r, PERSON)
    claim = lambda *r: spark.createDataFrame(r, CLAIM)
    assert store.commit({"person": Change(person(("p1", "x"), ("p2", "y"), ("p3", None)))}) == 1
    assert store.commit({"claim": Change(claim(("p1", "p2", "accepted", 0.5), ("p1", "p3", "open", None)))}) == 2
    for change, rule, n in (
        ({"person": Change(person(("p2", "again"), ("p4", "")))}, "person.unique(id)", 1), ({"claim": Change(claim(("p1", "p9", "open", 1.0)))}, "claim.b of person", 1), ({"claim": Change(claim(("p1", "p2", "accepted", 1.0)))}, "claim.unique(a, b)", 1),
        ({"claim": Change(claim(("p1", "p2", "open", 1.5), ("p1", "p2", "open", -1.0)))}, "claim.check share", 2), ({"claim": Change(claim(("p3", "p2", "open", None)))}, "claim.check order", 1), ({"claim": Change(claim(("p1", "p2", "accepted", 0.5)), "replace")}, "claim.append_only", 1),
        ({"person": Change(person(("p1", "x"), ("p3", "y")), "replace")}, "claim.b of person", 1),
    ):
        with pytest.raises(Rejected) as e:
            store.commit(change)
        assert (rule, n) in [f[:2] for f in e.value.findings] and store.version() == 2
    assert len(rows(store.table("person"))) == 3 and len(rows(store.table("claim"))) == 2
    both = {"person": Change(person(("p1", "new name"), ("p4", "z"), ("p4", "w")), "ignore", ("id",)), "claim": Change(claim(("p1", "p4", "open", 0.1), ("p1", "p2", "open", 0.2)))}
    assert store.commit(both) == 3
    assert len(rows(store.table("person"))) == 4 and ("p1", "x") in rows(store.table("person")) and len(rows(store.table("person", 2))) == 3
    assert store.tables() == ["claim", "person"] and store.tables(1) == ["person"]
    with pytest.raises(KeyError):
        store.table("claim", 1)
    with pytest.raises(ValueError, match="wipe"):
        store.commit({"person": Change(person(), "wipe")})


def test_a_batch_counts_once_and_writers_compete(spark, store):
    one = {"person": Change(spark.createDataFrame([("p1", "x")], PERSON))}
    assert store.commit(one, batch=("s", 0)) == 1 and store.commit(one, batch=("s", 0)) == 1
    with pytest.raises(Rejected):
        store.commit(one, batch=("s", 1))
    assert store.commit({"person": Change(spark.createDataFrame([], PERSON))}, batch=("t", 0)) == 2
    with pytest.raises(Conflict):
        store.store.publish({}, 1)


def test_stream_killed_and_restarted_equals_one_import(spark, tmp_path):
    good = spark.createDataFrame([(envelope(i),) for i in range(12)], "value string")
    lines = good.unionByName(spark.createDataFrame([("not json",), ("",), ("[1]",), ("{}",)], "value string"))
    for i, part in enumerate(lines.randomSplit([1.0] * 4, 7)):
        part.coalesce(1).write.mode("append").text(f"{tmp_path}/in/part={i}")
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(f"{tmp_path}/in/part=9")
    stream = lambda: spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_path}/in").select("value")
    store = Published(spark, f"{tmp_path}/store", [unique("envelope", "digest")])
    commit, calls = store.commit, []

    def dying(changes, batch=None):
        version = commit(changes, batch)
        calls.append(batch)
        if len(calls) in (2, 4):
            raise RuntimeError("killed after publishing")
        return version

    store.commit = dying
    for _ in range(6):
        query = import_stream(stream(), store, "s", f"{tmp_path}/ck")
        try:
            query.awaitTermination(240)
            break
        except Exception:  # noqa: BLE001, S112  the stream was killed; it starts again
            continue
    assert len(calls) > len({c[1] for c in calls})
    once = Published(spark, f"{tmp_path}/once")
    once.commit(envelope_batch(spark.read.text(f"{tmp_path}/in").select("value")))
    for name in ("envelope", "rejected_line"):
        assert rows(store.table(name)) == rows(once.table(name)) and store.table(name).count() > 0
    ids = lambda s: rows(import_envelopes(s.table("envelope")).entities.select("entity_id", "label"))
    assert ids(store) == ids(once)
