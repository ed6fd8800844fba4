"""Generations from deltas against recomputation."""

import random

import pytest

from evgraph.operators import identity
from evgraph.operators.generations import Generations
from evgraph.plans.versions import Conflict

LOG = "decision_id string, candidate_id string, entity_a long, entity_b long, outcome string, active boolean, seq long"
ENTITY = "entity_id long, origin string, cluster_id string"
IDS = "entity_id long, scheme string, value string, valid_to string"


def rows(frame):
    return sorted(map(tuple, frame.select("entity_id", "cluster_id", "canonical_id").collect()))


def test_equal_to_recomputation(spark, tmp_path):
    dice, log, seen = random.Random(5), [], {}
    people = [(i, dice.choice(["book", "github", "registry", None]), "clash") for i in range(40)]
    numbers = [(i, "viaf", str(i), None) for i in range(0, 40, 7)] + [(3, "orcid", "1", "2020")]
    now = Generations(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no generation"):
        now.members()
    for step in range(6):
        for _ in range(dice.randrange(1, 6)):
            log.append([f"d{len(log)}", f"k{len(log)}", *sorted(dice.sample(range(40), 2)), dice.choice(["accepted", "accepted", "rejected"]), True, len(log)])
        if step in (2, 4):
            for entry in dice.sample(log, 4):
                entry[5] = False
        if step == 3:
            people = [p for p in people if p[0] != 11] + [(77, "book", "x")]
            people[5] = (people[5][0], "manual", "x")
            numbers += [(9, "isni", "4", None)]
            log.append(["dx", "kx", 1, 77, "accepted", True, 99])
        frames = spark.createDataFrame(people, ENTITY), spark.createDataFrame(log, LOG), spark.createDataFrame(numbers, IDS)
        before, now = now, now.apply(*frames, reason=f"step {step}", most=3)
        alive = {p[0] for p in people}
        plain = spark.createDataFrame([e for e in log if {e[2], e[3]} <= alive] or [["", "", 0, 0, "rejected", False, 0]], LOG)
        seen[now.number] = rows(identity.generation(frames[0].select("entity_id", "origin"), plain, frames[2]))
        assert rows(now.members()) == seen[now.number] and now.number == before.number + 1
        assert len(now.manifest["parts"]) <= 3 and now.manifest["reason"] == f"step {step}"
    assert now.apply(*frames).number == now.number == now.latest
    for number, want in seen.items():
        assert rows(now.at(number).members()) == want
    with pytest.raises(Conflict):
        before.apply(spark.createDataFrame([(1, "book", "")], ENTITY), frames[1], frames[2])
    with pytest.raises(ValueError, match="no generation 99"):
        now.at(99)


def test_rows_written_follow_what_changed(spark, tmp_path):
    people = spark.range(2000).selectExpr("id AS entity_id", "'book' AS origin", "'' AS cluster_id")
    ids = spark.createDataFrame([], IDS)
    log = [["a", "a", 1, 2, "accepted", True, 1]]
    first = Generations(spark, str(tmp_path)).apply(people, spark.createDataFrame(log, LOG), ids)
    log += [["b", "b", 2, 3, "accepted", True, 2]]
    second = first.apply(people, spark.createDataFrame(log, LOG), ids)
    log[0][5] = False
    third = second.apply(people, spark.createDataFrame(log, LOG), ids)
    assert [g.manifest["rows"] for g in (first, second, third)] == [2000, 3, 3]
    assert rows(third.members().filter("entity_id < 4"))[1][2] == 1 and rows(third.members().filter("entity_id < 4"))[3][2] == 2
    got = identity.resolved(third.members(), spark.createDataFrame([(3,), (1,), (5000,)], "entity_id long")).orderBy("entity_id").collect()
    assert [(r["canonical_id"], r["redirected"], r["members"]) for r in got] == [(1, False, [1]), (2, True, [2, 3]), (None, None, None)]
