"""Reads over people and works: layers, co-contribution, contemporaries, paths, topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_of, assumed_death
from ..plans.scratch import Scratch


def domain_family(domain: Column) -> Column:
    """All video domains are one."""
    return F.when(F.startswith(domain, F.lit("youtube")), F.lit("youtube")).otherwise(domain)


def layers(person: DataFrame, content: DataFrame) -> DataFrame:
    """Of each person that isn't merged away: number and names of domains, number of works; people without works stay."""
    per = content.withColumn("domain", domain_family(F.col("domain"))).groupBy("person_id", "domain").agg(F.count("content_ref").alias("n"))
    per = per.groupBy("person_id").agg(F.count("*").alias("domain_count"), F.sum("n").alias("content_count"), F.array_join(F.array_sort(F.collect_list("domain")), ",").alias("domains"))
    zero = F.lit(0).cast("long")
    return person.filter("state <> 'merged'").select("person_id", "name", "kind", "state", "origin").join(per, "person_id", "left").withColumns({"domain_count": F.coalesce("domain_count", zero), "content_count": F.coalesce("content_count", zero)})


def co_contributors(content: DataFrame, members: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """People who share works with the members (person_id), with the number of shared works; the members themselves are left out.

    The members' works are written first: where they are few, all the others' are held against them without a shuffle."""
    scratch = scratch or Scratch(content.sparkSession, "works")
    theirs = scratch.write(content.join(members.select("person_id").distinct(), "person_id", "left_semi").select("domain", "content_ref").distinct(), "theirs")
    shared = content.join(theirs, ["domain", "content_ref"], "left_semi").join(members.select("person_id").distinct(), "person_id", "left_anti")
    return shared.groupBy("person_id").agg(F.count_distinct("domain", "content_ref").alias("shared"))


def contemporaries(person: DataFrame, of: DataFrame | None = None, lifespan: int = 80, bucket: int = 25) -> DataFrame:
    """Pairs of people whose lives overlapped, with the overlap; `of` (person_id) restricts the first of the pair.

    A range join by buckets of years: each life stands in the buckets that it touches, pairs meet in one bucket, and only the first
    bucket that both touch yields the pair, so there is nothing to remove after.
    """
    alive = person.filter("state <> 'merged' AND birth_year IS NOT NULL").select("person_id", "name", F.col("birth_year").alias("b"), assumed_death(F.col("birth_year"), F.col("death_year"), lifespan).alias("d"))
    alive = alive.filter("d > b").withColumn("first", F.floor(F.col("b") / bucket)).withColumn("k", F.explode(F.sequence(F.col("first"), F.floor((F.col("d") - 1) / bucket))))
    one = alive.join(of.select("person_id").distinct(), "person_id", "left_semi") if of is not None else alive
    a, b = one.alias("a"), alive.alias("b")
    met = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.k") == F.greatest("a.first", "b.first")) & (F.col("a.person_id") != F.col("b.person_id")) & (F.greatest("a.b", "b.b") < F.least("a.d", "b.d")))
    return met.select("a.person_id", "a.name", F.col("b.person_id").alias("contemporary_id"), F.col("b.name").alias("contemporary_name"), F.greatest("a.b", "b.b").alias("overlap_start"), F.least("a.d", "b.d").alias("overlap_end"))


def path(content: DataFrame, start: DataFrame, goal: DataFrame, most_hops: int = 4, scratch: Scratch | None = None) -> DataFrame:
    """Shortest chains from any start to any goal person over shared works: hops, people, works; ties by the smaller ids.

    A frontier at a time: each person is reached once, from the smallest parent over the smallest work. Start and goal in common are
    a path of no hop. Edges are written once, and what a hop has reached before it meets them: so few works are known to be few, and
    the edges aren't shuffled for them.
    """
    scratch = scratch or Scratch(content.sparkSession, "path")
    edge = None
    none = F.array().cast("array<string>")
    seen = scratch.write(start.select("person_id").distinct().select("person_id", F.array("person_id").alias("people"), none.alias("works")), "hop-0")
    goal, frontier, all_seen = goal.select("person_id").distinct(), seen, seen.select("person_id")
    for hop in range(most_hops + 1):
        found = frontier.join(goal, "person_id", "left_semi")
        if not found.isEmpty() or hop == most_hops:
            return found.select(F.lit(hop).alias("hops"), "people", "works").orderBy("people", "works")
        if edge is None:
            edge = scratch.write(content.select("person_id", F.concat_ws(":", "domain", "content_ref").alias("work")), "edges")
        # of each work the first of the frontier's people that has it
        reached = scratch.write(frontier.join(edge, "person_id").groupBy("work").agg(F.min(F.struct("people", "works")).alias("by")), f"works-{hop + 1}")
        steps = reached.join(edge, "work").join(all_seen, "person_id", "left_anti").groupBy("person_id").agg(F.min(F.struct(F.col("by.people").alias("people"), F.col("work"), F.col("by.works").alias("works"))).alias("s"))
        frontier = scratch.write(steps.select("person_id", F.concat("s.people", F.array("person_id")).alias("people"), F.concat("s.works", F.array("s.work")).alias("works")), f"hop-{hop + 1}")
        all_seen = all_seen.unionByName(frontier.select("person_id"))
    raise AssertionError("unreachable")


def top(frame: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group."""
    return frame.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= k).drop("_n")


def topic_people(topics: DataFrame, person: DataFrame, topic: str, scheme: str | None = None) -> DataFrame:
    """People with a topic by weight; vocabularies are never mixed, so the scheme is part of each row."""
    chosen = topics.filter(F.lower("topic") == topic.lower())
    if scheme is not None:
        chosen = chosen.filter(F.col("scheme") == scheme)
    return chosen.join(person.select("person_id", "name"), "person_id").select("person_id", "name", "topic", "scheme", "weight")


def relationships_at(relationships: DataFrame, types: DataFrame, at: Column, subjects: DataFrame | None = None) -> DataFrame:
    """Accepted relationships (subject_entity_id, relationship_type_id, review_state, valid_from, valid_to) that hold at a time, with
    their type's namespace and name; of all subjects, or of those given (subject_entity_id)."""
    rows = relationships.filter((F.col("review_state") == "accepted") & as_of(F.col("valid_from"), F.col("valid_to"), at))
    rows = rows if subjects is None else rows.join(subjects.select("subject_entity_id").distinct(), "subject_entity_id", "left_semi")
    return rows.join(types.select("relationship_type_id", "namespace", "local_name"), "relationship_type_id")
