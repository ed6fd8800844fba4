"""Builds of the graph: catalogue people, owners, topics, values, and the enrichment queue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.authors import parsed, person_key
from ..functions.jsonx import string_list
from ..functions.text import after_slash, before_slash, collapsed, shortened
from ..plans.scratch import Scratch
from .graph import top

# Words of repository topics that say nothing, and parts of logins that organisations have.
NOISE = (
    "awesome", "list", "lists", "hacktoberfest", "github", "opensource", "open-source", "tutorial", "example", "examples", "demo", "test", "boilerplate", "starter", "template", "library", "framework", "tool", "tools", "app", "api", "cli", "web", "software",
)
ORGANISATIONAL = ("-org", "-team", "-labs", "-inc", "-io", "foundation", "institute", "technologies", "systems", "software", "group", "community", "project")


def chunks(books: DataFrame, authors: str = "authors") -> DataFrame:
    """A row for each author of a catalogue row: gid, chunk and what it says; chunks without a name have a null `author`."""
    texts = books.filter((F.col("media_type") == "Text") & (F.col(authors) != ""))
    # read before they become rows: a filter on what is read would read it again
    each = F.transform(F.split(authors, ";"), lambda c: F.struct(c.alias("chunk"), parsed(c).alias("author")))
    return texts.select("gid", F.posexplode(each).alias("i", "c")).select("gid", "i", "c.chunk", "c.author")


def book_people(books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """People of a catalogue (first display name, first known years, all spellings, number of works) and their edges to works."""
    rows = chunks(books).filter("author IS NOT NULL").select("gid", "i", F.trim("chunk").alias("variant"), "author.*").withColumn("person_key", person_key(F.col("name"), F.col("birth"), F.col("death")))
    edges = rows.select("person_key", "gid", "role").distinct()
    at = F.struct("gid", "i")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), at))
    people = rows.groupBy("person_key").agg(F.min_by("name", at).alias("display_name"), first("birth").alias("birth_year"), first("death").alias("death_year"), F.min_by("corporate", at).alias("is_corporate"), F.array_sort(F.collect_set("variant")).alias("variants"))
    return people.join(edges.groupBy("person_key").agg(F.count("*").alias("work_count")), "person_key", "left"), edges


def build_summary(people: DataFrame, edges: DataFrame) -> DataFrame:
    counts = people.agg(F.count("*").alias("people"), F.count_if("is_corporate").alias("corporate"), F.count_if(F.col("birth_year").isNotNull() | F.col("death_year").isNotNull()).alias("with_life_years"))
    return counts.crossJoin(F.broadcast(edges.agg(F.count("*").alias("edges"))))  # one row each


def repositories(cards: DataFrame, min_stars: int = 0) -> DataFrame:
    """Repository cards that have an owner, are no fork and have stars enough."""
    fork = F.coalesce(F.col("fork").cast("string"), F.lit(""))
    own = cards.filter(F.contains(F.col("full_name"), F.lit("/")) & fork.isin("", "0", "false") & (F.coalesce("stars", F.lit(0)) >= min_stars))
    return own.withColumns({"login": before_slash(F.col("full_name")), "repo": after_slash(F.col("full_name"))}).filter("login <> '' AND repo <> ''")


def organisational(login: Column) -> Column:
    return F.lower(login).rlike("|".join(ORGANISATIONAL))


def owners(cards: DataFrame, known: DataFrame, min_stars: int = 0) -> tuple[DataFrame, DataFrame]:
    """Owners with numbers of repositories, stars and languages, and owner edges.

    known: (login, person_id, priority); an account's id of lower priority number wins over one by the login itself.
    """
    repos = repositories(cards, min_stars).withColumn("key", F.lower("login"))
    ids = known.groupBy(F.lower("login").alias("key")).agg(F.min_by("person_id", F.struct("priority", "person_id")).alias("known_id"))
    rolled = repos.groupBy("key").agg(F.min_by("login", "full_name").alias("login"), F.count("*").alias("repos"), F.sum(F.coalesce("stars", F.lit(0))).alias("stars"), F.array_sort(F.collect_set("language")).alias("languages")).join(ids, "key", "left")
    rolled = rolled.select(F.coalesce("known_id", F.concat(F.lit("gh:"), "login")).alias("person_id"), "login", "repos", "stars", "languages", F.col("known_id").isNull().alias("is_new"), F.when(organisational(F.col("login")), "organisation").otherwise("unknown").alias("kind"))
    edges = repos.join(ids, "key", "left").select(F.coalesce("known_id", F.concat(F.lit("gh:"), "login")).alias("person_id"), F.lit("github").alias("domain"), F.col("full_name").alias("content_ref"), F.lit("owner").alias("role"), F.coalesce("stars", F.lit(0)).cast("double").alias("score"), shortened(F.col("description")).alias("title"))
    return rolled, edges


def owner_topics(cards: DataFrame, people: DataFrame, min_stars: int = 0, most_topics: int = 25, most_languages: int = 8) -> DataFrame:
    """Topics and languages of owners that are in the graph, the most frequent ones; ties go to the smaller word."""
    known = people.filter(F.startswith("person_id", F.lit("gh:"))).groupBy(F.lower(F.substring("person_id", 4, 1_000_000)).alias("key")).agg(F.min("person_id").alias("person_id"))
    own = cards.filter(F.contains(F.col("full_name"), F.lit("/")) & (F.coalesce("stars", F.lit(0)) >= min_stars)).withColumn("key", F.lower(before_slash(F.col("full_name")))).join(known, "key")
    word = F.lower(F.trim("t"))
    topics = own.select("person_id", F.explode(string_list(F.col("topics_json"))).alias("t")).select("person_id", word.alias("topic")).filter((F.length("topic") > 2) & ~F.col("topic").isin(*NOISE))
    languages = own.filter("language <> ''").select("person_id", F.col("language").alias("topic"))
    out = []
    for frame, scheme, k in ((topics, "github_topic", most_topics), (languages, "github_lang", most_languages)):
        counted = frame.groupBy("person_id", "topic").agg(F.count("*").cast("double").alias("weight"))
        out.append(top(counted, ["person_id"], [F.desc("weight"), F.asc("topic")], k).withColumn("scheme", F.lit(scheme)))
    return out[0].unionByName(out[1])


def weighted_mean(rated: DataFrame, item: str, group: Column, value: str) -> DataFrame:
    """Mean of item means by group, weighted by how often an item was rated; an item without a value counts as 0."""
    items = rated.groupBy(item).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return items.groupBy(group.alias("group")).agg(F.sum("n").alias("rated"), F.try_divide(F.sum(F.coalesce("mean", F.lit(0.0)) * F.col("n")), F.sum("n")).alias("value"))


def first_wins(frame: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return top(frame, keys, list(order), 1)


def mark_tracked(person: DataFrame, content: DataFrame) -> DataFrame:
    """People without any work are tracked, the others linked; merged ones stay merged."""
    has = content.select("person_id").distinct().withColumn("_has", F.lit(True))
    return person.join(has, "person_id", "left").withColumn("state", F.when(F.col("state") == "merged", F.col("state")).when(F.col("_has"), "linked").otherwise("tracked")).drop("_has")


def subjects(content: DataFrame, book_subjects: DataFrame) -> DataFrame:
    """Weights of subjects of people through their books; a reference that is no number has none."""
    books = content.filter("domain = 'book'").withColumn("gid", F.col("content_ref").try_cast("bigint"))
    return books.join(book_subjects, "gid").groupBy("person_id", F.col("subject").alias("topic")).agg(F.count("*").cast("double").alias("weight"))


def enrichment_queue(people: DataFrame, observed: DataFrame, fields: list[str], limit: int) -> DataFrame:
    """People with fields that no receipt covers, by rank; observed: (person_id, field)."""
    wanted = people.select("person_id", "rank_score", F.explode(F.array(*map(F.lit, fields))).alias("field"))
    missing = wanted.join(observed, ["person_id", "field"], "left_anti").groupBy("person_id", "rank_score").agg(F.array_sort(F.collect_list("field")).alias("missing"))
    return missing.orderBy(F.col("rank_score").desc_nulls_last(), "person_id").limit(limit)


def replay(queue: DataFrame, profiles: DataFrame) -> DataFrame:
    """Receipts of a replayed enrichment: of each missing field whether the profile (person_id, field, value) has it."""
    return queue.select("person_id", F.explode("missing").alias("field")).join(profiles, ["person_id", "field"], "left").withColumn("status", F.when(F.trim("value") != "", "present").otherwise("absent"))


def name_merge(incoming: DataFrame, existing: DataFrame, key: Column) -> DataFrame:
    """Of incoming people: the id of the existing one of equal key (the first, by id), else their own."""
    ids = existing.groupBy(key.alias("_key")).agg(F.min("person_id").alias("existing_id"))
    return incoming.withColumn("_key", key).join(ids, "_key", "left").withColumn("merged_id", F.coalesce("existing_id", "person_id")).drop("_key")


def latest(frame: DataFrame, keys: list[str], order: Column) -> DataFrame:
    return frame.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("_n = 1").drop("_n")


@dataclass
class Graph:
    """Tables of a built people graph."""

    person: DataFrame
    content: DataFrame
    external_ids: DataFrame
    topics: DataFrame

    def summary(self) -> DataFrame:
        """(what, n): rows of each table, people with life dates and in several domains, and people by state."""
        several = self.content.groupBy("person_id").agg(F.count_distinct("domain").alias("d")).filter("d >= 2")
        counts = {"person": self.person, "with_life_dates": self.person.filter("birth_year IS NOT NULL"), "person_content": self.content, "person_topic": self.topics, "external_ids": self.external_ids, "multi_domain": several}
        out = self.person.groupBy(F.concat(F.lit("state:"), "state").alias("what")).agg(F.count("*").alias("n"))
        for name, frame in counts.items():
            out = out.unionByName(frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n"))
        return out


def build_graph(known: DataFrame, known_content: DataFrame, known_ids: DataFrame, book_people: DataFrame, book_works: DataFrame, books: DataFrame, book_subjects: DataFrame, at: str, scratch: Scratch | None = None) -> Graph:
    """A people graph of known people (person_id, name, origin, rank_score) with the people of books (person_key, display_name,
    birth_year, death_year, work_count, is_corporate).

    A book person of a known name is that person, of several the one of the least id; else book people of one name are one new
    person. Corporate ones are none. Dates of books fill empty ones only. Of repeated edges (person, domain, work, role) a book's
    goes first. known_content: person_id, domain, content_ref, score, title; known_ids: person_id, platform, value; book_works:
    person_key, gid, role; books: gid, title; book_subjects: gid, subject. A null name is an empty one.
    """
    scratch = scratch or Scratch(known.sparkSession, "built")
    key = lambda c: collapsed(F.coalesce(F.col(c), F.lit("")))
    old = known.dropDuplicates(["person_id"]).withColumn("_key", key("name"))
    people = book_people.filter(~F.coalesce("is_corporate", F.lit(False))).withColumn("_key", key("display_name"))
    named = old.groupBy("_key").agg(F.min("person_id").alias("_old"))
    fresh = people.groupBy("_key").agg(F.min("person_key").alias("_first"))
    linked = scratch.write(people.join(fresh, "_key").join(named, "_key", "left").withColumn("person_id", F.coalesce("_old", F.concat(F.lit("bk:"), "_first"))), "linked")
    dates = linked.filter("birth_year IS NOT NULL").groupBy("person_id").agg(F.min_by(F.struct("birth_year", "death_year"), "person_key").alias("_d"))
    new = linked.filter("_old IS NULL AND person_key = _first").dropDuplicates(["person_id"]).select("person_id", F.col("display_name").alias("name"), F.lit("books").alias("origin"), F.col("work_count").cast("double").alias("rank_score"), "birth_year", "death_year")
    none = F.lit(None).cast("int")
    every = old.select("person_id", "name", "origin", F.col("rank_score").cast("double").alias("rank_score"), none.alias("birth_year"), none.alias("death_year")).unionByName(new)
    empty = F.col("birth_year").isNull() & F.col("_d").isNotNull()
    person = every.join(dates, "person_id", "left").select("person_id", "name", F.lit("human").alias("kind"), "origin", "rank_score", *[F.when(empty, F.col(f"_d.{c}")).otherwise(F.col(c)).alias(c) for c in ("birth_year", "death_year")], F.lit("linked").alias("state"), F.lit(at).alias("built_at"))
    titles = books.groupBy("gid").agg(F.min("title").alias("title"))
    edges = book_works.join(linked.select("person_key", "person_id").distinct(), "person_key").join(titles, "gid", "left").select("person_id", F.lit("book").alias("domain"), F.col("gid").cast("string").alias("content_ref"), "role", F.lit(None).cast("double").alias("score"), "title", F.lit("gutenberg").alias("source"), F.lit(0).alias("_n"))
    moved = known_content.select("person_id", "domain", "content_ref", F.lit("author").alias("role"), F.col("score").cast("double").alias("score"), "title", F.lit("v1_migration").alias("source"), F.lit(1).alias("_n"))
    keys = ["person_id", "domain", "content_ref", "role"]
    # the first of repeated edges by aggregation, which combines before the shuffle; a window would not
    row = F.struct("_n", "title", "score", "source")
    content = scratch.write(edges.unionByName(moved).groupBy(*keys).agg(F.min(row).alias("r")).select(*keys, "r.score", "r.title", "r.source", F.lit(at).alias("observed_at")), "content")
    ids = known_ids.select("person_id", "platform", "value").distinct().select("*", F.lit(1.0).alias("confidence"), F.lit("v1_migration").alias("source"))
    topics = subjects(content, book_subjects).select("person_id", "topic", F.lit("lcsh").alias("scheme"), "weight", F.lit("gutenberg").alias("source"))
    return Graph(scratch.write(mark_tracked(person, content), "person"), content, ids, topics)
