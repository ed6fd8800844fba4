"""Exact duplicates by deterministic block naming, with DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Bytes of a block.
BLOCK = 2048
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z as a-z, all else as it is; null as empty. Where a text is ASCII the built-in lower case is the same and faster."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def _blocks(data: Column, size: int) -> Column:
    """The blocks of a binary value in order; one empty block of an empty value."""
    last = ((F.octet_length(data) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def digests(block: Column) -> tuple[Column, Column]:
    """Two hashes of a block, by which its name is looked up; equal ones of different blocks are told apart by the blocks."""
    return F.xxhash64(block), F.xxhash64(F.lit(1), block)


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Distinct rows with integer names that ascend in their sorted order over all partitions."""
    return distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, scratch: Scratch, size: int = BLOCK, key: Callable[[Column], tuple[Column, Column]] = digests) -> DataFrame:
    """(row, doc_id, text_sha256, level, name): rows of `docs` (doc_id, text) are equal in their lowered texts if and only if they
    agree in level and name.

    All distinct blocks are sorted and numbered, then the distinct pairs of adjacent names (the last alone, with -1, where their
    number is odd), then pairs of those, until each row has one name; the level is the number of rounds, which the number of blocks
    decides. A name stands for one sequence of blocks, so no two texts share one. Texts are shuffled twice, as distinct blocks, to
    be made distinct and to be sorted; occurrences carry two hashes instead. Texts with a block that agrees in both with another one
    are named by the blocks themselves.

    Names are written before they are used, so a lost executor changes none. A text of many blocks is many rows in all steps but
    the first, where its task holds it whole.
    """
    texts = docs.select("doc_id", lowered(F.col("text")).alias("text"))
    cut = texts.select("doc_id", F.sha2(F.col("text"), 256).alias("text_sha256"), F.col("text").cast("binary").alias("data"))
    hashes = F.transform(_blocks(F.col("data"), size), lambda b: F.struct(key(b)[0].alias("h"), key(b)[1].alias("g")))
    rows = scratch.write(cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_sha256", hashes.alias("keys")), "rows")
    distinct = cut.select(F.explode(_blocks(F.col("data"), size)).alias("block")).distinct()
    h, g = key(F.col("block"))
    names = scratch.write(_numbered(distinct, "block").select(h.alias("h"), g.alias("g"), "name"), "names")
    scratch.release()
    placed = rows.select("row", "text_sha256", F.size("keys").alias("m"), F.posexplode("keys").alias("i", "k")).select("row", "text_sha256", "m", "i", "k.h", "k.g")
    twice = scratch.write(names.groupBy("h", "g").agg(F.count("*").alias("n")).filter("n > 1").select("h", "g"), "twice")
    rows, now = rows.select("row", "doc_id", "text_sha256"), placed
    if not twice.isEmpty():
        # texts with such a block are read once more, with their blocks; a digest picks them, so equal texts go the same way
        apart = scratch.write(placed.join(twice, ["h", "g"], "left_semi").select("text_sha256").distinct(), "apart")
        whole = scratch.write(cut.join(apart, "text_sha256", "left_semi").select((-1 - F.monotonically_increasing_id()).alias("row"), "doc_id", "text_sha256", _blocks(F.col("data"), size).alias("blocks")), "whole")
        own = scratch.write(_numbered(whole.select(F.explode("blocks").alias("block")).distinct(), "block"), "own").withColumn("name", -2 - F.col("name"))
        known = whole.select("row", F.size("blocks").alias("m"), F.posexplode("blocks").alias("i", "block")).join(own, "block").select("row", "m", "i", "name")
        rows = rows.join(apart, "text_sha256", "left_anti").select("row", "doc_id", "text_sha256").unionByName(whole.select("row", "doc_id", "text_sha256"))
        now = placed.join(apart, "text_sha256", "left_anti")
    now = now.join(names, ["h", "g"]).select("row", "m", "i", "name")
    now = scratch.write(now if twice.isEmpty() else now.unionByName(known), "level-0")
    most = now.agg(F.max("m")).first()[0] or 1
    level, done = 0, [now.filter("m = 1").select("row", F.lit(0).alias("level"), "name")]
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        even = F.col("i") % 2 == 0
        pairs = now.filter("m > 1").groupBy("row", ((F.col("m") + 1) / 2).cast("int").alias("m"), (F.col("i") / 2).cast("int").alias("i")).agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = scratch.write(pairs, f"pairs-{level}")
        named = scratch.write(_numbered(pairs.select("a", "b").distinct(), "a", "b"), f"names-{level}")
        now = scratch.write(pairs.join(named, ["a", "b"]).select("row", "m", "i", "name"), f"level-{level}")
        done.append(now.filter("m = 1").select("row", F.lit(level).alias("level"), "name"))
    every = done[0]
    for one in done[1:]:
        every = every.unionByName(one)
    return rows.join(every, "row")


def exact(docs: DataFrame, scratch: Scratch | None = None, size: int = BLOCK, key: Callable[[Column], tuple[Column, Column]] = digests) -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts are equal to each other. Of equal
    texts the row of the largest doc_id stays, a null doc_id being the least; of repeated rows of that doc_id exactly one is kept.
    keep_id is null where all of a group's doc_ids are. An empty table gives none; other columns of `docs` are not read, whatever
    their names. Groups are counted and joined by a number, so a group of a third of all rows is summed before it is shuffled and
    its join is one that adaptive execution splits.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    found = scratch.write(identities(docs.select("doc_id", "text"), scratch, size, key), "identities")
    groups = scratch.write(found.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")), "groups")
    return found.join(groups, ["level", "name"]).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
