"""Author strings are read once, and as before."""

from pyspark.sql import functions as F

from evgraph.functions import authors
from evgraph.operators import rollups


def test_tokens_are_found_once(spark):
    frame = spark.range(3).select(F.concat(F.lit("Plato, 428? BCE-348? BCE [Author"), F.col("id").cast("string"), F.lit("]")).alias("c"))
    read = frame.select(authors.parsed(F.col("c")).alias("a")).select("a.*")
    assert read._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert {tuple(r)[:3] for r in read.collect()} == {("Plato", -428, -348)}


def test_chunks_are_read_once(spark):
    books = spark.createDataFrame([(1, "Ada, L., 1815-1852; ;Various", "Text"), (2, "b. 1900", "Text"), (3, None, "Text"), (4, "", "Text"), (5, "X, ca. 1900-", "Sound")], "gid long, authors string, media_type string")
    rows = rollups.chunks(books).filter("author IS NOT NULL").select("gid", "i", "chunk", "author.*")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 0, "Ada, L., 1815-1852", "Ada, L.", 1815, 1852, "author", False), (1, 2, "Various", "Various", None, None, "author", True), (2, 0, "b. 1900", "b. 1900", None, None, "author", True)]
