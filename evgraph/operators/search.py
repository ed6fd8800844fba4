"""Full-text search: postings, phrases, relevance, and the substring fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import search_tokens, unaccented


def postings(frame: DataFrame, key: str, text: Column) -> DataFrame:
    """(token, key, positions, tf, size): the inverted index of a text column."""
    words = frame.select(F.col(key), search_tokens(text).alias("w"))
    each = words.select(key, F.size("w").alias("size"), F.posexplode("w").alias("position", "token"))
    return each.groupBy("token", key, "size").agg(F.array_sort(F.collect_list("position")).alias("positions"), F.count("*").alias("tf"))


def phrase(frame: DataFrame, text: Column, words: str) -> DataFrame:
    """Rows whose tokens hold the phrase's tokens one after another."""
    tokens = F.concat(F.lit(" "), F.array_join(search_tokens(text), " "), F.lit(" "))
    wanted = F.concat(F.lit(" "), F.array_join(search_tokens(F.lit(words)), " "), F.lit(" "))
    return frame.filter(F.contains(tokens, wanted) & (F.trim(wanted) != ""))


def relevance(index: DataFrame, key: str, words: str, n_docs: int, mean_size: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 over an index: (key, score), best first, ties by key."""
    wanted = index.sparkSession.range(1).select(F.explode(F.array_distinct(search_tokens(F.lit(words)))).alias("token"))
    hits = index.join(F.broadcast(wanted), "token")  # a query's words
    df = hits.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("size") / mean_size))
    return hits.join(F.broadcast(df), "token").groupBy(key).agg(F.sum(part).alias("score")).orderBy(F.desc("score"), key)


def containing(frame: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose column holds a part, whatever its case and accents; no character of the part is a wildcard."""
    return frame.filter(F.contains(unaccented(F.col(column)), unaccented(F.lit(part))))
