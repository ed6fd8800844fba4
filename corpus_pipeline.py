"""A corpus pipeline of four stages, each calling one operator of evgraph.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next stage's docs.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evgraph.llm import language_id, ngram_join, packing, secret_scan
from evgraph.llm.common import Scratch, remainder, table, tune
from evgraph.session import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _ready(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ship(spark)
    tune(spark)
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go; the others get the predicted one as `lang`. Repeated rows
    stay, rows without a doc_id too; an empty table stays empty."""
    docs = _ready(spark, docs)
    samples = language_id.fit(docs.filter(remainder("doc_id", 4) != 2))
    named = language_id.predict(docs, samples)
    return named.filter(F.col("lang_pred") != language_id.UNKNOWN).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays, with all its texts; of rows that agree in doc_id and
    text, the first by their other columns. Texts without words link with nothing, and rows without a doc_id stay as they are."""
    docs = _ready(spark, docs)
    found = ngram_join.similar(docs.select("doc_id", "text"))
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    with_id = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("row"))
    return with_id.select("doc_id", "text", *(F.col(f"row.{c}").alias(c) for c in others)).select(*COLUMNS).unionByName(docs.filter("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets leave the texts; all rows stay, repeated ones too; n_chars is counted anew where a text changed. A null text stays
    null, an empty table empty."""
    docs = _ready(spark, docs)
    found = secret_scan.redacted(docs.withColumn("n_before", F.length("text")))
    return found.withColumn("n_chars", F.when(F.length("text") == F.col("n_before"), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of full training sequences; a null text is the end id alone, repeated rows are packed each, an empty
    table gives no piece."""
    return packing.packed(_ready(spark, docs))


STAGES = [("language", language), ("deduplicate", deduplicate), ("secrets", secrets), ("pack", pack)]

#: Language identification by cross-parsing and guess costs have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over `documents`."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return scratch.write(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
