"""Each stage against a plain version of it, and the whole against the stages."""

import pandas as pd
import pytest

import corpus_pipeline
from evgraph.llm import language_id, packing, secret_scan
from tests.llm.test_ngram_join import brute
from tests.llm.test_tokens import check_packing, hub

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, None, "x", 0), (-2, "12 34", "en", "x", 5), (-3, "", None, "x", 0)], docs.schema)
    out, now = [], docs.unionByName(extra)
    out.append(now.toPandas())
    for _, f in corpus_pipeline.STAGES:
        now = f(spark, now, SF)
        out.append(now.toPandas())
        if len(out) <= len(corpus_pipeline.STAGES):
            now = spark.createDataFrame(out[-1], now.schema)
    return out


def test_columns(stages):
    assert all(list(s.columns) == COLUMNS for s in stages[:-1])


def test_language_keeps_all_with_letters(stages):
    before, after = stages[:2]
    assert set(after.doc_id) == {d for d, t in zip(before.doc_id, before.text) if t and any(c.isalpha() for c in t)}
    both = after.merge(before, on="doc_id", suffixes=("", "_was"))
    assert (both.lang == both.lang_was).mean() > 0.97 and (both.text == both.text_was).all()
    assert language_id.UNKNOWN not in set(after.lang)


def test_one_of_each_group_stays(stages):
    before, after = stages[1:3]
    want = {c for _, c in brute(zip(before.doc_id, before.text)).values()}
    assert sorted(after.doc_id) == sorted(want) and len(after) < len(before)


def test_secrets_leave(stages):
    before, after = stages[2:4]
    both = after.merge(before, on="doc_id", suffixes=("", "_was"))
    assert len(both) == len(before) and (both.text != both.text_was).any()
    for new, old in zip(both.text, both.text_was):
        spans = sorted(secret_scan.base_spans(old) + secret_scan.guess_spans(old, 36.0))
        assert new == secret_scan.redact(old, spans)
    assert (both.n_chars == both.text.map(len)).all()


def test_packed_whole(stages):
    docs, pieces = stages[3:]
    padding, _ = check_packing(pieces.to_dict("records"), list(zip(docs.doc_id, docs.text)), hub("word_bpe_49k.json"))
    assert padding <= 8 * max(packing.TIERS)


def test_run(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF)
    assert set(r["doc_id"] for r in got.select("doc_id").distinct().collect()) <= set(docs.doc_id)


def test_empty(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        now = f(spark, now, SF)
        assert now.count() == 0


def test_repeated_rows_and_nulls(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text, "en", None, None), (1, text, "en", None, None), (None, text, "en", "s", 3), (2, text, None, "s", 3), (3, None, "en", "s", 3)], schema)
    one = corpus_pipeline.language(spark, docs, SF)
    assert one.count() == 4
    two = corpus_pipeline.deduplicate(spark, one, SF)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in two.collect()) == [(False, 1), (True, 0)]
    assert corpus_pipeline.secrets(spark, two, SF).count() == 2
    assert corpus_pipeline.pack(spark, two, SF).count() >= 2


def test_texts_of_one_document_stay(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    a, b = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven")
    docs = spark.createDataFrame([(1, a, "en", "t", 9), (1, b, "en", "s", 9), (1, b, "de", "s", 9), (1, b, None, "z", 1), (2, a, "en", "s", 3)], schema)
    for n in (1, 5):
        got = corpus_pipeline.deduplicate(spark, docs.repartition(n), SF).collect()
        assert sorted(map(tuple, got)) == [(1, a, "en", "t", 9), (1, b, None, "z", 1)]
