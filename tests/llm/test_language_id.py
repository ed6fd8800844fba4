"""Cross-parsing against a plain parse, and held-out accuracy."""

import random
import zlib

import numpy as np
import pandas as pd

from evgraph.llm import language_id as li
from evgraph.llm import queries


def plain_phrases(text, sample):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        if text[at] not in sample:
            size = 1
        at += size
        n += 1
    return n


def test_automaton_counts_longest_match_phrases():
    rng = random.Random(3)
    samples = (("x", "".join(rng.choice("abc ") for _ in range(300)).strip()), ("y", "".join(rng.choice("bcd ") for _ in range(200)).strip()))
    model = li.Model(samples)
    texts = ["".join(rng.choice("abcdz ") for _ in range(rng.randrange(0, 900))) for _ in range(60)] + [None, "", "zzz", "漢字", "a"]
    got, n = model.phrases(texts)
    for i, t in enumerate(texts):
        norm = " ".join("".join(c if c.isalpha() else " " for c in (t or "").lower()).split())
        assert n[i] == len(norm)
        for a, (_, sample) in enumerate(samples):
            assert got[a, i] == plain_phrases(norm, sample)


def test_parses_that_never_meet(monkeypatch):
    """Texts whose parse from a block's start stays apart from the true one over many blocks."""
    monkeypatch.setattr(li, "BLOCK", 8)
    samples = (("x", "abcabcabcabcabcabcabcab"), ("y", "aaaaaaa"), ("z", "abababababab cc"))
    texts = ["abc" * 50, "a" * 100, "ab" * 70 + "c", "aab" * 60, "c" + "abc" * 33, "a" * 8, "a" * 9, "abc" * 20 + "d" + "abc" * 20]
    got, n = li.Model(samples).phrases(texts)
    for i, t in enumerate(texts):
        assert [got[a, i] for a in range(3)] == [plain_phrases(t, s) for _, s in samples], t


def test_many_letters_are_edges_in_order():
    rng = random.Random(5)
    signs = [chr(0x4E00 + i) for i in range(600)]
    samples = (("zh", "".join(rng.choice(signs) for _ in range(2000))), ("en", "the cat sat on the mat and the dog sat on the cat"))
    texts = ["".join(rng.choice([*signs, "a", " the ", "Z"]) for _ in range(rng.randrange(700))) for _ in range(20)] + [samples[0][1][100:900], "the dog", "", None, "漢", "zzz"]
    sparse, dense = li.Model(samples), li.Model(samples, most=1 << 20)
    assert sparse.automata[0].table is None and dense.automata[0].table is not None and sparse.automata[1].table is not None
    assert sparse.automata[1].width < 30 and sparse.automata[0].keys.nbytes < 100_000
    (got, n), (want, _) = sparse.phrases(texts), dense.phrases(texts)
    assert (got == want).all()
    for i, t in enumerate(texts):
        norm = " ".join("".join(c if c.isalpha() else " " for c in (t or "").lower()).split())
        assert got[0, i] == plain_phrases(norm, samples[0][1]) and n[i] == len(norm)


def test_labels_are_learnt_however_their_rows_are_numbered(spark):
    words = {"en": "the quick brown fox", "es": "el zorro salta rapido", "fr": "le renard saute vite"}
    rows = [(7, f"{words['es']} {i}", "es") for i in range(3000)] + [(i, f"{words['en']} {'x' * (i % 50)}", "en") for i in range(3000)]
    rows += [(9, None, "fr")] * 2000 + [(9, "123", "fr")] * 50 + [(i, words["fr"] + chr(97 + i), "fr") for i in range(20)] + [(9, None, "none"), (9, "12", "none")]
    schema = "doc_id long, text string, lang string"
    got = li.fit(spark.createDataFrame(rows, schema), sample_chars=3000, sample_rows=50)
    assert [k for k, _ in got] == ["en", "es", "fr"]
    assert all(li.predict(spark.createDataFrame([(1, w, None)], schema), got).first()["lang_pred"] == k for k, w in words.items())
    assert len(got[2][1]) > 20 * len(words["fr"]) and all(len(s) <= 3000 for _, s in got)
    again = li.fit(spark.createDataFrame([(i, t, k) for i, (_, t, k) in enumerate(rows + rows[:100])], schema).repartition(3), sample_chars=3000, sample_rows=50)
    assert again == got


def test_short_texts_fill_the_sample(spark):
    docs = spark.createDataFrame([(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} abc", "l") for i in range(2000)], "doc_id long, text string, lang string")
    ((_, sample),) = li.fit(docs, sample_chars=4000, sample_rows=40)
    assert 3500 < len(sample) <= 4000
    assert len(li.fit(docs, sample_chars=4000, sample_rows=40, most_rows=100)[0][1]) <= 800


def test_windows_from_anywhere(spark):
    docs = spark.createDataFrame([(i, "x" * (5000 + i) + "y" * 5000, "l") for i in range(40)], "doc_id long, text string, lang string")
    ((_, sample),) = li.fit(docs, sample_chars=4000, sample_rows=40)
    assert len(sample) <= 4000 and {"x", "y"} <= set(sample)


def plain_language(docs):
    """The whole query with plain strings: (lang_pred, score) by doc_id."""
    learned = {}
    for (name, sample) in docs[1]:
        learned[name] = sample
    out = {}
    for d, t in docs[0]:
        norm = " ".join("".join(chr(c) for c in li.letters()[[ord(x) for x in t or ""]]).split())
        cost = {k: plain_phrases(norm, s) * np.log2(len(s)) for k, s in learned.items()}
        low, second = sorted(cost.values())[:2]
        out[d] = (min(cost, key=lambda k: (cost[k], k)), 1 - low / second) if norm else ("und", 0.0)
    return out


def test_query_against_plain_parses(spark, tmp_path):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 3000").limit(60)
    real.write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").toPandas()
    got = queries.queries()["op3_language_id"](spark, str(tmp_path)).toPandas().set_index("doc_id")
    held = [zlib.crc32(str(d).encode()) % 4 == 2 for d in rows.doc_id]
    samples = li.fit(spark.read.parquet(f"{tmp_path}/documents.parquet").filter("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2"))
    assert {k for k, _ in samples} == set(rows.lang[~np.array(held)].dropna())
    want = plain_language((list(zip(rows.doc_id, rows.text)), samples))
    for d, (lang, score) in want.items():
        assert got.lang_pred[d] == lang and abs(got.score[d] - score) < 1e-9


def test_normalise():
    codes, n = li.normalise(["  Ab, C9d!! ", None, "...", "É\n\nÈ", "𝒜𐐀 x", "a", " "])
    parts, at = [], 0
    for k in n:
        parts.append(codes[at : at + k].astype("<u4").tobytes().decode("utf-32-le"))
        at += k
    assert parts[0] == "ab c d" and parts[1:4] == ["", "", "é è"] and parts[5:] == ["a", ""] and parts[4].endswith(" x")


def test_held_out_accuracy(spark):
    real = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id")
    got = queries.queries()["op3_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    assert sorted(got.doc_id) == sorted(real.index) and list(got.columns)[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    assert got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.lang_pred.values == real.lang[held.doc_id].values).mean() > 0.97


def test_odd_rows(spark):
    rows = [(i, t, l, 0.5) for i, (t, l) in enumerate([("aaaa bbbb aabb", "x"), ("cccc dddd ccdd", "y"), (None, "x"), ("", "y"), ("12 34 !!", None), ("aab " * 5000, None), ("ccd", None), ("ccd", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = {r["doc_id"]: r for r in li.predict(docs, li.fit(docs)).collect()}
    assert [out[i]["lang_pred"] for i in range(8)] == ["x", "y", "und", "und", "und", "x", "y", "y"]
    assert out[4]["score"] == 0.0 and out[0]["lang"] == "x"
    assert {r["lang_pred"] for r in li.predict(docs, ()).collect()} == {"und"}
    assert li.fit(docs.limit(0)) == () and li.predict(docs.limit(0), li.fit(docs)).count() == 0


def test_no_label_is_read(spark):
    docs = spark.createDataFrame([(1, "hello there")], "doc_id long, text string")
    assert li.predict(docs, (("x", "hello"),)).columns == ["doc_id", "text", "lang_pred", "score"]
    assert np.isfinite(li.Model((("x", "hello"),)).predict(["hello"])[1]).all()
