"""Sketches against plain multisets of cells."""

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from evgraph.llm import fingerprints as fp
from evgraph.llm import queries


def plain(texts):
    d, n = fp.digests(texts)
    cut = np.split(d, np.cumsum(n)[:-1])
    return (d, n), [set(x.tolist()) for x in cut]


def test_peeling_recovers_differences():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdef"), 6))
    texts = [" ".join(word() for _ in range(rng.integers(0, 900))) for _ in range(40)] + ["", "\n\n", "x\nx\nx\ny", "x\nx\ny"]
    other = [t if i % 3 == 0 else t[: len(t) // 2] + " new words here" if i % 3 == 1 else texts[i - 1] for i, t in enumerate(texts)]
    a, sa = plain(texts)
    b, sb = plain(other)
    assert fp.differing(a, b).tolist() == [len(x ^ y) for x, y in zip(sa, sb)]
    assert all(len(s) == k for s, k in zip(sa, a[1])) and not sa[40] and len(sa[42] ^ sa[43]) == 1


def test_recovered_digests_are_those():
    d, n = fp.digests(["a\nb\nc\nd", "a\nb\nx"])
    (da, oa), (db, ob) = fp._some(d, n, np.array([0])), fp._some(d, n, np.array([1]))
    ca, ka, xa = fp.sketch(da, oa, 1, 33)
    cb, kb, xb = fp.sketch(db, ob, 1, 33)
    _, found, whole = fp.peel(ca - cb, ka ^ kb, xa ^ xb)
    assert whole.all() and set(found.tolist()) == set(da.tolist()) ^ set(db.tolist())


def brute(docs):
    docs = [(d, t or "") for d, t in docs]
    docs.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for (d, t), (_, f) in zip(docs, docs[1:] + docs[:1]):
        k = len(t) // 3
        new = t[: len(t) - k] + f[:k]
        (_, _), s = plain([t, new, f])
        like = lambda x, y: 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0
        out[d] = (len(t), hashlib.sha256(new.encode()).hexdigest(), pytest.approx(like(s[0], s[1])), pytest.approx(like(s[0], s[2])))
    return out


def test_query(spark):
    real = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.queries()["op5_fingerprints"](spark, "/root/testdata/sf0.01").toPandas()
    want = brute(zip(real.doc_id, real.text))
    assert len(got) == len(real)
    for r in got.itertuples():
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == want[r.doc_id]
    assert got.near_edited.mean() > got.near_next.mean() + 0.3
    text = real.set_index("doc_id").text
    by = {}
    for r in got.itertuples():
        assert by.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint


def test_odd_rows(spark):
    rows = [(5, "a b c\nd e f"), (4, None), (3, ""), (2, "é" * 7), (1, "z " * 4000), (None, "q")]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, extra string")
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in fp.compare(docs).collect()}
    assert got == brute(rows)
    assert fp.compare(docs.limit(0)).count() == 0
    assert fp.compare(docs.limit(1)).count() == 1
    twice = docs.filter("doc_id = 5").unionByName(docs.filter("doc_id = 5"))
    assert [r["near_next"] for r in fp.compare(twice).collect()] == [1.0, 1.0]
    assert len({len(set(Counter(r["fingerprint"] for r in fp.compare(twice).collect())))}) == 1


def test_buckets(spark):
    from evgraph.llm.bit_planes import bucket_of, id_bounds

    for bounds in ([], [5], [2, 5, 9], list(range(0, 100, 7))):
        got = {r["id"]: r["b"] for r in spark.range(-3, 110).select("id", bucket_of("id", bounds).alias("b")).collect()}
        assert got == {i: sum(b <= i for b in bounds) for i in range(-3, 110)}
    assert spark.createDataFrame([(None,)], "id long").select(bucket_of("id", [1]).alias("b")).first()["b"] == 0
    bounds = id_bounds(spark.range(1000).withColumnRenamed("id", "doc_id"), 4)
    assert bounds == sorted(bounds) and len(bounds) == 3
