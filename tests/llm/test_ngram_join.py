"""The n-gram join and the components against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from evgraph.llm import ngram_join, queries
from evgraph.llm.common import Scratch
from evgraph.operators.components import components


def closure(ids, pairs):
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(docs, words=5):
    sets = {}
    for d, t in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        sets[d] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    at, pairs = {}, set()
    for d, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(d)
    seen = set()
    for ds in at.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        pairs.add((a, b))
    comp = closure(sets, pairs)
    return {d: (len(s), comp[d]) for d, s in sets.items()}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 60
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([0, 20, 40, 80]))]
    if seed == 3:
        pairs = [(i, i + 1) for i in range(n - 1)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "u long, v long"), Scratch(spark, "test")).collect()}
    want = closure(range(n), pairs)
    assert got == {i: want[i] for p in pairs if p[0] != p[1] for i in p}


def test_on_real_rows(spark):
    real = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(zip(real.doc_id, real.text))
    assert result(queries.op2_ngram_join(spark, "/root/testdata/sf0.01")) == want
    assert sum(d != c for d, (_, c) in want.items()) > 20


def test_near_copies_and_long_lists(spark):
    """A large group of near copies, a passage in very many texts, and edits on both sides of the threshold."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(80)], [word() for _ in range(60)]
    docs = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    docs += [" ".join(passage + [word() for _ in range(rng.randrange(5, 40))]) for _ in range(120)]
    docs += [None, "", " \t", "A b", "a  B", "one two three four", "é é é é é é é é"]
    rows = list(enumerate(docs, 1))
    frame = spark.createDataFrame([(i, t, "n", "u") for i, t in rows], "doc_id long, text string, n string, u string")
    got = ngram_join.similar(frame, heavy=10, block=7)
    assert result(got) == brute(rows)


def test_repeated_rows_and_empty(spark):
    frame = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "x y")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.similar(frame).collect()), key=str) == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 1, None)]
    assert ngram_join.similar(frame.limit(0)).count() == 0


def brute_documents(rows):
    """As `brute`, where rows of one doc_id are one document of all their texts."""
    texts = [(i, t) for i, (_, t) in enumerate(rows)]
    comp = {i: c for i, (_, c) in brute(texts).items()}
    nodes = [d for d, _ in rows] + [("class", c) for c in comp.values()]
    order = {x: k for k, x in enumerate(sorted(set(d for d, _ in rows)) + sorted({n for n in nodes if isinstance(n, tuple)}))}
    back = {k: x for x, k in order.items()}
    top = closure(order.values(), [(order[d], order["class", comp[i]]) for i, (d, _) in enumerate(rows)])
    sizes = {i: n for i, (n, _) in brute(texts).items()}
    return sorted((d, sizes[i], back[top[order[d]]]) for i, (d, _) in enumerate(rows))


def test_documents_of_several_texts(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    a, b = [" ".join(word() for _ in range(60)) for _ in range(2)]
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, " ".join(word() for _ in range(30)))]
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    bases, rows = [[word() for _ in range(40)] for _ in range(12)], []
    for _ in range(90):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = word()
        rows.append((rng.randrange(60), " ".join(w)))
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string"), heavy=5, block=3)
    assert sorted(map(tuple, got.collect())) == brute_documents(rows)


def test_pivots_are_spread(spark):
    pairs = spark.createDataFrame([(1, v) for v in range(2, 40)] + [(50, 51), (50, 52)], "u long, v long")
    classes = spark.createDataFrame([(1, 9, b"a"), (50, 8, b"b")], "class long, n long, bits binary")
    got = ngram_join.with_pivots(pairs, classes, 10, hot=5, salts=4).collect()
    assert sorted((r["u"], r["v"], r["un"], bytes(r["ubits"]), r["blocks"]) for r in got) == [(1, v, 9, b"a", 4) for v in range(2, 40)] + [(50, 51, 8, b"b", 1), (50, 52, 8, b"b", 1)]


def test_tags(spark):
    found = spark.createDataFrame([(bytes([7, 200, 3, 250, 9]),), (bytes([255] * 4),)], "d binary").select(ngram_join._tag("d").alias("t"), "d").collect()
    assert all(r["t"] == ngram_join.tag(bytes(r["d"])) for r in found)


def test_bitmap_bounds_difference():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 2**63, rng.integers(1, 400), dtype=np.uint64)
        b = np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, rng.integers(1, 900), dtype=np.uint64)])
        assert ngram_join.differ(ngram_join.bitmap(a), ngram_join.bitmap(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_divide_skip_matches_counts():
    rng = np.random.default_rng(1)
    for _ in range(100):
        query = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        sets = [np.unique(np.where(rng.random(len(query)) < 0.9, query, rng.integers(60, 99, len(query)).astype(np.uint64))) for _ in range(9)]
        lists = [np.array([j for j, s in enumerate(sets) if q in s]) for q in query]
        got = ngram_join.divide_skip(query, [x for x in lists if len(x)], np.array([len(s) for s in sets]))
        want = [100 * len(np.intersect1d(query, s)) >= 75 * len(np.union1d(query, s)) for s in sets]
        assert got.tolist() == want


def test_shingles_of_values_stay_apart():
    h, n = ngram_join.shingles(pa.array(["a b c d e", None, "f", "a b c d e f"]))
    assert n.tolist() == [1, 0, 1, 2] and h[0] in h[2:]
