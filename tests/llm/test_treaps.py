"""Ranked search against a plain scoring of all documents."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from evgraph.llm import treaps


def plain(docs, items, first=20):
    bags = [(i, Counter(treaps.terms_of(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in sorted(set(items), key=repr):
        found = []
        for doc_id, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in treaps.terms_of(text) if b[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:first], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, term string").repartition(parts)
    q = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, score int")
    return sorted((tuple(r) for r in treaps.ranked(d, q, **options).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n, words):
    dice = random.Random(seed)
    vocabulary = [w for w in ("the of And a être Ä été 12 x9 naïve 日本 ß".split() + [f"w{i}" for i in range(words)])]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, dice.choice([" ", ", ", "-"]).join(dice.choices(vocabulary, weights, k=dice.choice([0, 1, 5, 30, 200])))) for i in range(n)]


def test_equals_plain_scoring(spark):
    docs = corpus(1, 300, 40)
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, docs[8][1]), (900, None), (901, "-- !"), (902, "the " * 30000)]
    items = [(i, t) for i, t in corpus(2, 25, 45)] + [(50, None), (51, ""), (52, "nowhere"), (53, "the the The w1"), (53, "w2"), (54, "w3"), (54, "w3")]
    assert found(spark, docs, items) == plain(docs, items)


def test_ties_go_to_the_smaller_id_across_tasks(spark):
    docs = [(i, "same words here") for i in range(200)] + [(500, "other"), (501, None)]
    got = found(spark, docs, [(1, "same here")], parts=7)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(20))


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(treaps, "ITEMS", 2)
    docs, items = corpus(3, 60, 10), corpus(4, 7, 10)
    assert found(spark, docs, items, first=3) == plain(docs, items, 3)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_nothing(spark, docs, items):
    assert found(spark, docs, items) == []


@pytest.mark.parametrize("kind", ["random", "rising", "falling", "equal"])
def test_treap_is_a_search_tree_and_a_heap(kind):
    dice = np.random.default_rng(5)
    n = 200
    docs = np.concatenate([np.sort(dice.choice(1000, n, False)) for _ in range(3)])
    impacts = {"random": dice.integers(1, 50, 3 * n), "rising": np.tile(np.arange(1, n + 1), 3), "falling": np.tile(np.arange(n, 0, -1), 3), "equal": np.full(3 * n, 7)}[kind]
    t = treaps.Treaps(4, np.repeat([0, 1, 3], n), docs, impacts)
    assert t.root[2] == 3 * n

    def walk(top):  # in order, without recursion
        out, stack, node = [], [], top
        while stack or node != 3 * n:
            while node != 3 * n:
                for child in (t.left[node], t.right[node]):
                    assert child == 3 * n or t.impact[child] <= t.impact[node]
                stack.append(node)
                node = t.left[node]
            node = stack.pop()
            out.append(int(t.doc[node]))
            node = t.right[node]
        return out

    for k, term in enumerate((0, 1, 3)):
        assert walk(int(t.root[term])) == docs[k * n : (k + 1) * n].tolist()


def test_search_leaves_intervals_that_cannot_reach_the_first():
    dice = np.random.default_rng(6)
    n = 5000
    docs = np.concatenate([np.arange(n), np.sort(dice.choice(n, 50, False))])
    impacts = np.concatenate([dice.integers(1, 100, n), np.full(50, 1000)])
    t = treaps.Treaps(2, np.repeat([0, 1], [n, 50]), docs, impacts)
    best, seen = treaps.search(t, np.array([[0, 1]]), np.array([[1, 1]]), np.arange(n), np.zeros(n, bool), treaps.Best.none(), 0)
    score = np.zeros(n, np.int64)
    np.add.at(score, docs, impacts)
    assert best.doc_id.tolist() == np.lexsort((np.arange(n), -score))[:20].tolist() and seen < n / 3
