"""Base scores against plain counts, scores against a plain suffix tree, and that distributions sum to one."""

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from evgraph.llm import queries
from evgraph.llm import suffix_tree_lm as lm
from evgraph.llm.common import Scratch

END = "\0end"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + [END]


def base_expected(docs, train):
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    return {d: (len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) for d, t in docs}


def plain_tree(docs, train, least, bits, depth=2):
    """The same model with dictionaries of words."""
    texts = [words(t) for t in train]
    c1 = Counter(w for t in texts for w in t)
    n, v = sum(c1.values()), len(c1)
    limit, follow = least, max(1, least // lm.FOLLOW)
    root = lambda w: (c1[w] + 1) / (n + v + 1)
    levels = []

    def p(ctx, w, top):
        for k in range(min(top, len(ctx)), 0, -1):
            s = tuple(ctx[-k:])
            if s in levels[k - 1]:
                stored, left = levels[k - 1][s]
                return stored[w] if w in stored else left * p(ctx, w, k - 1)
        return root(w)

    seen = {(w,): c for w, c in c1.items() if c >= limit and w != END}
    for k in range(1, depth + 1):
        after = {}
        for t in texts:
            for i in range(k, len(t)):
                s = tuple(t[i - k : i])
                if s in seen:
                    after.setdefault(s, Counter())[t[i]] += 1
        level = {}
        for s, c in after.items():
            c = {w: m for w, m in c.items() if m >= follow}
            if not c:
                continue
            total = seen[s]
            left = max(1 - sum(m - lm.DISCOUNT for m in c.values()) / total, 1e-12)
            lower = {w: p(s[1:], w, k - 1) for w in c}
            stored = {w: (m - lm.DISCOUNT) / total + left * lower[w] for w, m in c.items()}
            gain = sum(m * math.log2(stored[w] / lower[w]) for w, m in c.items()) + (total - sum(c.values())) * math.log2(left)
            if gain > bits * (1 + len(c)):
                level[s] = (stored, left)
        levels.append(level)
        seen = {(*s, w): m for s, c in after.items() for w, m in c.items() if m >= limit and m >= follow and w != END and (*s[1:], w) in level}
    out = {}
    for d, t in docs:
        t = words(t)
        out[d] = sum(math.log10(p(t[max(0, i - depth) : i], w, depth)) for i, w in enumerate(t))
    return out, levels


@pytest.fixture(scope="module")
def made():
    rng = random.Random(1)
    vocabulary, weights = [f"w{i}" for i in range(60)], [1 / (i + 1) for i in range(60)]
    passage = "the quick brown fox jumps over the lazy dog again and again".split()
    texts = []
    for _ in range(150):
        t = rng.choices(vocabulary, weights, k=rng.randrange(5, 40))
        if rng.random() < 0.4:
            t += passage
        texts.append(" ".join(t + [f"rare{rng.randrange(400)}"]))
    return list(enumerate(texts))


@pytest.mark.parametrize("head", [lm.HEAD, 20, 0])
def test_against_plain_tree(spark, made, head):
    train, rest = [t for d, t in made if d % 7], [None, "", "W1 never seen", "The QUICK brown fox"]
    docs = made + [(1000 + i, t) for i, t in enumerate(rest)]
    scratch = Scratch(spark, "test")
    frame = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, score string").drop("score")
    learned = lm.learn(frame.filter("doc_id < 1000 AND doc_id % 7 <> 0"), scratch, least=8, bits=2.0, head=head, heavy=head)
    got = {r["doc_id"]: r for r in lm.score(frame, *learned, scratch).collect()}
    want, levels = plain_tree(docs, train, 8, 2.0)
    assert all(levels) and [len(x[0]) for x in learned[0].levels] == [len(x) for x in levels]
    for d, (n, known, total, base) in base_expected(docs, train).items():
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(want[d], rel=1e-9)


def test_distributions_sum_to_one(made):
    train = [t for _, t in made]
    _, levels = plain_tree([], train, 8, 2.0)
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    root = {w: (c[w] + 1) / (n + v + 1) for w in c}
    assert sum(root.values()) + 1 / (n + v + 1) == pytest.approx(1)
    for s, (stored, left) in levels[0].items():
        assert sum(stored.values()) + left * (1 - sum(root[w] for w in stored)) == pytest.approx(1)


def test_query(spark):
    real = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in real.doc_id}
    docs = list(zip(real.doc_id, real.text))
    got = queries.queries()["op10_suffix_tree_lm"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    want = base_expected(docs, [t for d, t in docs if not held[d]])
    assert len(got) == len(real)
    for d, (n, known, total, base) in want.items():
        r = got.loc[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], n, known, total) and r.base_score == pytest.approx(base, rel=1e-9)
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()


def test_empty_and_repeated(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    scratch = Scratch(spark, "test")
    assert [r["n_known"] for r in lm.score(frame, *lm.learn(frame.limit(0), scratch), scratch).collect()] == [0, 0, 0]
    scratch = Scratch(spark, "test")
    got = lm.score(frame, *lm.learn(frame, scratch), scratch).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == [(1, 3, 3, 7), (1, 3, 3, 7), (2, 1, 1, 7)]
    assert lm.score(frame.limit(0), *lm.learn(frame, Scratch(spark, "test")), Scratch(spark, "test")).count() == 0


def test_contexts_of_any_length(spark, made):
    """Runs of one word whose length tells what follows, so that each further word of context tells something."""
    rng = random.Random(2)
    train = [t for _, t in made[:80]]
    for i in range(400):
        size = rng.choice([2, 3, 5, 7])
        train.append(" ".join(["go", *["a"] * size, f"last{size}", f"rare{i}"]))
    for i in range(240):  # what follows is told by the word before all others alone: no context between them gains anything
        train.append(" ".join([f"first{i % 2}", "mid0", "mid1", "mid2", f"end{i % 2}", f"rare{i}"]))
    docs = list(enumerate(train)) + [(1000, None), (1001, "go a a a a last7"), (1002, "go a a a a a last5"), (1003, "first1 mid0 mid1 mid2 end0")]
    frame, scratch = spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark, "test")
    learned = lm.learn(frame.filter("doc_id < 1000"), scratch, least=8, bits=2.0)
    want, levels = plain_tree(docs, train, 8, 2.0, depth=12)
    while not levels[-1]:
        levels.pop()
    assert len(levels) >= 6 and [len(x[0]) for x in learned[0].levels] == [len(x) for x in levels]
    for level in levels:  # a state's probabilities of its stored successors and what is left to others are a whole
        assert all(0 < left <= 1 and sum(stored.values()) < 1 + 1e-9 for stored, left in level.values())
    for r in lm.score(frame, *learned, scratch).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-9)
    # fewer words of context on request
    learned = lm.learn(frame.filter("doc_id < 1000"), scratch, depth=5, least=8, bits=2.0)
    want, levels = plain_tree(docs, train, 8, 2.0, depth=5)
    assert [len(x[0]) for x in learned[0].levels] == [len(x) for x in levels]
    for r in lm.score(frame, *learned, scratch).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-9)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 5, "x", 7, "k"), (None, "a", 6, None, 8, "l")], "doc_id long, text string, n_tokens long, row string, N_Known long, kept_0 string")
    scratch = Scratch(spark, "test")
    got = lm.score(frame, *lm.learn(frame, scratch), scratch)
    assert got.columns == ["doc_id", "row", "kept_0", *lm.RESULTS]
    assert sorted((r["doc_id"] or 0, r["row"], r["kept_0"], r["n_tokens"], r["n_known"]) for r in got.collect()) == [(0, None, "l", 2, 2), (1, "x", "k", 3, 3)]


def test_limits_do_not_rise_with_the_corpus(spark):
    few = spark.createDataFrame([(i, "q r") for i in range(4)], "doc_id long, text string")
    found = []
    for rows in (10, 4500):  # 4.5 million tokens more
        docs = few.unionByName(spark.range(100, 100 + rows).selectExpr("id AS doc_id", "repeat('a ', 1000) AS text"))
        scratch = Scratch(spark, "test")
        tree, words, limit = lm.learn(docs, scratch, least=4, bits=2.0)
        r = lm.score(few.limit(1), tree, words, limit, scratch).first()
        assert r["score"] > r["base_score"] + 3
        found.append([len(x[0]) for x in tree.levels])
    assert found[0] == found[1] and found[0][0] == 3


def test_tokens():
    h, n = lm.tokens(pa.array(["a b", None, "A"]))
    assert n.tolist() == [3, 1, 2] and h[0] == h[4] and (h[[2, 3, 5]] == lm.END).all() and np.unique(h).size == 3


def test_scoring_keeps_words_and_weights_alone(spark, made):
    frame, scratch = spark.createDataFrame(made, "doc_id long, text string"), Scratch(spark, "test")
    tree, words, limit = lm.learn(frame, scratch, least=8, bits=2.0, head=20, heavy=20)
    assert {p.name for p in Path(scratch.root.removeprefix("file:").replace("//", "/")).iterdir()} == {"words", "weights"}
    assert len(tree.levels) > 1 and all(weights.count() >= len(states) > 0 for states, weights in tree.levels)
    assert lm.score(frame, tree, words, limit, scratch).count() == len(made)


@pytest.mark.parametrize("spread, states, words, heavy", [(4, 300, 900, 3), (1, 800, 2000, 0), (188, 0, 0, 2)])
def test_packed_tuples(spread, states, words, heavy):
    """Tuples come back as they were; a state that isn't heavy is in one bucket, however many there are."""
    rng = np.random.default_rng(3)
    s, t = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (800, 2000))
    made = np.unique(np.stack([s[np.minimum(rng.zipf(1.3, 20000), 800) - 1], t[np.minimum(rng.zipf(1.3, 20000), 2000) - 1]], 1), axis=0)
    arrays, n = [made[:, 0].copy(), made[:, 1].copy()], rng.integers(1, 1 << 20, len(made))
    form = lm.Packed(spread, (s[:states], t[:words], s[:heavy]))
    order = np.argsort(form.order(arrays))
    batch = form.pack([x[order] for x in arrays], n[order])
    got, buckets = [], {}
    for bucket, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        (a, b), m = form.unpack(blobs)
        got += zip(a.tolist(), b.tolist(), m.tolist(), strict=True)
        for x in set(a.tolist()):
            buckets.setdefault(x, set()).add(bucket)
    assert sorted(got) == sorted(zip(arrays[0].tolist(), arrays[1].tolist(), n.tolist(), strict=True))
    assert {x for x, of in buckets.items() if len(of) > 1} <= set(s[:heavy].tolist())
    assert spread == 1 or not heavy or len(buckets[int(s[0])]) > 1


def test_known_states_cost_less_than_their_hashes():
    s, t = (np.random.default_rng(4).integers(0, 1 << 64, n, dtype=np.uint64) for n in (20000, 500))
    none, size = np.zeros(0, np.uint64), []
    for states in (none, s):
        form = lm.Packed(1, (states, t, none))
        arrays = [s, t[np.arange(len(s)) % len(t)]]
        order = np.argsort(form.order(arrays))
        size.append(sum(len(x) for c in form.pack([x[order] for x in arrays], np.ones(len(s), np.int64)).columns[1:] for x in c.to_pylist()))
    assert size[1] < size[0] - 6 * len(s)


def test_what_was_sent_to_all_tasks_is_dropped(spark, made):
    """Each executor has a copy on its disk."""
    place, scratch = Path(spark.sparkContext._temp_dir), Scratch(spark, "test")
    before = set(place.iterdir())
    frame = spark.createDataFrame(made, "doc_id long, text string")
    got = lm.score(frame, *lm.learn(frame, scratch, least=8, bits=2.0, head=20, heavy=20), scratch)
    assert {p for p in set(place.iterdir()) - before if p.stat().st_size} == set()
    assert got.count() == len(made)


def test_places_of_keys():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 5000):
        keys = np.unique(np.concatenate([rng.integers(0, 1 << 64, n, dtype=np.uint64), np.arange(min(n, 50), dtype=np.uint64)]))
        asked = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 1000, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        places = {k: i for i, k in enumerate(keys.tolist())}
        assert lm.Table(keys).find(asked).tolist() == [places.get(k, -1) for k in asked.tolist()]
