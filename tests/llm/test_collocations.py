"""Collocations against a plain count of all n-grams."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from evgraph.llm import collocations

LOW = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, max_words=5, most=2000):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            f.update((lang, *w[i : i + n]) for n in range(1, max_words + 1) for i in range(len(w) - n + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = {}
    for g, a in candidates.items():
        lang, w = g[0], g[1:]
        if any(h[0] == lang and len(h) > len(g) and b >= a and any(h[i : i + len(w)] == w for i in range(1, len(h))) for h, b in candidates.items()):
            continue
        cuts = [((1000 * a * total[lang]) // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1))


def found(spark, rows, least, **options):
    frame = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n int, phrase string").repartition(3)
    got = collocations.collocations(frame, least=least, **options)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n):
    dice = random.Random(seed)
    words = ["the", "The", "of", "été", "É", "日本", "w1", "a-b", "x y", "--", "new", "york", "city", "New York", "New York City Hall of"]
    return [("".join(dice.choice(words) + dice.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \r ", "\x0b"]) for _ in range(dice.choice([0, 1, 3, 40]))), dice.choice(["en", "fr", "", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("run", [64, 1 << 22])
def test_equals_plain_count(spark, monkeypatch, run):
    monkeypatch.setattr(collocations, "RUN", run)
    rows = corpus(1, 250) + [(None, "en"), (None, None), ("", "en"), ("again and again and again " * 400, "en"), ("aa aa aa aa", "fr"), ("aa aa aa aa", "fr")]
    assert found(spark, rows, 5) == plain(rows, 5)


def test_limits(spark):
    rows = corpus(2, 120)
    assert found(spark, rows, 3, max_words=3, most=4) == plain(rows, 3, 3, 4)
    assert found(spark, rows, 3, max_words=2) == plain(rows, 3, 2)


def test_nothing(spark):
    assert found(spark, [], 1) == [] and found(spark, [(None, None), ("alone.", "en")], 1) == []


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([("a b", "en")], "text string, lang string")
    wide = frame.selectExpr("(CAST(1000 AS DECIMAL(4,0)) * CAST(CAST(900000000000000000 AS DECIMAL(18,0)) * CAST(900000000000000 AS DECIMAL(18,0)) AS DECIMAL(34,0))) div (CAST(900000000000000000 AS DECIMAL(18,0)) * CAST(100 AS DECIMAL(18,0))) AS x")
    assert wide.first()["x"] == 1000 * 900000000000000000 * 900000000000000 // (900000000000000000 * 100)


def test_runs_end_between_pieces():
    raw = np.frombuffer(b"ab cd. ef gh, ij kl mn op qr st uv wx yz. a", np.uint8)
    parts = [r.tobytes() for r, _ in collocations._runs(raw, np.array([0, len(raw)]), 8, 4)]
    assert b"".join(parts) == raw.tobytes() and all(p[-1:] in b".," for p in parts[:-1])
