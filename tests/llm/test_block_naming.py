"""Exact duplicates against a plain grouping of the texts."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from evgraph.llm import block_naming

LOW = {c: c + 32 for c in range(65, 91)}
TEXTS = ["", None, "a", "A", "ab", "ba", "abab", "abab", "ABAB", "ababa", "aaaa", "aaaaaaaa", "Äb", "äb", "ÄB", "É" * 700, "é" * 700, "x" * 5000, "X" * 5000, "x" * 4999 + "y", "İ", "i̇", " a", "a "]


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOW)].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        kept = [False] * len(ids)
        kept[ids.index(best)] = True
        out += [(i, best, len(ids), k, hashlib.sha256(text.encode()).hexdigest()) for i, k in zip(ids, kept, strict=True)]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, "name", 1, 2) for i, t in rows], "doc_id long, text string, name string, row int, level int").repartition(3)
    return sorted((tuple(r) for r in block_naming.exact(frame, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("size", [1, 3, 2048])
def test_equals_grouping(spark, size):
    rows = [(3 * i % 31, t) for i, t in enumerate(TEXTS if size > 1 else [t for t in TEXTS if t is None or len(t) < 20])]
    rows += [(5, "abab"), (5, "abab"), (None, "abab"), (None, "alone"), (None, "alone")]
    assert found(spark, rows, size=size) == plain(rows)


def test_blocks_of_equal_hashes_are_told_apart(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t is None or len(t) < 20]
    weak = lambda b: (F.xxhash64(b) % 2, F.lit(0).cast("long"))
    assert found(spark, rows, size=2, key=weak) == plain(rows)


def test_random_texts_of_a_small_alphabet(spark):
    import random

    dice = random.Random(11)
    rows = [(i, "".join(dice.choice("abA") for _ in range(dice.randrange(9)))) for i in range(300)]
    assert found(spark, rows, size=2) == plain(rows)


def test_no_rows(spark):
    assert found(spark, []) == []


def test_no_python(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string").select("doc_id", "text")
    plan = block_naming.exact(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
