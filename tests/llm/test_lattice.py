"""The lattice decoder against its definition, and links against brute force."""

import numpy as np
import pandas as pd
import pytest

from evgraph.llm import lattice, queries


def test_decoder_finds_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 8)) * 3
    p = lattice.decode(x)
    halves = p & 1
    assert (halves.min(axis=1) == halves.max(axis=1)).all() and (p.sum(axis=1) % 4 == 0).all()  # all whole or all half, even sum
    own = ((x - p / 2) ** 2).sum(axis=1)
    assert own.max() <= 1 + 1e-9  # the covering radius
    for v in lattice.neighbours():
        assert (own <= ((x - (p + v) / 2) ** 2).sum(axis=1) + 1e-9).all()
    assert len(lattice.neighbours()) == 240 and ((lattice.neighbours() ** 2).sum(axis=1) == 8).all()


def pairs_at(cos, n=2000, dims=64, seed=0):
    rng = np.random.default_rng(seed)
    u = rng.standard_normal((n, dims))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((n, dims))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    return u, cos * u + np.sqrt(1 - cos**2) * w


@pytest.mark.parametrize(("cos", "least"), [(0.95, 0.99), (0.97, 0.999), (0.99, 1.0)])
def test_recall_of_cells(cos, least):
    u, v = pairs_at(cos)
    hit = np.zeros(len(u), bool)
    for t in range(lattice.TABLES):
        a, b = (lattice.cells(x, t, lattice.BLOCKS, lattice.SCALE, lattice.PROBES) for x in (u, v))
        hit |= (a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)
    assert hit.mean() >= least


def brute(ids, raw):
    ok = [i for i, r in enumerate(raw) if r is not None and len(r) and all(x is not None and np.isfinite(x) for x in r) and any(r)]
    links = {i: 0 for i in ids}
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for size in {len(raw[i]) for i in ok}:
        at = [i for i in ok if len(raw[i]) == size]
        x = np.array([raw[i] for i in at], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        hit = x @ x.T >= 0.95
        np.fill_diagonal(hit, False)
        for i, row in zip(at, hit):
            links[ids[i]] = int(row.sum())
            for j in np.flatnonzero(row):
                a, b = find(ids[i]), find(ids[at[j]])
                top[max(a, b)] = min(a, b)
    return {i: (links[i], find(i)) for i in ids}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_real_rows(spark):
    real = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = queries.queries()["op1_lattice"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = brute(list(real.vec_id), [list(x) for x in real.embedding])
    assert result(got) == want
    assert {r["vec_id"]: r["kept"] for r in got.collect()} == {i: i == c for i, (_, c) in want.items()}


@pytest.mark.parametrize("chunk", [5, 256])
def test_groups_of_copies(spark, chunk):
    """Exact copies, tight groups, and wide groups whose pairs lie on both sides of the threshold."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal((4, 16))
    rows = [base[0]] * 40 + [3.0 * base[0]] * 5
    rows += [base[1] + rng.standard_normal(16) * 0.05 for _ in range(40)]
    rows += [base[2] + rng.standard_normal(16) * 0.22 for _ in range(60)]
    rows += list(rng.standard_normal((40, 16)))
    raw = [list(map(float, r)) for r in rows]
    ids = [int(x) for x in rng.permutation(len(raw)) * 3]
    got = result(lattice.near_duplicates(spark.createDataFrame(list(zip(ids, raw)), "vec_id long, embedding array<double>"), chunk=chunk))
    want = brute(ids, raw)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in ids) and found >= 0.99 * there


def test_odd_rows(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0, 1.0]), (8, [2.0, 2.0]), (9, [1.0, 1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (10, [1e300, 1e300])]
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, embedding array<double>, n_links int, unit string")
    got = sorted(map(tuple, lattice.near_duplicates(frame).collect()), key=str)
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 9)] + [(7, 2, 7, True), (8, 2, 7, False), (10, 2, 7, False), (None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert lattice.near_duplicates(frame.limit(0)).count() == 0
