"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected at random on a few blocks of eight dimensions, in several tables; each block is decoded to the nearest
point of the E8 lattice, and a table's cell is its blocks' points. A vector is stored in its own cell of each table and looks
into that cell and the neighbouring ones nearest to it. Whatever meets in a cell is verified by cosine in double precision, so
no link below the threshold is reported; what the cells miss is measured against brute force (see the tests: recall above 0.99).

Dense groups don't give all their pairs. Vectors of one cell of a further table that lie within half the threshold's angle of
their mean form a ball: all of them are linked. From then on balls stand for their members. Two balls whose centres and radii
say so are linked whole or not at all; only where neither holds are their members compared, in blocks that count links.

Null vectors, vectors with null or non-finite components and those of zero length link with nothing; vectors of different
length of array don't link with each other. Rows that share a vec_id are one vector (the first by its bytes if they differ),
and each row gets its result; a row without vec_id links with nothing and has no component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import Scratch, mix, partitions

THRESHOLD = 0.95
#: Tables, blocks of a table, the lattice's scale against unit vectors, and cells that a vector looks into.
TABLES, BLOCKS, SCALE, PROBES = 8, 2, 0.6, 12
#: Members of a block when two balls are compared by members.
CHUNK = 256


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of rows of eight, doubled so that they are whole numbers."""

    def d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
        if len(odd):  # move the coordinate that is farthest from its whole number to the next one
            off = y[odd] - near[odd]
            at = np.abs(off).argmax(axis=1)
            near[odd, at] += np.where(off[np.arange(len(odd)), at] >= 0, 1.0, -1.0)
        return near

    a, b = d8(x), d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], a, b)).astype(np.int64)


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: two whole units, or eight halves with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in product((1, -1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out, np.int64)


@lru_cache(maxsize=8)
def projection(dims: int, table: int, blocks: int) -> np.ndarray:
    """[blocks, dims, 8]: orthonormal directions where there are enough dimensions, scaled to keep lengths on average."""
    rng = np.random.default_rng([20240311, dims, table])
    g = rng.standard_normal((max(dims, 8 * blocks), 8 * blocks))
    q = np.linalg.qr(g)[0][:dims]
    return (q * np.sqrt(dims / 8)).reshape(dims, blocks, 8).transpose(1, 0, 2)


def _key(points: np.ndarray, seed: int) -> np.ndarray:
    """A hash of rows of whole numbers."""
    h = np.full(len(points), seed, np.uint64)
    for k in range(points.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + points[:, k].astype(np.uint64), 29)
    return h


def cells(units: np.ndarray, table: int, blocks: int, scale: float, probes: int) -> np.ndarray:
    """[vectors, probes]: hashes of a vector's own cell (first) and the nearest neighbouring ones."""
    dims = units.shape[1]
    seed = dims * 1000 + table
    points, reach, steps = [], [], neighbours()
    for p in projection(dims, table, blocks):
        x = units @ p / scale
        point = decode(x)
        # squared distance to a neighbouring point, beyond that to the own one: 2 - 2 (offset . step)
        far = 2.0 - (x - point / 2.0) @ steps.T
        near = np.argsort(far, axis=1)[:, :probes]
        points.append(np.concatenate([point[:, None], point[:, None] + steps[near]], axis=1))
        reach.append(np.concatenate([np.zeros((len(x), 1)), np.take_along_axis(far, near, axis=1)], axis=1))
    # the nearest combinations over all blocks
    held = [_key(points[0].reshape(-1, 8), seed).reshape(points[0].shape[:2])]
    total = reach[0]
    for b in range(1, blocks):
        own = _key(points[b].reshape(-1, 8), seed + 500_000 + b).reshape(points[b].shape[:2])
        both = (total[:, :, None] + reach[b][:, None, :]).reshape(len(units), -1)
        keys = mix(held[-1][:, :, None] * np.uint64(3) + own[:, None, :]).reshape(len(units), -1)
        near = np.argsort(both, axis=1, kind="stable")[:, :probes]
        total, _ = np.take_along_axis(both, near, axis=1), held.append(np.take_along_axis(keys, near, axis=1))
    return held[-1][:, :probes]


def unit(values) -> bytes | None:
    """A vector of length one in double precision as bytes, or none."""
    if values is None or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    if not len(x) or not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    x = x / top
    return (x / np.sqrt(x @ x)).tobytes()


def _stack(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of each dimension, with their places."""
    size = np.array([len(r) for r in raw], np.int64)
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        yield at, np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)


def _batch(cols: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols.values()], names=list(cols))


def _units(embeddings: DataFrame, column: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch({"vec_id": (batch.column("vec_id"), pa.int64()), "unit": ([unit(v) for v in batch.column(column).to_pylist()], pa.binary())})

    return embeddings.select(F.col("vec_id").cast("long"), F.col(column)).filter("vec_id IS NOT NULL").mapInArrow(run, "vec_id bigint, unit binary").filter("unit IS NOT NULL").groupBy("vec_id").agg(F.min("unit").alias("unit"))


def _celled(vectors: DataFrame, scale: float, blocks: int) -> DataFrame:
    """Adds the cell of a table of its own, by which balls are formed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, out = batch.column("unit").to_pylist(), np.zeros(batch.num_rows, np.uint64)
            for at, x in _stack(raw):
                out[at] = cells(x, 999, blocks, scale, 1)[:, 0]
            yield _batch({"vec_id": (batch.column("vec_id"), pa.int64()), "unit": (batch.column("unit"), pa.binary()), "cell": (out.view(np.int64), pa.int64())})

    return vectors.mapInArrow(run, "vec_id bigint, unit binary, cell bigint")


def _centres(vectors: DataFrame) -> DataFrame:
    """Directions of the sums of cells of two or more vectors; sums are made in each task before they meet."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, raw = batch.column("cell").to_numpy(), batch.column("unit").to_pylist()
            for at, x in _stack(raw):
                keys, back, n = np.unique(cell[at], return_inverse=True, return_counts=True)
                sums = np.zeros((len(keys), x.shape[1]))
                np.add.at(sums, back, x)
                yield _batch({"cell": (keys, pa.int64()), "n": (n, pa.int64()), "sum": ([s.tobytes() for s in sums], pa.binary())})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, n, held = None, 0, None

        def settle() -> Iterator[pa.RecordBatch]:
            if n > 1 and (size := np.sqrt(held @ held)) > 0:
                yield _batch({"cell": ([cell], pa.int64()), "centre": ([(held / size).tobytes()], pa.binary())})

        for batch in batches:
            for c, k, raw in zip(*(batch.column(x).to_pylist() for x in ("cell", "n", "sum")), strict=True):
                if c != cell:
                    yield from settle()
                    cell, n, held = c, 0, np.zeros(len(raw) // 8)
                n, held = n + k, held + np.frombuffer(raw, np.float64)
        yield from settle()

    sums = vectors.mapInArrow(part, "cell bigint, n bigint, sum binary")
    return sums.repartition(partitions(vectors.sparkSession), "cell").sortWithinPartitions("cell").mapInArrow(total, "cell bigint, centre binary")


def _angles(frame: DataFrame, threshold: float) -> DataFrame:
    """Adds a vector's angle to its cell's centre, null where it is too wide for a ball."""
    most = np.arccos(threshold) / 2 - 1e-7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit_, centre, out = batch.column("unit").to_pylist(), batch.column("centre").to_pylist(), []
            for u, c in zip(unit_, centre, strict=True):
                a = float(np.arccos(np.clip(np.frombuffer(u) @ np.frombuffer(c), -1, 1))) if c is not None else None
                out.append(a if a is not None and a <= most else None)
            yield _batch({"vec_id": (batch.column("vec_id"), pa.int64()), "unit": (batch.column("unit"), pa.binary()), "cell": (batch.column("cell"), pa.int64()), "centre": (centre, pa.binary()), "angle": (out, pa.float64())})

    return frame.select("vec_id", "unit", "cell", "centre").mapInArrow(run, "vec_id bigint, unit binary, cell bigint, centre binary, angle double")


def _hashed(members: DataFrame, tables: int, blocks: int, scale: float, probes: int) -> DataFrame:
    """(cell, ball, own): the cells that a ball's members stand in (own) or look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball, raw = batch.column("ball").to_numpy(), batch.column("unit").to_pylist()
            for at, x in _stack(raw):
                for t in range(tables):
                    keys = cells(x, t, blocks, scale, probes)
                    flat = np.stack([keys.reshape(-1).view(np.int64), np.repeat(ball[at], keys.shape[1])])
                    own = np.tile(np.arange(keys.shape[1]) == 0, len(at))
                    _, first = np.unique(np.concatenate([flat, own[None]]), axis=1, return_index=True)
                    yield _batch({"cell": (flat[0, first], pa.int64()), "ball": (flat[1, first], pa.int64()), "own": (own[first], pa.bool_())})

    return members.mapInArrow(run, "cell bigint, ball bigint, own boolean")


def _judged(pairs: DataFrame, balls: DataFrame, threshold: float) -> DataFrame:
    """Pairs of balls that are linked whole (`whole`), or whose members have to be compared."""
    limit = np.arccos(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            keep, whole = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
            size = np.array([len(a) if len(a) == len(b) else 0 for a, b in zip(c["ua"], c["ub"], strict=True)])
            for s in np.unique(size[size > 0]):
                at = np.flatnonzero(size == s)
                a, b = (np.frombuffer(b"".join(c[k][i] for i in at)).reshape(len(at), -1) for k in ("ua", "ub"))
                dot = np.einsum("ij,ij->i", a, b)
                ra, rb = (np.array([c[k][i] for i in at]) for k in ("ra", "rb"))
                angle, reach = np.arccos(np.clip(dot, -1, 1)), ra + rb
                single = reach == 0
                whole[at] = np.where(single, dot >= threshold, angle + reach <= limit - 1e-7)
                keep[at] = np.where(single, dot >= threshold, angle - reach <= limit + 1e-7)
            yield _batch({"a": (np.array(c["a"], np.int64)[keep], pa.int64()), "b": (np.array(c["b"], np.int64)[keep], pa.int64()), "whole": (whole[keep], pa.bool_())})

    of = lambda x: balls.select(F.col("ball").alias(x), F.col("centre").alias(f"u{x}"), F.col("radius").alias(f"r{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "ua", "ub", "ra", "rb").mapInArrow(run, "a bigint, b bigint, whole boolean")


def _compared(partial: DataFrame, members: DataFrame, balls: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """Links between members of two balls, block by block: (vec_id, n, a, b), n being a vector's links in the other ball."""
    size = balls.select("ball", F.ceil(F.col("size") / chunk).cast("int").alias("parts"))
    both = partial.join(size.withColumnsRenamed({"ball": "a", "parts": "pa"}), "a").join(size.withColumnsRenamed({"ball": "b", "parts": "pb"}), "b")
    own = F.pmod(F.xxhash64("vec_id"), F.col("mine")).cast("int")

    def side(x: str, other: str, role: int) -> DataFrame:
        rows = both.join(members.select(F.col("ball").alias(x), "vec_id", "unit"), x).withColumn("mine", F.col(f"p{x}"))
        dealt = rows.withColumn("i", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col(f"p{other}") - 1)))
        i, j = ("i", "j") if role == 0 else ("j", "i")
        return dealt.select("a", "b", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(role).alias("role"), "vec_id", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [])

        def settle() -> Iterator[pa.RecordBatch]:
            (ia, ua), (ib, ub) = (list(zip(*h, strict=True)) if h else ((), ()) for h in held)
            if ia and ib:
                x, y = (np.frombuffer(b"".join(u)).reshape(len(u), -1) for u in (ua, ub))
                hit = x @ y.T >= threshold
                ids, n = np.array(ia + ib, np.int64), np.concatenate([hit.sum(axis=1), hit.sum(axis=0)])
                ids, n = ids[n > 0], n[n > 0]
                yield _batch({"vec_id": (ids, pa.int64()), "n": (n, pa.int64()), "a": (np.full(len(ids), key[0]), pa.int64()), "b": (np.full(len(ids), key[1]), pa.int64())})

        for batch in batches:
            for a, b, i, j, role, vec, u in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "i", "j", "role", "vec_id", "unit")), strict=True):
                if (a, b, i, j) != key:
                    yield from settle()
                    key, held = (a, b, i, j), ([], [])
                held[role].append((vec, u))
        yield from settle()

    rows = side("a", "b", 0).unionByName(side("b", "a", 1))
    return rows.repartition(partitions(partial.sparkSession), "a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j", "role").mapInArrow(run, "vec_id bigint, n bigint, a bigint, b bigint")


def near_duplicates(
    embeddings: DataFrame, column: str = "embedding", threshold: float = THRESHOLD, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE, probes: int = PROBES, chunk: int = CHUNK, scratch: Scratch | None = None
) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    scratch = scratch or Scratch(embeddings.sparkSession, "lattice")
    vectors = scratch.write(_celled(_units(embeddings, column), scale, blocks), "vectors")
    near = scratch.write(_angles(vectors.join(_centres(vectors), "cell", "left"), threshold), "angles")
    tight = near.filter("angle IS NOT NULL").groupBy("cell").agg(F.min("vec_id").alias("ball"), F.count("*").alias("size"), F.max("angle").alias("radius")).filter("size > 1")
    members = near.join(tight.select("cell", F.col("ball").alias("of")), "cell", "left").select("vec_id", "unit", "centre", "cell", F.when(F.col("angle").isNotNull() & F.col("of").isNotNull(), F.col("of")).otherwise(F.col("vec_id")).alias("ball"), (F.col("angle").isNotNull() & F.col("of").isNotNull()).alias("in_ball"))
    members = scratch.write(members, "members")
    single = members.filter("NOT in_ball").select("ball", F.col("unit").alias("centre"), F.lit(1).cast("long").alias("size"), F.lit(0.0).alias("radius"))
    multiple = members.filter("in_ball").groupBy("ball").agg(F.first("centre").alias("centre"), F.first("cell").alias("cell")).join(tight.drop("ball"), "cell").select("ball", "centre", "size", (F.col("radius") + 1e-9).alias("radius"))
    balls = scratch.write(single.unionByName(multiple), "balls")

    hashed = scratch.write(_hashed(members, tables, blocks, scale, probes).distinct(), "hashed")
    met = hashed.filter("own").select("cell", F.col("ball").alias("x")).join(hashed.select("cell", F.col("ball").alias("y")), "cell").filter("x <> y")
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    judged = scratch.write(_judged(pairs, balls, threshold), "judged")
    compared = scratch.write(_compared(judged.filter("NOT whole"), members, balls, threshold, chunk), "compared")

    whole = judged.filter("whole")
    size = balls.select("ball", "size")
    reach = whole.select("a", "b").unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(size.withColumnRenamed("ball", "b"), "b").groupBy(F.col("a").alias("ball")).agg(F.sum("size").alias("others"))
    exact = compared.groupBy("vec_id").agg(F.sum("n").alias("more"))
    groups = components(whole.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(compared.select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct(), scratch)
    found = members.select("vec_id", "ball").join(size, "ball").join(reach, "ball", "left").join(groups.withColumnRenamed("id", "ball"), "ball", "left").join(exact, "vec_id", "left")
    zero = F.lit(0)
    found = found.select("vec_id", (F.col("size") - 1 + F.coalesce("others", zero) + F.coalesce("more", zero)).alias("n_links"), F.coalesce("component", "ball").alias("component_id"))
    out = embeddings.select(F.col("vec_id").cast("long")).join(found, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", zero).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
