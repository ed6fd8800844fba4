"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two shingle sets of sizes n and m are similar (100 * intersection >= 75 * union) exactly if they share at least
T = ceil(75 (n + m) / 175) shingles, so a set's inverted lists need T occurrences of a partner.

1. One scan makes each text's set as sorted 64-bit hashes, and from it small signatures: size, digest, a parity bitmap and a
   few minima. Texts of equal sets become one class (an aggregation on the digest, combined before the shuffle).
2. Classes of a common minimum are held against the bucket's first class alone, which is linear in the bucket: most of a
   large group of near copies becomes one component here, whatever its size.
3. Inverted lists over short prefixes find the remaining partners. Long lists (of shingles that a fixed-size table of counts
   marks as frequent) come last in the order, so a set's prefix holds its short lists; those are merged, and a list whose
   members are all in one component already is dropped. A list of mixed members yields the pairs across components that sizes
   and places allow. Long lists that get into prefixes are dealt in blocks.
4. Candidate pairs pass a parity bitmap, which bounds the symmetric difference from below and never loses a link, and then
   DivideSkip proper: for a query and a block of candidates, short lists are heap-merged until a candidate has occurred
   T - L times, and its L longest lists are probed by binary search.
5. Links of both rounds give the components.

Every step is exact; nothing is capped or sampled. (The frequency table only orders lists: any order gives the same links.)

Null texts and texts without words have an empty set and link with nothing; texts of fewer than five words have one shingle.
Rows that share a doc_id are one document of all their texts' classes: each row keeps its own size, and all have the document's
component. Ties don't arise. A null doc_id gives a row with its size and a null component. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import components
from .common import Scratch, mix, partitions, slices, word_hashes

WORDS, PERCENT = 5, 75
#: Minima for round 2; more find more of a near-copy group before round 3, and links don't depend on it.
MINIMA = 4
#: The table of counts: 4 MB whatever the corpus; a shingle counts as frequent from HEAVY counts on.
COUNTERS, HEAVY = 1 << 20, 96
#: Candidates that go with one query to one task, and members of a block of a long list.
BLOCK = 64
#: A pivot of more than HOT pairs meets them under SALTS keys.
HOT, SALTS = 256, 64


def shingles(col: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all values one after another, and how many each value has."""
    h, n = word_hashes(col)
    if not len(h):
        return h, np.zeros(len(col), np.int64)
    # after the last word of a value its first words must not continue into the next value
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[owner]
    size = np.minimum(n, words)[owner]
    out = size.astype(np.uint64)
    for k in range(words):
        step = mix(out) + h[np.minimum(at + k, len(h) - 1)] * np.uint64(2 * k + 3)
        out = np.where(k < size, step, out)
    out = mix(out, 7)
    stops = np.cumsum(count).tolist()
    for a, b in zip([0, *stops[:-1]], stops, strict=True):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[keep], np.bincount(owner[keep], minlength=len(n))


def least_overlap(n, m, percent: int = PERCENT):
    """T: the fewest common shingles of two similar sets of these sizes."""
    return -((-percent * (n + m)) // (100 + percent))


def least_partner(n, percent: int = PERCENT):
    """The smallest size of a partner of a set of size n."""
    return -((-percent * n) // 100)


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each slot that an odd number of hashes falls in; slots are a power of two near the set's size."""
    bits = 64
    while bits < len(hashes):
        bits *= 2
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def digests(h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Of each set of hashes, one after another, 128 bits that depend on the set alone, and its size."""
    some = np.flatnonzero(n)
    sums = np.zeros((2, len(n)), np.uint64)
    for i in range(2 if len(some) else 0):
        sums[i, some] = np.add.reduceat(mix(h, 11 + i), (np.cumsum(n) - n)[some])
    return [a.tobytes() + b.tobytes() + int(k).to_bytes(4, "little") for a, b, k in zip(*sums, n, strict=True)]


def tag(digest: bytes) -> int:
    """A few bits of a digest; texts of one doc_id are told apart by them first, and by the digest where they are verified."""
    return int.from_bytes(digest[:4], "little", signed=True)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def differ(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their bitmaps; the longer one is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    # slot = low bits of the hash, so slots that agree in the shorter one's bits are whole strides apart
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) if len(x) > len(y) else x
    return int(_ONES[x ^ y].sum())


def signatures(docs: DataFrame, words: int, counters: int) -> DataFrame:
    """A row for each text, and for each task the counts of its shingles by slot (the hash's low bits) in rows with a `part`."""
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "digest": pa.binary(), "bits": pa.binary(), "minima": pa.list_(pa.int64()), "part": pa.int32(), "counts": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                h, n = shingles(batch.column("text"), words)
                total += np.bincount((h & np.uint64(counters - 1)).astype(np.int64), minlength=counters)
                ends = np.cumsum(n)
                some = np.flatnonzero(n)
                minima = np.zeros((len(n), MINIMA), np.uint64)
                if len(some):
                    at = (ends - n)[some]
                    for i in range(MINIMA):
                        minima[some, i] = np.minimum.reduceat(mix(h, 101 + i), at)
                digest = digests(h, n)
                bits = [bitmap(h[e - k : e]) if k else None for e, k in zip(ends, n, strict=True)]
                none = [None] * len(n)
                cols = [batch.column("doc_id"), n, digest, bits, list(minima.view(np.int64)), none, none]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], names=list(kinds))
        for i in range(0, counters, 4096):
            if total[i : i + 4096].any():
                # a task's count may saturate: counts only order lists
                row = [None] * 5 + [i // 4096, np.minimum(total[i : i + 4096], 65_535).astype("<u2").tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds.values(), strict=True)], names=list(kinds))

    return docs.mapInArrow(run, "doc_id bigint, n bigint, digest binary, bits binary, minima array<bigint>, part int, counts binary")


def frequent(counts: DataFrame, counters: int, heavy: int) -> np.ndarray:
    """A fixed-size bit array of the slots that hold frequent shingles, from (part, counts) rows, which are summed by part.

    When slots are full of rare shingles (a large corpus), the limit rises until an eighth of them at most count as frequent.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None

        def settle() -> Iterator[pa.RecordBatch]:
            if part is not None:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"])

        for batch in batches:
            for p, x in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                if p != part:
                    yield from settle()
                    part, total = p, np.zeros(len(x) // 2, np.int64)
                total += np.frombuffer(x, "<u2")
        yield from settle()

    n = partitions(counts.sparkSession)
    rows = counts.repartition(n, "part").sortWithinPartitions("part").mapInArrow(add, "part int, counts binary").collect()  # 8 MB, whatever the corpus
    total = np.zeros(counters, np.int64)
    for r in rows:
        total[r["part"] * 4096 : r["part"] * 4096 + len(r["counts"]) // 8] = np.frombuffer(r["counts"], "<i8")
    base = np.median(total)
    limit = max(heavy + base, np.partition(total, -(counters // 8))[-(counters // 8)])
    return np.packbits(total > limit)


#: Slots of the filter that keeps texts nobody asks for out of a shuffle: 4 MB whatever the corpus.
ASKED = 1 << 25


def only_asked(docs: DataFrame, ids: DataFrame, slots: int = ASKED) -> DataFrame:
    """Documents whose doc_id may be among the ids, by a bit array of fixed size; the join that follows is exact."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(slots, bool)
        for batch in batches:
            bits[(mix(batch.column(0).to_numpy().view(np.uint64), 3) & np.uint64(slots - 1)).astype(np.int64)] = True
        for i in range(0, slots, 1 << 16):
            if (at := np.flatnonzero(bits[i : i + (1 << 16)]).astype("<u2")).size:  # as places while they are few
                said = at.tobytes() if at.size < 4096 else np.packbits(bits[i : i + (1 << 16)]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([i >> 16], pa.int32()), pa.array([said], pa.binary())], names=["part", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, x in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                own = held.setdefault(p, np.zeros(1 << 13, np.uint8))
                if len(x) == 1 << 13:
                    own |= np.frombuffer(x, np.uint8)
                else:
                    at = np.frombuffer(x, "<u2")
                    np.bitwise_or.at(own, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["part", "bits"])

    spark = docs.sparkSession
    table = np.zeros(slots // 8, np.uint8)
    for r in ids.mapInArrow(mark, "part int, bits binary").repartition(partitions(spark), "part").mapInArrow(merge, "part int, bits binary").collect():
        table[r["part"] << 13 : (r["part"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(table)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (mix(batch.column("doc_id").to_numpy().view(np.uint64), 3) & np.uint64(slots - 1)).astype(np.int64)
            yield batch.filter(pa.array((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))

    return docs.mapInArrow(keep, docs.schema)


def postings(docs: DataFrame, words: int, percent: int, often) -> DataFrame:
    """(t, doc_id, tag, n, place) of each set's prefix: shingles in the order (frequent last, hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(often.value)
        mask, met = np.uint64(len(table) - 1), set()
        for whole in batches:
            for batch in slices(whole, "text"):
                h, n = shingles(batch.column("text"), words)
                if len(met) > 200_000:
                    met.clear()
                ends, fresh = np.cumsum(n), []
                for i in np.flatnonzero(n):
                    one = (int(n[i]), xxhash.xxh3_128_digest(h[ends[i] - n[i] : ends[i]]))
                    if one not in met:  # of equal sets that a task meets, one is posted
                        met.add(one)
                        fresh.append(i)
                h = h[np.repeat(np.isin(np.arange(len(n)), fresh), n)]
                batch = batch.take(pa.array(fresh, pa.int64()))
                n = n[fresh]
                tags = np.array([tag(d) for d in digests(h, n)], np.int32)
                owner = np.repeat(np.arange(len(n)), n)
                late = table[(h & mask).astype(np.int64)].astype(bool)
                order = np.argsort(2 * owner + late, kind="stable")  # the hashes of a set are ascending
                h, late = h[order], late[order]
                place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
                # a partner shares T >= least_overlap(n, least partner) shingles, so one of these is common to both
                keep = place < (n - least_overlap(n, least_partner(n, percent), percent) + 1)[owner]
                ids = np.asarray(batch.column("doc_id").to_numpy(zero_copy_only=False), np.int64)[owner[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(ids), pa.array(tags[owner[keep]]), pa.array(n[owner[keep]].astype(np.int32)), pa.array(place[keep].astype(np.int32)), pa.array(late[keep])], names=["t", "doc_id", "tag", "n", "place", "late"])

    return docs.mapInArrow(run, "t bigint, doc_id bigint, tag int, n int, place int, late boolean")


def with_pivots(pairs: DataFrame, classes: DataFrame, block: int, hot: int = HOT, salts: int = SALTS) -> DataFrame:
    """Pairs (u, v) with u's size and bitmap, and in how many blocks its partners are dealt. What a pivot of many pairs has is
    copied under `salts` keys, over which its pairs are spread."""
    pivots = pairs.groupBy("u").agg(F.count("*").alias("k")).join(classes.select(F.col("class").alias("u"), F.col("n").alias("un"), F.col("bits").alias("ubits")), "u")
    pivots = pivots.withColumn("blocks", F.ceil(F.col("k") / block))
    many = pivots.filter(F.col("k") > hot).drop("k").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("v", F.lit(7)), F.lit(salts)).cast("int")).join(many, ["u", "salt"], "left").drop("salt")
    few = dealt.filter("blocks IS NULL").select("u", "v").join(pivots.filter(F.col("k") <= hot).drop("k"), "u")
    return dealt.filter("blocks IS NOT NULL").unionByName(few)


def filtered(pairs: DataFrame, classes: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs (u, v, blocks) whose bitmaps don't rule out a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            keep = [differ(a, b) <= n + m - 2 * least_overlap(n, m, percent) for a, b, n, m in zip(c["ubits"], c["vbits"], c["un"], c["vn"], strict=True)]
            yield batch.select(["u", "v", "blocks"]).filter(pa.array(keep, pa.bool_()))

    b = classes.select(F.col("class").alias("v"), F.col("n").alias("vn"), F.col("bits").alias("vbits"))
    near = with_pivots(pairs, classes, block).join(b, "v").filter((100 * F.least("un", "vn") >= percent * F.greatest("un", "vn")))
    return near.select("u", "v", "blocks", "un", "vn", "ubits", "vbits").mapInArrow(run, "u bigint, v bigint, blocks bigint")


def divide_skip(query: np.ndarray, lists: list[np.ndarray], sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which candidates share T shingles with the query set, by DivideSkip over the candidates' inverted lists.

    lists: of each of the query's shingles that a candidate has, the candidates' numbers, ascending.
    """
    need = least_overlap(len(query), sizes, percent)
    low = int(need.min())
    lists = sorted(lists, key=len)
    n_long = max(0, min(len(lists) - 1, low - 1))  # the L longest lists are probed, the others merged
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    m = len(sizes)
    # the long lists end to end, ascending, so that one call probes all of them by binary search
    flat = np.concatenate([x + i * m for i, x in enumerate(long)]) if long else np.zeros(0, np.int64)
    places = np.arange(n_long) * m
    found = np.zeros(m, bool)
    rest = [x.tolist() for x in short]
    heap = [(x[0], i) for i, x in enumerate(rest)]
    heapq.heapify(heap)
    nexts = [1] * len(rest)
    while heap:
        at, seen = heap[0][0], 0
        while heap and heap[0][0] == at:
            i = heap[0][1]
            seen += 1
            if nexts[i] < len(rest[i]):
                heapq.heapreplace(heap, (rest[i][nexts[i]], i))
                nexts[i] += 1
            else:
                heapq.heappop(heap)
        if seen + n_long >= need[at]:
            if n_long:
                p = np.minimum(flat.searchsorted(places + at), len(flat) - 1)
                seen += int((flat[p] == places + at).sum())
            found[at] = seen >= need[at]
    return found


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, block: int, scratch: Scratch, name: str) -> DataFrame:
    """Those of the pairs (u, v) of classes that are similar. A query u and a block of its candidates meet in one task. The text of
    a class is that of its `rep`; of a document of several texts, the one with the class's digest."""
    spark = scratch.spark
    pairs = scratch.write(pairs, f"{name}-pairs")
    dealt = pairs.select("u", "v", F.pmod(F.xxhash64("v"), F.col("blocks")).alias("block"))
    wanted = dealt.select(F.col("v").alias("class"), "u", "block", F.lit(1).alias("role")).unionByName(dealt.select(F.col("u").alias("class"), "u", "block", F.lit(0).alias("role")).distinct())
    wanted = scratch.write(wanted.join(classes.select("class", F.col("rep").alias("doc_id"), "digest"), "class"), f"{name}-wanted")
    rows = wanted.join(only_asked(docs, wanted.select("doc_id")), "doc_id").select("u", "block", "role", "class", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, ids, sets = None, None, [], []

        def settle() -> pa.RecordBatch:
            nonlocal ids, sets
            sizes = np.array([len(s) for s in sets], np.int64)
            all_of, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            at = np.minimum(np.searchsorted(query, all_of), len(query) - 1)
            common = query[at] == all_of
            at, owner = at[common], owner[common]
            order = np.lexsort((owner, at))
            at, owner = at[order], owner[order]
            cut = np.flatnonzero(np.diff(at)) + 1
            lists = np.split(owner, cut) if len(at) else []
            hit = divide_skip(query, lists, sizes, percent) if lists else np.zeros(len(ids), bool)
            got = np.array(ids, np.int64)[hit]
            ids, sets = [], []
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(got), key[0]), pa.int64()), pa.array(got, pa.int64())], names=["u", "v"])

        for whole in batches:
            for batch in slices(whole, "text"):
                h, n = shingles(batch.column("text"), words)
                ends, said = np.cumsum(n), digests(h, n)
                cols = [batch.column(c).to_pylist() for c in ("u", "block", "role", "class", "digest")]
                for i, (u, b, role, one_of, digest) in enumerate(zip(*cols, strict=True)):
                    if said[i] != digest:
                        continue  # another text of the same document
                    one = h[ends[i] - n[i] : ends[i]]
                    if (u, b) != key or len(ids) >= 4 * block:
                        if ids:
                            yield settle()
                        key = (u, b)
                    if role == 0:
                        query = one
                    else:
                        ids.append(one_of)
                        sets.append(one)
        if ids:
            yield settle()

    dealt = rows.repartition(partitions(spark), "u", "block").sortWithinPartitions("u", "block", "role", "class")
    out = scratch.write(dealt.mapInArrow(run, "u bigint, v bigint"), f"{name}-links")
    scratch.drop(f"{name}-pairs")
    scratch.drop(f"{name}-wanted")
    return out


def across(lists: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs (u, v) of members of a list that are in different components and may reach T from their places on.

    lists: (t, rep, n, place, late, component, size), size being the list's length. Long lists are dealt in blocks of
    members, each pair of blocks a list of its own, so that none grows beyond two blocks.
    """
    parts = F.when(F.col("size") > 4 * block, F.ceil(F.col("size") / block)).otherwise(F.lit(1))
    own = lists.withColumn("parts", parts.cast("int")).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("t", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "rep", "n", "place", "component")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        out: set[tuple[int, int]] = set()

        def cross(rows: list[tuple]) -> None:
            if len({r[4] for r in rows}) < 2:
                return
            apart = key[1] != key[2]  # two blocks of a long list: its pairs within a block belong to other keys
            if len(rows) <= 12:
                for i, (bi, u, n, p, c) in enumerate(rows):
                    for bj, v, m, q, d in rows[i + 1 :]:
                        if c != d and u != v and min(n - p, m - q) >= least_overlap(n, m, percent) and 100 * min(n, m) >= percent * max(n, m) and not (apart and bi == bj):
                            out.add((min(u, v), max(u, v)))
                return
            mine, rep, n, place, comp = (np.array(x) for x in zip(*rows, strict=True))
            for i in range(len(rows) - 1):
                m = n[i + 1 :]
                ok = (comp[i + 1 :] != comp[i]) & (rep[i + 1 :] != rep[i]) & (np.minimum(n[i] - place[i], m - place[i + 1 :]) >= least_overlap(n[i], m, percent))
                ok &= 100 * np.minimum(n[i], m) >= percent * np.maximum(n[i], m)
                if apart:
                    ok &= mine[i + 1 :] != mine[i]
                u = int(rep[i])
                out.update((min(u, v), max(u, v)) for v in rep[i + 1 :][ok].tolist())

        def batch_of() -> pa.RecordBatch:
            u, v = zip(*out, strict=True) if out else ((), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            for t, a, b, *row in zip(*(batch.column(c).to_pylist() for c in ("t", "a", "b", "mine", "rep", "n", "place", "component")), strict=True):
                if (t, a, b) != key:
                    if len(held) > 1:
                        cross(held)
                    key, held = (t, a, b), []
                held.append(row)
            if len(out) > 200_000:
                yield batch_of()
        if len(held) > 1:
            cross(held)
        yield batch_of()

    n = partitions(lists.sparkSession)
    return dealt.repartition(n, "t", "a", "b").sortWithinPartitions("t", "a", "b", "rep").mapInArrow(run, "u bigint, v bigint").distinct()


def lists_of(posted: DataFrame) -> DataFrame:
    """Postings of shingles that have two or more, in one streamed pass over sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None  # the row before a batch, if it hasn't been given yet
        seen = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            t = batch.column("t").to_numpy()
            same = np.zeros(len(t), bool)
            same[1:] = t[1:] == t[:-1]
            keep = same.copy()
            keep[:-1] |= same[1:]
            keep[0] |= t[0] == seen if seen is not None else False
            last = None if keep[-1] else batch.slice(len(t) - 1, 1)
            seen = t[-1] if keep[-1] else None
            yield batch.filter(pa.array(keep))

    n = partitions(posted.sparkSession)
    return posted.repartition(n, "t").sortWithinPartitions("t").mapInArrow(run, posted.schema)


def _tag(digest: str):
    """`tag` of a column of digests."""
    byte = lambda i: F.shiftleft(F.conv(F.hex(F.substring(digest, i + 1, 1)), 16, 10).cast("int"), 8 * i)
    return byte(0).bitwiseOR(byte(1)).bitwiseOR(byte(2)).bitwiseOR(byte(3))


def similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, counters: int = COUNTERS, heavy: int = HEAVY, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    scratch = scratch or Scratch(spark, "ngrams")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = docs.filter("doc_id IS NOT NULL")

    signed = scratch.write(signatures(docs, words, counters), "signed")
    some = signed.filter("n > 0 AND doc_id IS NOT NULL")
    made = some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("minima").alias("minima"))
    classes = scratch.write(made.withColumn("class", F.monotonically_increasing_id()), "classes")  # numbers hold once they are written

    keyed = classes.select("class", "rep", F.posexplode("minima").alias("i", "least"))
    first = keyed.groupBy("i", "least").agg(F.min(F.struct("rep", "class"))["class"].alias("u"), F.count("*").alias("k")).filter("k > 1")
    pairs = scratch.write(keyed.join(first, ["i", "least"]).filter("class <> u").select("u", F.col("class").alias("v")).distinct(), "near-met")
    near = verified(filtered(pairs, classes, percent, block), classes, known, words, percent, block, scratch, "near")
    groups = components(near, scratch, "near-cc")

    often = spark.sparkContext.broadcast(frequent(signed.filter("part IS NOT NULL").select("part", "counts"), counters, heavy))  # a bit for each counter
    lists = scratch.write(lists_of(postings(known, words, percent, often)), "lists")
    to_class = some.select("doc_id", "digest").distinct().join(classes.select("digest", "class", "rep"), "digest").select("doc_id", _tag("digest").alias("tag"), "class", "rep")
    held = lists.join(to_class.drop("rep"), ["doc_id", "tag"]).select("t", "class", "n", "place", "late").distinct()
    held = held.join(groups.select(F.col("id").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    mixed = held.groupBy("t").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("size")).filter("c1 <> c2").select("t", "size")
    pairs = scratch.write(across(held.join(mixed, "t").withColumnRenamed("class", "rep"), percent, block), "far-met")
    far = verified(filtered(pairs, classes, percent, block), classes, known, words, percent, block, scratch, "far")
    for name in ("lists", "near-met", "far-met"):
        scratch.drop(name)

    # a doc_id of several texts stands in several classes: its classes are one document
    reps = classes.select("class", "rep")
    between = near.unionByName(far).join(reps.withColumnsRenamed({"class": "u", "rep": "a"}), "u").join(reps.withColumnsRenamed({"class": "v", "rep": "b"}), "v")
    own = to_class.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    links = between.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").unionByName(own).distinct()
    found = components(links, scratch, "cc")
    out = signed.filter("part IS NULL").select("doc_id", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
