"""Ranked search by inverted treaps: the postings of a term are a tree in order of documents and a heap by impact."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Scratch, slices, span_hashes, utf8

#: Ranks returned, bytes of item texts and items to one pass over the index, postings and documents under one set of treaps.
FIRST, ITEM_BYTES, ITEMS, POSTINGS, DOCUMENTS = 20, 4 << 20, 1000, 1 << 20, 8192
#: Items that are searched side by side, and intervals that one step of theirs looks at.
SIDE, STEP = 16, 1 << 14

_INSIDE = np.ones(256, bool)
_INSIDE[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text in order."""
    return _TERM.findall((text or "").encode().translate(LOWER.tobytes()))


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all terms of some texts, and the text of each."""
    inside = _INSIDE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def _hash(terms: list[bytes]) -> np.ndarray:
    size = np.array([len(t) for t in terms], np.int64)
    ends = np.cumsum(size)
    return span_hashes(np.frombuffer(b"".join(terms), np.uint8), ends - size, ends)


def _equal(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of two arrays are equal; spans have a byte at least."""
    if not len(size):
        return np.zeros(0, bool)
    ends = np.cumsum(size)
    step = np.arange(ends[-1]) - np.repeat(ends - size, size)
    return np.logical_and.reduceat(a[np.repeat(a_starts, size) + step] == b[np.repeat(b_starts, size) + step], ends - size)


BLOCK = "ids array<long>, n binary, terms binary, sizes binary, docs binary, tf binary"


def index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Blocks of documents, with how many terms each has (n), and for each of `terms` that occurs the documents that hold it and
    how often: numbers of terms, postings of each, then documents and occurrences, one after another."""
    keys = _hash(terms)
    order = np.argsort(keys)
    keys = keys[order]
    if len(keys) > 1 and (keys[1:] == keys[:-1]).any():
        raise ValueError("two terms share a hash")
    known = docs.sparkSession.sparkContext.broadcast((keys, order.astype(np.int64), terms))

    def blocks(batches):
        keys, order, terms = known.value
        letters, size = np.frombuffer(b"".join(terms), np.uint8), np.array([len(t) for t in terms], np.int64)
        begin = np.cumsum(size) - size
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                raw, offsets = utf8(part.column("text"))
                raw = LOWER[raw]
                starts, ends, text = spans(raw, offsets)
                n = np.bincount(text, minlength=len(part))
                mine = term = np.zeros(0, np.int64)
                if len(keys) and len(starts):
                    hashes = span_hashes(raw, starts, ends)
                    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                    mine = np.flatnonzero(keys[at] == hashes)
                    term = order[at[mine]]
                    alike = size[term] == ends[mine] - starts[mine]  # a term of the same hash may be another one
                    mine, term = mine[alike], term[alike]
                    alike = _equal(raw, starts[mine], letters, begin[term], size[term])
                    mine, term = mine[alike], term[alike]
                pairs, tf = np.unique(term * max(1, len(part)) + text[mine], return_counts=True)
                found, sizes = np.unique(pairs // max(1, len(part)), return_counts=True)
                yield pa.record_batch({
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column("doc_id").cast(pa.int64())),
                    **{k: pa.array([np.asarray(v, np.int64 if k == "n" else np.int32).tobytes()], pa.binary()) for k, v in (("n", n), ("terms", found), ("sizes", sizes), ("docs", pairs % max(1, len(part))), ("tf", tf))},
                })

    return docs.mapInArrow(blocks, BLOCK)


class Treaps:
    """One treap for each term over the same documents, as arrays: document, impact, left and right child of each posting. The
    posting after the last stands for an empty tree."""

    def __init__(self, n_terms: int, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        """Postings in order of terms, then documents; impacts are above 0 and below 2 to the power 31. Of equal impacts the smaller
        document is the higher node, so a treap is one and the same however it is built."""
        m = len(docs)
        self.doc = np.append(docs, -1).astype(np.int32)
        self.impact = np.append(impacts, 0).astype(np.int64)
        self.left, self.right = np.full(m + 1, m, np.int32), np.full(m + 1, m, np.int32)
        self.root = np.full(n_terms, m, np.int32)
        if not m:
            return
        # each posting among walls: the nearest greater one on either side, found by jumps over smaller ones
        starts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
        wall = np.zeros(m, np.int64)
        wall[starts] = 1
        place = np.arange(m) + np.cumsum(wall)  # room for a wall before each treap, and one after the last
        key = np.full(m + len(starts) + 1, np.iinfo(np.int64).max)
        key[place] = (self.impact[:m] << 31) | ((1 << 31) - 1 - self.doc[:m].astype(np.int64))
        above = []
        for step in (-1, 1):
            near = np.arange(len(key)) + step
            active = place
            while len(active):
                active = active[key[near[active]] < key[active]]
                near[active] = near[near[active]]
            above.append(near[place])
        before, after = above
        behind = key[before] < key[after]  # the parent is the smaller of the two
        parent = np.where(behind, before, after)
        own = np.full(len(key), -1, np.int64)
        own[place] = np.arange(m)
        up = own[parent]
        me = np.arange(m, dtype=np.int32)
        top = up < 0
        self.root[terms[top]] = me[top]
        low = ~top & ~behind
        self.left[up[low]] = me[low]
        low = ~top & behind
        self.right[up[low]] = me[low]

    def within(self, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The root of what each subtree has of documents between low and high, both excluded: the first such node on the way down."""
        node = node.copy()
        flat, low, high = node.reshape(-1), np.broadcast_to(low, node.shape).reshape(-1), np.broadcast_to(high, node.shape).reshape(-1)
        empty = len(self.doc) - 1
        active = np.flatnonzero(flat != empty)
        while len(active):
            at = flat[active]
            doc = self.doc[at]
            under, over = doc <= low[active], doc >= high[active]
            active = active[under | over]
            at, under = at[under | over], under[under | over]
            flat[active] = np.where(under, self.right[at], self.left[at])
            active = active[flat[active] != empty]
        return node

    def at(self, node: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The impact of a document in each subtree, 0 where it isn't there."""
        empty = len(self.doc) - 1
        out = np.zeros(node.shape, np.int64).reshape(-1)
        flat, doc = node.reshape(-1).copy(), np.broadcast_to(doc, node.shape).reshape(-1)
        active = np.flatnonzero(flat != empty)
        while len(active):
            at, want = flat[active], doc[active]
            here = self.doc[at]
            hit = here == want
            out[active[hit]] = self.impact[at[hit]]
            active, at, less = active[~hit], at[~hit], (here < want)[~hit]
            flat[active] = np.where(less, self.right[at], self.left[at])
            active = active[flat[active] != empty]
        return out.reshape(node.shape)


@dataclass
class Best:
    """The best documents of each item so far: score and id in descending order of rank; ids are compared with null after all."""

    item: np.ndarray
    score: np.ndarray
    doc_id: np.ndarray
    null: np.ndarray

    @classmethod
    def none(cls) -> Best:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def add(self, other: Best, first: int) -> Best:
        item, score, doc_id, null = (np.concatenate(x) for x in zip(self.parts(), other.parts(), strict=True))
        order = np.lexsort((doc_id, null, -score, item))
        item = item[order]
        starts = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else np.zeros(0, np.int64)
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        kept = order[rank < first]
        return Best(*(np.concatenate(x)[kept] for x in zip(self.parts(), other.parts(), strict=True)))

    def parts(self):
        return self.item, self.score, self.doc_id, self.null

    def floor(self, items: int, first: int) -> np.ndarray:
        """The score that a document must have to be among the first of each item, 1 where there is room."""
        out = np.ones(items, np.int64)
        full = np.flatnonzero(np.bincount(self.item, minlength=items) >= first)
        if len(full):
            least = np.full(items, np.iinfo(np.int64).max)
            np.minimum.at(least, self.item, self.score)
            out[full] = least[full]
        return out


def search(treaps: Treaps, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, null: np.ndarray, best: Best, base: int, first: int = FIRST) -> tuple[Best, int]:
    """Adds to the best of some items (rows of `terms` and `weights`, padded with weight 0; numbered from `base`) the documents of a
    set of treaps, and counts the documents looked at.

    All treaps of an item are walked at once. An interval of documents has in each treap the highest node within it; the sum of
    their weighted impacts is the most that a document there can score. Where that is below the item's first ones so far, the
    interval is left with all its subtrees; else the document of the greatest part is scored in all treaps and splits it in two.
    Intervals of the highest bounds come first."""
    n = len(terms)
    node = treaps.root[terms]
    node[weights == 0] = len(treaps.doc) - 1
    item = np.arange(n)
    low, high = np.full(n, -1, np.int32), np.full(n, len(ids), np.int32)
    bound = (treaps.impact[node] * weights).sum(1)
    seen = 0
    while len(item):
        floor = best.floor(base + n, first)[base:]
        alive = np.flatnonzero(bound >= floor[item])
        node, item, low, high, bound = node[alive], item[alive], low[alive], high[alive], bound[alive]
        if not len(item):
            break
        later = None
        if len(item) > STEP:
            order = np.argpartition(-bound, STEP)
            later = tuple(x[order[STEP:]] for x in (node, item, low, high, bound))
            node, item, low, high, bound = (x[order[:STEP]] for x in (node, item, low, high, bound))
        part = treaps.impact[node] * weights[item]
        pivot = treaps.doc[node[np.arange(len(item)), part.argmax(1)]]
        score = (treaps.at(node, pivot[:, None]) * weights[item]).sum(1)
        seen += len(item)
        good = score >= floor[item]
        best = best.add(Best(base + item[good], score[good], ids[pivot[good]], null[pivot[good]]), first)
        node = np.concatenate([treaps.within(node, low[:, None], pivot[:, None]), treaps.within(node, pivot[:, None], high[:, None])])
        item, low, high = np.concatenate([item, item]), np.concatenate([low, pivot]), np.concatenate([pivot, high])
        bound = (treaps.impact[node] * weights[item]).sum(1)
        if later is not None:
            node, item, low, high, bound = (np.concatenate([a, b]) for a, b in zip((node, item, low, high, bound), later, strict=True))
        alive = bound > 0
        node, item, low, high, bound = node[alive], item[alive], low[alive], high[alive], bound[alive]
    return best, seen


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, null, n, term, doc, tf) of so many blocks as make one set of treaps; postings by term, then document in order of ids."""
    held: list[tuple[np.ndarray, ...]] = []

    def joined():
        shift = np.concatenate([[0], np.cumsum([len(h[0]) for h in held])])
        ids, null, n = (np.concatenate([h[i] for h in held]) for i in range(3))
        term, tf = np.concatenate([h[3] for h in held]), np.concatenate([h[5] for h in held])
        doc = np.concatenate([h[4] + s for h, s in zip(held, shift, strict=False)])
        order = np.lexsort((ids, null))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        doc = rank[doc]
        by = np.argsort(term.astype(np.int64) * len(ids) + doc, kind="stable")
        return ids[order], null[order], n[order], term[by], doc[by], tf[by]

    for batch in batches:
        for row in range(len(batch)):
            list_of = batch.column("ids")[row].values
            ids = list_of.fill_null(0).to_numpy(zero_copy_only=False)
            n, terms, sizes, docs, tf = (np.frombuffer(batch.column(k)[row].as_py(), np.int64 if k == "n" else np.int32) for k in ("n", "terms", "sizes", "docs", "tf"))
            held.append((ids, list_of.is_null().to_numpy(zero_copy_only=False), n, np.repeat(terms, sizes), docs, tf))
            if sum(len(h[4]) for h in held) >= POSTINGS or sum(len(h[0]) for h in held) >= DOCUMENTS:
                yield joined()
                held.clear()
    if held:
        yield joined()


def _blocks_of(items: DataFrame) -> Iterator[list[tuple]]:
    """Items a block at a time, in a fixed order; each block is bounded in items and bytes (one longer text is a block)."""
    held, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        held.append((row["item_id"], terms_of(row["text"])))
        size += len(row["text"] or "")
        if size >= ITEM_BYTES or len(held) >= ITEMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, scratch: Scratch | None = None, first: int = FIRST) -> DataFrame:
    """For each item (item_id, text) the `first` documents (doc_id, text) of the highest score above 0: item_id, rank, doc_id, score.

    Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lowered. The score of a
    document is the sum over the item's terms, repeats included, of floor(1000 ln((2N+2)/(2df+1))) times the term's impact,
    (1000000000 tf) div (1000 tf + 12 m), m being 75 + (25 n N) div L. Ties go to the smaller doc_id, null after all others. A null
    or empty text has no terms, as document or item; an item without any is in no row. Rows of a doc_id that repeats are ranked
    each; equal items count once, other texts of an item_id are items of their own. No documents or no items: no rows. Other columns
    aren't read.

    Items come in blocks of bounded size, each against all documents. Documents are indexed by the terms of the block, whole texts
    of any length, and the index is written; each task makes treaps of some thousand documents after another and keeps the first of
    each item, so what it holds and returns is bounded, and the ranks of all tasks are merged by a window that cuts before it
    shuffles. No term's postings meet in one place, however frequent it is.
    """
    scratch = scratch or Scratch(docs.sparkSession, "treaps")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", "text").distinct()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for k, block in enumerate(_blocks_of(asked)):
        out = out.unionByName(_block(spark, texts, block, scratch, k, kind, first))
    return out


def _block(spark, texts: DataFrame, block: list[tuple], scratch: Scratch, k: int, kind: str, first: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in block for t in terms))}
    blocks = scratch.write(index(texts, list(vocabulary)), f"index-{k}")

    def numbers(batches):
        for b in batches:
            for row in range(len(b)):
                n = np.frombuffer(b.column("n")[row].as_py(), np.int64)
                terms, sizes = (np.frombuffer(b.column(c)[row].as_py(), np.int32) for c in ("terms", "sizes"))
                yield pa.record_batch({"term": np.append(terms.astype(np.int64), [-1, -2]), "df": np.append(sizes.astype(np.int64), [np.count_nonzero(n), n.sum()])})

    # as many rows as the block of items has terms
    sums = blocks.select("n", "terms", "sizes").mapInArrow(numbers, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    known = dict(zip(sums.column("term").to_pylist(), sums.column("df").to_pylist(), strict=True))
    n_docs, n_terms = known.get(-1, 0), known.get(-2, 0)
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * known.get(i, 0) + 1))) for i in range(len(vocabulary))]
    counts = [{} for _ in block]
    for one, (_, terms) in zip(counts, block, strict=True):
        for t in terms:
            if (i := vocabulary[t]) in known:
                one[i] = one.get(i, 0) + 1
    counts = [{t: c * weight[t] for t, c in one.items() if weight[t]} for one in counts]
    given = spark.sparkContext.broadcast((len(vocabulary), counts))

    def walk(batches):
        n_vocabulary, counts = given.value
        best = Best.none()
        order = sorted(range(len(counts)), key=lambda i: len(counts[i]))
        sides = []
        for i in range(0, len(order), SIDE):
            side = [counts[j] for j in order[i : i + SIDE]]
            wide = max(1, max(map(len, side)))
            terms, weights = np.zeros((len(side), wide), np.int64), np.zeros((len(side), wide), np.int64)
            for r, one in enumerate(side):
                terms[r, : len(one)], weights[r, : len(one)] = list(one), list(one.values())
            sides.append((i, terms, weights))
        for ids, null, n, term, doc, tf in _shards(batches):
            m = 75 + (25 * n * n_docs) // max(1, n_terms)
            impact = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m[doc])
            some = impact > 0
            treaps = Treaps(n_vocabulary, term[some], doc[some], impact[some])
            for base, terms, weights in sides:
                mine = best.item // SIDE == base // SIDE
                own, _ = search(treaps, terms, weights, ids, null, Best(*(x[mine] for x in best.parts())), base, first)
                best = Best(*(np.concatenate([a[~mine], b]) for a, b in zip(best.parts(), own.parts(), strict=True)))
        if len(best.item):
            yield pa.record_batch({"item": np.array(order)[best.item], "doc_id": pa.array(best.doc_id, mask=best.null), "score": best.score})

    hits = blocks.mapInArrow(walk, "item long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item long, item_id {kind}")
    return hits.withColumn("rank", rank).filter(F.col("rank") <= first).join(names, "item").select("item_id", "rank", "doc_id", "score")
