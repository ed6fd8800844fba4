"""Hierarchical multi-length packing of token streams.

Documents are routed to tiers of context size by what is left of them after whole long windows. Each tier is packed; what a
window of a long tier leaves open is filled from shorter tiers, best fit first, then by cutting a shorter document, so every
window but the last of a partition is full to a power of two and needs no padding. Windows of a tier are dealt into step
groups of equally many tokens.

Packing needs no shuffle: each task packs its own partition in bounded windows of tokens and carries the rest on. Sequence ids
hold the partition's number, so they are unique, and a recomputed task makes the same ones. `balanced` then numbers the sequences
of each tier over all partitions, from how many each partition made, and deals them into step groups: all groups of a tier but its
last have the same tokens, whatever the number of partitions.

Null and empty texts are documents of one token (the end id); very long texts are cut into whole windows and a rest; repeated rows
are packed each, and so are rows of a null doc_id; equal lengths are taken by the order of arrival; an empty table gives no piece.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, encoder, slices

#: Context sizes, powers of two; the largest bounds a sequence.
TIERS = (512, 1024, 2048, 4096)
STEP_TOKENS = 65_536
WINDOW_TOKENS = 1 << 20


class Packer:
    """Takes (key, tokens) and gives finished sequences: (tier, [(key, start, length)])."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, window: int = WINDOW_TOKENS):
        self.tiers, self.window, self.top = tuple(sorted(tiers)), window, max(tiers)
        self.pool: list[tuple[int, int, int]] = []  # (length, key, start), ascending
        self.held = 0

    def tier(self, length: int) -> int:
        return self.tiers[bisect_left(self.tiers, length)]

    def add(self, key: int, tokens: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        for start in range(0, tokens - self.top + 1, self.top):
            yield self.top, [(key, start, self.top)]
        if rest := tokens % self.top:
            self.pool.append((rest, key, tokens - rest))
            self.held += rest
        if self.held > self.window:
            yield from self.flush(False)

    def flush(self, last: bool = True) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        pool = sorted(self.pool)
        while pool:
            size, key, start = pool.pop()
            tier = self.tier(size)
            pieces, gap = [(key, start, size)], tier - size
            while gap and pool:
                at = bisect_right(pool, (gap, np.inf, 0)) - 1
                if at >= 0:  # the longest that fits
                    length, k, s = pool.pop(at)
                    pieces.append((k, s, length))
                    gap -= length
                else:  # all are longer than the gap: cut the shortest
                    length, k, s = pool.pop(0)
                    pieces.append((k, s, gap))
                    insort(pool, (length - gap, k, s + gap))
                    gap = 0
            if not gap:
                yield tier, pieces
            elif not last:
                pool = []
                self.pool = [(n, k, s) for k, s, n in pieces]
                self.held = sum(n for _, _, n in pieces)
                return
            else:  # nothing is left to fill it with: cut full windows off, shortest tiers last; what is below all of them is padded
                yield from self.remains(pieces)
        self.pool, self.held = [], 0

    def remains(self, pieces: list[tuple[int, int, int]]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        total = sum(n for _, _, n in pieces)
        while total:
            size = next((t for t in reversed(self.tiers) if t <= total), total)
            out, need = [], size
            while need:
                k, s, n = pieces.pop(0)
                out.append((k, s, min(n, need)))
                if n > need:
                    pieces.insert(0, (k, s + need, n - need))
                need -= out[-1][2]
            yield (size if size in self.tiers else self.top), out
            total -= size


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, tiers: tuple[int, ...] = TIERS, window: int = WINDOW_TOKENS, path: str | None = None) -> DataFrame:
    """Pieces of all documents with their token ids (little-endian unsigned 32-bit), places, and the number of their sequence among
    those of its tier and partition."""
    names = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(), "tier": pa.int64(), "part": pa.int32(), "tier_no": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), encoder(tokenizer, True, path)
        packer, held, seen, number, used = Packer(tiers, window), {}, 0, 0, dict.fromkeys(tiers, 0)
        out: list[tuple] = []

        def place(made) -> None:
            nonlocal number
            for tier, pieces in made:
                at = 0
                for key, start, n in pieces:
                    doc, ids, left = held[key]
                    out.append((doc, start, n, ids[4 * start : 4 * (start + n)], len(ids) // 4, (part << 36) + number, at, tier, part, used[tier]))
                    at += n
                    if left == n:
                        del held[key]
                    else:
                        held[key] = (doc, ids, left - n)
                used[tier] += 1
                number += 1

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[] for _ in names]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, names.values(), strict=True)], names=list(names))

        for whole in batches:
            for batch in slices(whole, "text"):
                for doc, ids in zip(batch.column("doc_id").to_pylist(), own.documents(batch.column("text"), end_id).to_pylist(), strict=True):
                    ids = np.frombuffer(ids, own.kind).astype("<u4").tobytes()
                    held[seen] = (doc, ids, len(ids) // 4)
                    place(packer.add(seen, len(ids) // 4))
                    seen += 1
                if len(out) > 2000:
                    yield batch_of()
        place(packer.flush())
        yield batch_of()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier bigint, part int, tier_no bigint")


def balanced(pieces: DataFrame, scratch: Scratch, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """`step_group` in place of `part` and `tier_no`, for pieces in any form that has those. They are written, so that texts are
    encoded once; what is broadcast is a row for each partition and tier."""
    pieces = scratch.write(pieces, "pieces")
    made = pieces.groupBy("part", "tier").agg((F.max("tier_no") + 1).alias("made"))
    before = made.withColumn("before", F.coalesce(F.sum("made").over(Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("made")
    numbered = pieces.join(F.broadcast(before), ["part", "tier"])
    return numbered.withColumn("step_group", F.floor((F.col("before") + F.col("tier_no")) * F.col("tier") / F.lit(step_tokens)).cast("long")).drop("part", "tier_no", "before")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a crc32 of their ids in the ids' place."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]


def packed(docs: DataFrame, scratch: Scratch | None = None, **options) -> DataFrame:
    """Digests of all pieces in step groups."""
    return balanced(digest(pack(docs, **options)), scratch or Scratch(docs.sparkSession, "packing")).select(*RESULT)
