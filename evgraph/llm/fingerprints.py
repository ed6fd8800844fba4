"""Document fingerprints: an invertible Bloom lookup sketch of a text's paragraph digests.

A text's cells are its paragraphs (lines), long ones cut further after words that a hash marks (about one in `WORDS`), so an
edit changes the cells that it touches and no others. A cell's digest counts how often it stood before in the text, so repeated
paragraphs are different digests. Each digest is added to three cells of a sketch (count, xor of digests, xor of check
sums). The sketches of two versions subtract; peeling cells that hold one digest recovers those that only one version has.
Where peeling gets stuck, both sketches are made anew twice as large, until all differing digests are recovered.

The fingerprint is the smallest sketch (`SLOTS`) with the number of digests, in base64; equal texts have equal ones. Likeness of
two fingerprints is 1 - differing / (both numbers), 1 for two empty texts.

Null and empty texts have no cells; very long texts have as many as they need; other columns are ignored. Rows that share a
doc_id follow each other by text; a null doc_id comes last in the descending order.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bit_planes import bucket_of, id_bounds
from .common import mix, partitions, span_hashes, utf8

SLOTS, HASHES, WORDS = 32, 3, 16
#: More paragraphs cells than this in a batch are sketched in several goes.
GO = 4 << 20


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the cells of all texts one after another, and how many each text has."""
    raw, offsets = utf8(pa.array(texts, pa.large_string()))
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    # words end at a space or line feed; a cell ends with a line, with a text, or after a marked word
    end = (raw == 0x0A) | (raw == 0x20)
    end[offsets[1:][np.diff(offsets) > 0] - 1] = True
    stops = np.flatnonzero(end) + 1
    starts = np.concatenate([[0], stops[:-1]])
    words = span_hashes(raw, starts, stops)
    cut = (raw[stops - 1] == 0x0A) | (words % np.uint64(WORDS) == 0) | np.isin(stops, offsets[1:])
    stops = stops[cut]
    starts = np.concatenate([[0], stops[:-1]])
    owner = np.searchsorted(offsets, starts, "right") - 1
    h = span_hashes(raw, starts, stops)
    blank = (stops - starts == 1) & (raw[starts] == 0x0A)  # empty lines are no cells
    h, owner = h[~blank], owner[~blank]
    # the same digest again in a text: its number goes in
    order = np.lexsort((h, owner))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    run = np.arange(len(h)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    out = mix(h[order] + run.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 5)
    return out, np.bincount(owner, minlength=len(texts))


def _cells(d: np.ndarray, slots: int) -> list[np.ndarray]:
    """Three different slots of each digest, one in each third of the sketch."""
    third = slots // HASHES
    return [(mix(d, 31 * slots + k) % np.uint64(third)).astype(np.int64) + k * third for k in range(HASHES)]


def _check(d: np.ndarray) -> np.ndarray:
    return mix(d, 977) >> np.uint64(32)


def sketch(d: np.ndarray, owner: np.ndarray, rows: int, slots: int, sign: np.ndarray | int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digests and check sums, [rows, slots] each."""
    count = np.zeros(rows * slots, np.int64)
    keys, checks = np.zeros(rows * slots, np.uint64), np.zeros(rows * slots, np.uint64)
    check = _check(d)
    for at in _cells(d, slots):
        at = owner * slots + at
        np.add.at(count, at, sign)
        np.bitwise_xor.at(keys, at, d)
        np.bitwise_xor.at(checks, at, check)
    return count.reshape(rows, slots), keys.reshape(rows, slots), checks.reshape(rows, slots)


def peel(count: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Recovers the digests of subtracted sketches (which it empties): their rows, the digests, and which rows came out whole."""
    rows, slots = count.shape
    count, keys, checks = count.reshape(-1), keys.reshape(-1), checks.reshape(-1)
    found_row, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    pure = np.flatnonzero(np.abs(count) == 1)
    while len(pure):
        pure = pure[(np.abs(count[pure]) == 1)]
        pure = pure[_check(keys[pure]) == checks[pure]]
        if not len(pure):
            break
        row, d, sign = pure // slots, keys[pure], count[pure]
        _, first = np.unique(np.stack([row.astype(np.uint64), d]), axis=1, return_index=True)
        row, d, sign = row[first], d[first], sign[first]
        found_row.append(row)
        found.append(d)
        touched = []
        check = _check(d)
        for at in _cells(d, slots):
            at = row * slots + at
            np.add.at(count, at, -sign)
            np.bitwise_xor.at(keys, at, d)
            np.bitwise_xor.at(checks, at, check)
            touched.append(at)
        pure = np.unique(np.concatenate(touched))
    whole = ~((count.reshape(rows, slots) != 0).any(axis=1) | (keys.reshape(rows, slots) != 0).any(axis=1))
    return np.concatenate(found_row), np.concatenate(found), whole


def _some(d: np.ndarray, n: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of some texts, and each one's place among them."""
    ends = np.cumsum(n)
    size = n[rows]
    at = np.repeat(ends[rows] - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return d[at], np.repeat(np.arange(len(rows)), size)


def differing(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """How many digests only one of each two texts has, by subtracting sketches and peeling, retrying larger on failure."""
    out = np.zeros(len(a[1]), np.int64)
    todo = np.flatnonzero(a[1] + b[1] > 0)
    slots = slots - slots % HASHES
    while len(todo):
        stuck = []
        step = max(1, GO // slots)
        for i in range(0, len(todo), step):
            rows = todo[i : i + step]
            (da, oa), (db, ob) = _some(*a, rows), _some(*b, rows)
            ca, ka, xa = sketch(da, oa, len(rows), slots)
            cb, kb, xb = sketch(db, ob, len(rows), slots)
            row, _, whole = peel(ca - cb, ka ^ kb, xa ^ xb)
            out[rows] = np.bincount(row, minlength=len(rows))
            stuck.append(rows[~whole])
        todo, slots = np.concatenate(stuck), slots * 2
    return out


def fingerprint(d: np.ndarray, n: np.ndarray, slots: int = SLOTS) -> list[str]:
    slots -= slots % HASHES
    out = []
    for i in range(0, len(n), 2000):
        rows = np.arange(i, min(i + 2000, len(n)))
        count, keys, checks = sketch(*_some(d, n, rows), len(rows), slots)
        for k, c, x, y in zip(n[rows], count.astype("<i4"), keys.astype("<u8"), checks.astype("<u4"), strict=True):
            out.append(base64.b64encode(struct.pack("<BI", slots, int(k)) + c.tobytes() + x.tobytes() + y.tobytes()).decode())
    return out


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], slots: int = SLOTS) -> np.ndarray:
    both = a[1] + b[1]
    return np.where(both > 0, 1.0 - differing(a, b, slots) / np.maximum(both, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third] if third else text


def with_next(docs: DataFrame, n: int) -> DataFrame:
    """Rows dealt by ranges of doc_id, ascending: bucket, doc_id, text and `extra`.

    A row's next document by descending doc_id stands in the same bucket, but for the bucket's lowest: the rows of the nearest
    lower bucket's highest doc_id (for the lowest bucket: of the highest of all) go with the bucket too, as `extra`.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds = id_bounds(base, n)
    base = base.withColumn("bucket", bucket_of("doc_id", bounds))
    # one row for each of at most n buckets; a null doc_id is lowest of all
    tops = sorted((r["bucket"], r["top"]) for r in base.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    edge = base.sparkSession.createDataFrame([(tops[i - 1][0], tops[i - 1][1], b) for i, (b, _) in enumerate(tops)], "bucket int, top bigint, to int")
    extra = base.join(F.broadcast(edge), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("top"))).select("doc_id", "text", F.col("to").alias("bucket"), F.lit(1).alias("extra"))
    return base.withColumn("extra", F.lit(0)).unionByName(extra).repartition(n, "bucket").sortWithinPartitions("bucket", "extra", F.desc_nulls_last("doc_id"), "text")


def compare(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Of each text: its fingerprint, its edited text's, and the likeness of its own to that and to the next document's."""
    names = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def settle(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
        texts, following = [r[1] for r in rows], [r[2] for r in rows]
        new = [edited(t, f) for t, f in zip(texts, following, strict=True)]
        own, other, after = digests(texts), digests(new), digests(following)
        cols = [[r[0] for r in rows], [len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], fingerprint(*own, slots), fingerprint(*other, slots), likeness(own, other, slots), likeness(own, after, slots)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, names.values(), strict=True)], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, before, rows, held = None, None, [], 0
        for batch in batches:
            for b, doc, text, extra in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "extra")), strict=True):
                if b != bucket:
                    bucket, before = b, None
                if before is not None:
                    rows.append((*before, text))
                    held += 2 * len(before[1]) + len(text)
                before = (doc, text) if not extra else None
                if held > 3 << 20:
                    yield settle(rows)
                    rows, held = [], 0
        if rows:
            yield settle(rows)

    dealt = with_next(docs, partitions(docs.sparkSession))
    return dealt.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
