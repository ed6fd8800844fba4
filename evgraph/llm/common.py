"""Shared plumbing of the text operators: scratch tables, vectorised word hashing, segment-cached tokenizers."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import Scratch, shared_dir

if "pyspark.worker" in sys.modules:
    # In a Python worker, memory that a batch no longer needs goes back to the system: no pool of Arrow's own, and arrays of
    # megabytes are mapped one by one, not cut from a heap that stays as large as it once was.
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD of glibc

__all__ = ["Scratch", "SegmentEncoder", "encoder", "mix", "partitions", "remainder", "shared_dir", "slices", "span_hashes", "table", "tune", "utf8", "word_hashes"]


def tune(spark: SparkSession) -> None:
    """Batches hold whole texts, which may be long: fewer rows to a batch, and smaller row groups where texts are written, bound
    what a task holds on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    spark.conf.set("parquet.block.size", str(32 << 20))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, n: int):
    """crc32 of an id's decimal text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


# ---------------------------------------------------------------- arrow batches


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about `most` bytes of `column`; one longer value is a run of its own."""
    col = batch.column(column)
    size = np.asarray(pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its values in them; null counts as empty."""
    col = col.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0] if len(col) else np.zeros(1, np.int64)


#: Separators of words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BLOCK = 1 << 18
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_POW = np.full(_BLOCK + 1, _P, np.uint64)
_POW[0] = 1
_POW = np.multiply.accumulate(_POW)
_INV = np.full(_BLOCK + 1, pow(_P, -1, 1 << 64), np.uint64)
_INV[0] = 1
_INV = np.multiply.accumulate(_INV)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and how many words each value has; no word crosses values."""
    inside = ~SPACE[raw]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    starts[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.diff(np.searchsorted(s, offsets))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in ascending order: a polynomial over random byte codes, then mixed with the length."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + _BLOCK, "right"))
        if j <= i:  # a span longer than a block: hash its blocks, then those hashes
            h = np.uint64(0)
            for at in range(base, int(ends[i]), _BLOCK):
                stop = min(at + _BLOCK, int(ends[i]))
                h = mix(np.array([h]))[0] ^ span_hashes(raw, np.array([at]), np.array([stop]))[0]
            out[i] = h
            i += 1
            continue
        total = np.zeros(int(ends[j - 1]) - base + 1, np.uint64)
        np.cumsum(_BYTE[raw[base : int(ends[j - 1])]] * _POW[: len(total) - 1], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * _INV[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column with A-Z lowered, and the number of words of each value."""
    raw, offsets = utf8(col)
    raw = LOWER[raw]
    s, e, n = word_bounds(raw, offsets)
    return span_hashes(raw, s, e), n


# ---------------------------------------------------------------- tokenizers

#: White space as the tokenizers' regular expressions know it (Unicode's White_Space).
WHITE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def segment_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where segments of UTF-8 texts start: at a text's start, at white space after a character that is none, and at an ASCII
    character that is no letter after a letter of Latin-1."""
    before, lead = np.zeros(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    before[1:], lead[2:] = raw[:-1], raw[:-2]
    latin = (lead == 0xC3) & (before >= 0x80)  # the two bytes before are U+00C0 to U+00FF
    letter = _LETTERS[before] | (latin & (before != 0x97) & (before != 0xB7))
    cut = SPACE[raw] & (latin | (before < 0x80) & ~SPACE[before])
    cut |= letter & (raw < 0x80) & ~_LETTERS[raw]
    first = offsets[:-1][np.diff(offsets) > 0]
    cut[first] = True
    return np.flatnonzero(cut)


class SegmentEncoder:
    """Ids of whole texts by the tokenizers library, each distinct segment encoded once while it stays cached.

    A segment ends before white space, or between a letter and an ASCII character that is none. Neither the pre-tokenisers
    nor the normalisers of the two vocabularies look across such a place, so ids of a text are the ids of its segments one
    after another. `plain` is for a vocabulary that drops white space and letter case: segments are told apart without them.

    The cache is three arrays and a pool of ids, about 25 bytes for a segment; it starts anew beyond `most` segments.
    """

    def __init__(self, name: str, plain: bool = False, most: int = 800_000, path: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.plain, self.most = plain, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.place, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, self.kind)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        ids, size = [], []
        for i in range(0, len(texts), 2000):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False)]
            size += map(len, got)
            ids += [x for one in got for x in one]
        size = np.array(size, np.int32)
        place = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, np.array(ids, self.kind)])
        keys, place, size = (np.concatenate(x) for x in ((self.keys, keys), (self.place, place), (self.size, size)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.place, self.size = keys[order], place[order], size[order]

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has; null counts as empty."""
        raw, offsets = utf8(col)
        if not len(raw):
            return np.zeros(0, self.kind), np.zeros(len(col), np.int64)
        starts = segment_starts(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        begin = starts
        if self.plain:  # past the white space that opens a segment
            solid = np.flatnonzero(~SPACE[raw])
            begin = np.minimum(np.append(solid, len(raw))[np.searchsorted(solid, starts)], ends)
        said = LOWER[raw] if self.plain else raw
        keys, back = np.unique(span_hashes(said, begin, ends), return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            one = np.zeros(len(keys), np.int64)
            one[back] = np.arange(len(back))  # some segment of each key
            fresh = np.flatnonzero(~known)
            data = said.tobytes()
            self._learn(keys[fresh], [data[a:b].decode() for a, b in zip(begin[one[fresh]].tolist(), ends[one[fresh]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, keys)
        size = self.size[at][back].astype(np.int64)
        place = self.place[at][back]
        stops = np.cumsum(size)
        ids = self.pool[np.repeat(place - (stops - size), size) + np.arange(stops[-1])]
        total = np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]
        return ids, np.diff(total)

    def documents(self, col: pa.Array, end_id: int) -> pa.Array:
        """A binary array of each text's ids (little-endian, `kind` wide) with the end id after them."""
        ids, n = self.encode(col)
        stops = np.cumsum(n + 1)
        out = np.full(stops[-1] if len(stops) else 0, end_id, self.kind)
        own = np.ones(len(out), bool)
        own[stops - 1] = False
        out[own] = ids
        places = np.concatenate([[0], stops]).astype(np.int64) * self.kind.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(out.tobytes())])


_encoders: dict[tuple, SegmentEncoder] = {}


def encoder(name: str, plain: bool = False, path: str | None = None) -> SegmentEncoder:
    """One encoder for each Python worker; workers live on from task to task."""
    key = (name, plain, path)
    if key not in _encoders:
        _encoders[key] = SegmentEncoder(name, plain, path=path)
    return _encoders[key]
