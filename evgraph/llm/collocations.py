"""Collocations: phrases whose words stand together more often than their parts would by chance, mined for each language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Scratch, mix, span_hashes, utf8

#: Least occurrences of a candidate, words of the longest, and how many of each language are returned.
LEAST, MAX_WORDS, FIRST = 100, 5, 2000
#: Texts are taken in runs of so many bytes, cut between pieces.
RUN = 4 << 20
#: Parts in which pairs, by far the most phrases, are counted one after another, so that less of them is on disk at once.
PARTS = 2
#: A filter has 2 to this power bits whatever it holds.
FILTER_BITS = 27

#: Separators of words, and of pieces.
GAP, PIECE = np.zeros(256, bool), np.zeros(256, bool)
GAP[[0x20, 0x09]] = True
PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
INSIDE = ~(GAP | PIECE)
#: Odd factors that make the hash of a phrase depend on the order of its words.
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """The words of some UTF-8 texts with A-Z lowered: as an Arrow array, with hashes and the pieces that they stand in."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lang: str):
        inside = INSIDE[raw]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(raw))]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        breaks = PIECE[raw].astype(np.int32)
        breaks[cut] += 1  # a text's first byte opens a new piece; texts without bytes hold no word
        self.piece = np.cumsum(breaks, dtype=np.int64)[self.starts] if len(raw) else np.zeros(0, np.int64)
        self.hashes = mix(span_hashes(raw, self.starts, self.ends) ^ _tag(lang))
        size = self.ends - self.starts
        places = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        self.words = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(places), pa.py_buffer(raw[inside]))

    def together(self, n: int) -> np.ndarray:
        """For each place where n words can start, whether they are of one piece."""
        return self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :] if len(self.piece) >= n else np.zeros(0, bool)

    def pairs(self) -> np.ndarray:
        return mix(self.hashes[:-1] * _FACTORS[0] + self.hashes[1:] * _FACTORS[1])

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The phrases of n words that start at some words."""
        parts = [self.words.take(pa.array(at + i)) for i in range(n)]
        return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def _tag(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0] if len(raw) else np.uint64(1)


def _runs(raw: np.ndarray, offsets: np.ndarray, most: int, look: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts in runs of about `most` bytes, which end where a piece does; a long text is in several, a long piece in one."""
    start = 0
    while start < len(raw):
        stop = start + most
        while stop < len(raw):
            found = np.flatnonzero(PIECE[raw[stop : stop + look]])
            text = offsets[np.searchsorted(offsets, stop)]
            stop = min(int(text), stop + int(found[0]) + 1 if len(found) else stop + look)
            if len(found) or stop == text:
                break
        stop = min(stop, len(raw))
        inner = offsets[(offsets > start) & (offsets < stop)]
        yield raw[start:stop], np.concatenate([[start], inner, [stop]]) - start
        start = stop


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.column("text").nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _of_languages(table: pa.Table, most: int) -> Iterator[tuple[str, Words]]:
    langs = table.column("lang").combine_chunks()
    for lang in pc.unique(langs).to_pylist():
        raw, offsets = utf8(table.column("text").filter(pc.equal(langs, lang)).combine_chunks())
        for one, inner in _runs(LOWER[raw], offsets, most):
            yield lang, Words(one, inner, lang)


def _rows(lang: str, phrases: pa.Array) -> pa.RecordBatch:
    counted = pc.value_counts(phrases)
    values = counted.field("values")
    return pa.record_batch({"lang": pa.repeat(pa.scalar(lang), len(values)), "phrase": values.cast(pa.string()), "f": counted.field("counts").cast(pa.int64())})


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _filter(frequent: DataFrame, words: int) -> np.ndarray:
    """A bit for each phrase of one or two words that is frequent. Phrases that share another one's bit are counted in vain,
    no more, so the filter's size is fixed, and so is what comes to the driver: at most 2 to the power FILTER_BITS - 6 numbers."""

    def slots(batches):
        for t in _gathered((b.rename_columns(["lang", "text"]) for b in batches), RUN):
            for _, w in _of_languages(t, RUN):
                h = (w.hashes if words == 1 else w.pairs()[w.together(2)]) >> np.uint64(64 - FILTER_BITS)
                yield pa.record_batch({"slot": (h >> np.uint64(6)).astype(np.int64), "bits": (np.uint64(1) << (h & np.uint64(63))).view(np.int64)})

    # each phrase is a piece of its own: a full stop ends it
    found = frequent.select("lang", F.concat("phrase", F.lit(".")).alias("text")).mapInArrow(slots, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def grams(docs: DataFrame, low: int, high: int, bits=None, part: int = 0) -> DataFrame:
    """(lang, phrase, f): rows of all phrases of `low` to `high` words within the pieces of `docs` (lang, text), counted for each
    run of text. `bits`, a broadcast filter of words (for two words) or of pairs (beyond), leaves out what can't be frequent. Pairs
    are those of one part, by their first word."""

    def explode(batches):
        for table in _gathered(batches, RUN):
            for lang, w in _of_languages(table, RUN):
                if low == 1:
                    yield _rows(lang, w.words)
                    continue
                if high == 2:
                    known = _holds(bits.value, w.hashes)
                    alive = w.together(2) & known[:-1] & known[1:] & (w.hashes[:-1] % np.uint64(PARTS) == part)
                    yield _rows(lang, w.phrases(np.flatnonzero(alive), 2))
                    continue
                alive = two = w.together(2) & _holds(bits.value, w.pairs()) if len(w.hashes) > 1 else np.zeros(0, bool)
                for n in range(3, high + 1):
                    alive = alive[:-1] & two[n - 2 :]
                    yield _rows(lang, w.phrases(np.flatnonzero(alive), n))

    return docs.mapInArrow(explode, "lang string, phrase string, f long")


def frequent(docs: DataFrame, scratch: Scratch, least: int = LEAST, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to `max_words` words that occur `least` times, and (lang, n), all word occurrences.

    All n-grams are exploded into rows and summed by a hash aggregation: words; pairs of frequent words, in parts; longer ones of
    which each pair is frequent. A phrase cannot occur more often than a part of it, so nothing frequent is left out, and
    what could not be is never shuffled."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sums = lambda rows: rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = scratch.write(sums(grams(texts, 1, 1)), "words")
    totals = scratch.write(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    scratch.release()
    found = [words.filter(F.col("f") >= least)]
    for low, high in ((2, 2), (3, max_words)):
        if max_words < low:
            break
        bits = context.broadcast(_filter(found[-1], low - 1))
        rows = None
        for part in range(PARTS if high == 2 else 1):
            one = scratch.write(sums(grams(texts, low, high, bits, part)).filter(F.col("f") >= least), f"grams-{low}-{part}")
            rows = one if rows is None else rows.unionByName(one)
            scratch.release()
        found.append(rows)
        bits.unpersist()
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every, totals


def _joined(words: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, scratch: Scratch | None = None, least: int = LEAST, max_words: int = MAX_WORDS, most: int = FIRST) -> DataFrame:
    """For each language of `docs` (lang, text) its first `most` collocations: lang, rank, phrase, a, l, r, n, score.

    Texts are cut at .,;:!? and line ends into pieces, those at spaces and tabs into words, with A-Z lowered; a null text is empty
    and a null language `und`. Candidates are phrases of two to `max_words` words that occur a >= `least` times, overlaps included.
    Cut in two, the parts occurring l and r times, a candidate has the score floor(1000 * a * n / (l * r)), n being all words of the
    language; the lowest cut counts, of equal ones the shortest first part. A candidate inside a longer one that occurs as often is
    left out: then so is one inside a phrase longer by a word, which is what the anti-join asks. Ranks are by score, then a, both
    descending, then phrase in byte order. Repeated rows count each; an empty table gives no rows; other columns aren't read.

    Products are decimals of 38 digits, enough for languages of 10^15 words. Counts are summed within a task and before each
    shuffle, so a frequent phrase is few rows; a word that is part of many candidates is a join key that adaptive execution
    splits; ranks are cut to `most` before they are shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession, "collocations")
    counts, totals = frequent(docs.select("lang", "text"), scratch, least, max_words)
    counts = scratch.write(counts.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w")), "counts")
    candidates = counts.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), "w", "size")
    longer = counts.filter("size > 2").select("lang", F.explode(F.array(_joined(F.col("w"), 1, F.col("size") - 1), _joined(F.col("w"), 2, F.col("size") - 1))).alias("phrase"), F.col("f").alias("a"))
    cuts = candidates.join(longer, ["lang", "phrase", "a"], "left_anti").select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("w"), 1, F.col("k")).alias("first"), _joined(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")).cast("decimal(34,0)"), wide("l") * wide("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    return ranked.filter(F.col("rank") <= most).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
