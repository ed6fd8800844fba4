"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of words before a token, within a document. Contexts of one word are candidates if they stand `least` times in
the training texts, whatever their size. A candidate's successors are those seen with it often enough. It is retained by a
divergence test: the weighted divergence of its smoothed next-symbol distribution from that of its longest retained suffix,
which is the gain in bits over its training tokens, must exceed `bits` for each number it stores. The tree grows from what is
retained: a longer context is a candidate if it stands `least` times, it without its first word is retained, and it without its
last word is a candidate. Contexts lengthen until there is none; their length has no other bound. Distributions are smoothed
by absolute discounting: what is taken off the stored successors goes to the suffix's distribution, down to the root, which is
the add-one unigram distribution over the whole vocabulary and one unknown word. A token is scored in the longest retained
suffix state of the words before it.

Counts are exact and cover the whole training corpus: tasks count in arrays, deal sorted keys with counts by key range, and sum
them there. Vocabulary, candidates and tree grow with the corpus: they are written tables, joined by shuffles. Of fixed size,
and sent to all tasks, are the most frequent words (at most `head`) and weights of the tree (at most `heavy`) and an
array of at most 2^FILTER bits, which passes every key of a table and few others; the joins drop those others.

A score is a sum of weights that are looked up one by one: of each token the root's, of each retained context before it what is
left to its suffix, and, if the context stores the token, what the stored probability adds to that.

Words are told apart by 64-bit hashes. Null and empty texts have one token, the end. Repeated rows are scored each (and
counted each, when in training); other columns pass through `score`, unless they bear the name of a result column, which wins.
A null doc_id is a value like others here; in the query its remainder is null, so its row is scored and not learnt from. Ties
don't arise: counts and limits decide alone. With no training rows all probabilities are those of the unknown word alone, and an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix, partitions, slices, word_hashes

LEAST, BITS = 32, 8.0
#: A successor is stored from a FOLLOW-th of a context's own limit on.
FOLLOW, DISCOUNT = 4, 0.75
#: Words and weights that are sent to all tasks, the most frequent ones: 8 and 32 MB, whatever the corpus.
HEAD, HEAVY = 500_000, 2_000_000
END = np.uint64(0x656E64)
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
SEED = 0x5EED
#: Bits of the array that is sent to all tasks, as a power of two: at most these, and fewer for few tokens.
FILTER = 27
#: Tuples that a task holds before it counts them, and groups of buckets that tuples are dealt in.
FLUSH, GROUPS = 1_000_000, 64


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, ends included, and how many each has; binary values hold the hashes themselves."""
    if pa.types.is_binary(col.type):
        held = [np.frombuffer(x, np.uint64) for x in col.to_pylist()]
        return np.concatenate([np.zeros(0, np.uint64), *held]), np.array([len(x) for x in held], np.int64)
    h, n = word_hashes(col)
    stops = np.cumsum(n + 1)
    out = np.full(int(stops[-1]) if len(stops) else 0, END, np.uint64)
    own = np.ones(len(out), bool)
    own[stops - 1] = False
    out[own] = h
    return out, n + 1


def longer(key: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The key of a context with one token more at its end."""
    return mix(key * np.uint64(0x9E3779B97F4A7C15) + token, 3)


def context(parts: list[np.ndarray]) -> np.ndarray:
    """A key of the words of a context, oldest first."""
    key = np.full(len(parts[0]), SEED, np.uint64)
    for p in parts:
        key = longer(key, p)
    return key


def follow(key: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(key + token * np.uint64(0xD6E8FEB86659FD93), 17)


def chain(h: np.ndarray, n: np.ndarray, bits: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level, places of the tokens before which a candidate context stands in their text, and the contexts' keys. Of a
    candidate, the context without its last word is one, too."""
    last = np.zeros(len(h), bool)
    last[np.cumsum(n) - 1] = True
    at, key = np.arange(len(h)), np.full(len(h), SEED, np.uint64)
    for _ in range(depth):
        inside = ~last[at]
        at, key = at[inside], longer(key[inside], h[at[inside]])
        found = among(bits, key)
        at, key = at[found] + 1, key[found]
        yield at, key


def among(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether keys pass the array of bits."""
    at = keys >> np.uint64(64 - (64 * len(bits) - 1).bit_length())
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def added(bits: np.ndarray, table: DataFrame, column: str) -> np.ndarray:
    """The array of bits with those of a table's keys; what comes to the driver is of fixed size."""
    at = table.select(F.shiftrightunsigned(column, 64 - (64 * len(bits) - 1).bit_length()).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("set"))
    word, held = gathered(words, "word", "set")
    out = bits.copy()
    out[word] |= held.view(np.uint64)
    return out


def runs(docs: DataFrame, bits: Broadcast, level: int) -> DataFrame:
    """The runs of tokens that stand in or after a candidate context of a level, as `text`, 8 bytes a token: all that longer
    contexts are counted from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, n = tokens(batch.column("text"))
                for at, _ in chain(h, n, bits.value, level):
                    pass
                step = np.bincount(at - level, minlength=len(h) + 1) - np.bincount(at + 1, minlength=len(h) + 1)
                inside = np.cumsum(step)[: len(h)] > 0
                first = np.zeros(len(h), bool)
                first[np.cumsum(n) - n] = True
                starts = np.flatnonzero(inside & (first | ~np.concatenate([[False], inside[:-1]])))
                held = h[inside]
                cut = np.append(np.cumsum(inside)[starts] - 1, len(held)) * 8
                yield pa.RecordBatch.from_arrays([pa.array([held.data.cast("B")[a:b] for a, b in zip(cut, cut[1:], strict=False)], pa.binary())], names=["text"])

    return docs.select("text").mapInArrow(run, "text binary")


class Table:
    """Places of keys, which are hashes, in a sorted array of keys, by an index of where each leading bits' keys start."""

    def __init__(self, keys: np.ndarray):
        self.keys, bits = keys, max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift), len(keys)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """-1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        part = (keys >> self.shift).astype(np.int64)
        at, end = self.starts[part], self.starts[part + 1]
        seen = self.keys.take(at, mode="clip")
        out = np.where((seen == keys) & (at < end), at, -1).astype(np.int64)
        at += 1
        live = np.flatnonzero((seen < keys) & (at < end))  # all others are found, or passed, at the first place
        keys, at, end = keys[live], at[live], end[live]
        while len(live):
            seen = self.keys[at]
            hit = seen == keys
            out[live[hit]] = at[hit]
            at = at + 1
            on = (seen < keys) & (at < end)
            live, keys, at, end = live[on], keys[on], at[on], end[on]
        return out


def planes(n: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed: the high ones are mostly zero and cost next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(n.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class Numbers:
    """Hashes as their places among known ones, most frequent first, so that most are small; all others have the next number."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.none = keys, len(keys)
        self.place = np.argsort(keys)
        self.table = Table(keys[self.place])

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = self.table.find(hashes)
        return np.where(at >= 0, self.place[at] if self.none else 0, self.none)

    def back(self, numbers: np.ndarray, others: bytes) -> np.ndarray:
        far = numbers == self.none
        out = np.zeros(len(numbers), np.uint64)
        out[far] = np.frombuffer(others, np.uint64)
        out[~far] = self.keys[numbers[~far]]
        return out


def spread(spark: SparkSession) -> int:
    """Buckets to a group of them."""
    return -(-4 * partitions(spark) // GROUPS)


class Packed:
    """Tuples of one or two hashes, with counts, dealt in buckets, a row of blobs for each. A single hash is kept as it is. Of two, the
    first is kept once for each run; both are numbers where they are among `known` ones, and go by them, so that these are kept as
    differences. `heavy` first ones are spread over a group's buckets, so that none is a bucket's whole load; any other's tuples are
    in one bucket, so that it isn't repeated in each."""

    def __init__(self, spread: int, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.spread, self.buckets = spread, GROUPS * spread
        self.top = np.uint64((self.buckets - 1).bit_length())
        self.blobs = 2 if known is None else 6
        if known is not None:
            self.states, self.tokens, self.heavy = Numbers(known[0]), Numbers(known[1]), Table(np.sort(known[2]))

    def within(self, state: np.ndarray, key: np.ndarray) -> np.ndarray:
        return (state >> np.uint64(5)) % np.uint64(GROUPS) * np.uint64(self.spread) + (key >> np.uint64(20)) % np.uint64(self.spread)

    def order(self, arrays: list[np.ndarray]) -> np.ndarray:
        """What equal tuples are brought together by, as far as bits go; what it leaves mixed is summed in the bucket."""
        if len(arrays) == 1:
            return (self.within(arrays[0], arrays[0]) << (np.uint64(64) - self.top)) | (arrays[0] >> self.top)
        return (arrays[0] >> np.uint64(32) << np.uint64(32)) | (arrays[1] >> np.uint64(32))

    def pack(self, arrays: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        """Of tuples in their order."""
        if len(arrays) == 1:
            bucket, (h,) = self.within(arrays[0], arrays[0]).astype(np.int64), arrays
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            some, cut = bucket[starts], list(zip(starts, [*starts[1:], len(h)], strict=True))
            columns = [[h[i:j].tobytes() for i, j in cut]]
        else:
            state, token = arrays
            first = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
            size, one = np.diff(np.append(first, len(state))), state[first]
            number, code = self.states.of(one).astype(np.uint32), self.tokens.of(token).astype(np.uint32)
            rest, low = 64 - int(self.top) - self.states.none.bit_length(), np.uint64(64) - self.top
            last = code >> np.uint32(max(0, self.tokens.none.bit_length() - rest))
            lead = ((one >> np.uint64(5)) % np.uint64(self.buckets) << low) | (number.astype(np.uint64) << np.uint64(rest))
            key, run = np.repeat(lead, size), np.repeat(np.arange(len(one), dtype=np.int32), size)
            heavy = np.flatnonzero(np.repeat(self.heavy.find(one) >= 0, size))
            key[heavy] = (self.within(state[heavy], follow(state[heavy], token[heavy])) << low) | (key[heavy] & ((np.uint64(1) << low) - np.uint64(1)))
            order = np.argsort(key | np.where((number == self.states.none)[run], state >> np.uint64(64 - rest), last))
            bucket, run, code, n = (key[order] >> low).astype(np.int32), run[order], code[order], n[order]
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            some, cut = bucket[starts], list(zip(starts, [*starts[1:], len(bucket)], strict=True))
            new = np.concatenate([[True], (run[1:] != run[:-1]) | (bucket[1:] != bucket[:-1])])
            first = np.flatnonzero(new)
            size, one, number = np.diff(np.append(first, len(bucket))), one[run[first]], number[run[first]]
            step, code_step = number.copy(), code.copy()  # differences modulo 2^32
            step[1:] -= np.where(np.isin(first[1:], starts), 0, number[:-1]).astype(np.uint32)
            code_step[1:] -= np.where(new[1:], 0, code[:-1]).astype(np.uint32)
            runs = list(zip(*(np.searchsorted(first, x) for x in zip(*cut, strict=True)), strict=True))
            columns = [
                [planes(step[p:q]) for p, q in runs],
                [one[p:q][number[p:q] == self.states.none].tobytes() for p, q in runs],
                [planes(size[p:q]) for p, q in runs],
                [planes(code_step[i:j]) for i, j in cut],
                [token[order[i:j][code[i:j] == self.tokens.none]].tobytes() for i, j in cut],
            ]
        columns.append([planes(n[i:j]) for i, j in cut])
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)], names=["bucket", *(f"b{i}" for i in range(self.blobs))])

    def unpack(self, blobs: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        n = from_planes(blobs[-1])
        if self.blobs == 2:
            return [np.frombuffer(blobs[0], np.uint64)], n
        size, code = from_planes(blobs[2]), from_planes(blobs[3])
        state = self.states.back(np.cumsum(from_planes(blobs[0])) & 0xFFFFFFFF, blobs[1])
        first, steps = np.cumsum(size) - size, np.cumsum(code)
        code = (steps - np.repeat(steps[first] - code[first], size)) & 0xFFFFFFFF
        return [np.repeat(state, size), self.tokens.back(code, blobs[4])], n


def counted(docs: DataFrame, columns: list[str], of: Callable, least: int = 1, known: Broadcast | None = None) -> DataFrame:
    """Exact counts of the tuples of one or two hashes that `of` gives for a batch's tokens: `columns`, and `n` from `least` on.

    Tasks count in arrays and deal tuples in buckets, as packed arrays, which are summed by bucket. Of tuples of two, `known` has
    those of each that have numbers and the heavy ones of the first.
    """
    each = spread(docs.sparkSession)

    def summed(arrays: list[np.ndarray], n: np.ndarray, key: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        order = np.argsort(key)
        arrays, n = [a[order] for a in arrays], n[order]
        new = np.ones(len(n), bool)
        new[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in arrays])
        first = np.flatnonzero(new)
        return [a[first] for a in arrays], np.add.reduceat(n, first) if len(first) else n[:0]

    def packing() -> Packed:
        return Packed(each, known.value if known is not None else None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, form = [], 0, packing()

        def merged() -> tuple[list[np.ndarray], np.ndarray]:
            arrays = [np.concatenate(x) for x in zip(*(a for a, _ in held), strict=True)]
            return summed(arrays, np.concatenate([n for _, n in held]), form.order(arrays))

        for whole in batches:
            for batch in slices(whole, "text"):
                arrays = of(*tokens(batch.column("text")))
                held.append((arrays, np.ones(len(arrays[0]), np.int64)))
                size += len(arrays[0])
                if size > FLUSH:
                    one = merged()
                    held, size = [one], len(one[1])
                    if 2 * size > FLUSH:  # little of it repeats
                        yield form.pack(*one)
                        held, size = [], 0
        if size:
            yield form.pack(*merged())

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, form = None, [], packing()

        def settle() -> pa.RecordBatch:
            found = [form.unpack(x) for x in held]
            arrays = [np.concatenate(x) for x in zip(*(a for a, _ in found), strict=True)]
            arrays, n = summed(arrays, np.concatenate([n for _, n in found]), arrays[0] if len(arrays) == 1 else follow(*arrays))
            keep = n >= least
            return pa.RecordBatch.from_arrays([*(pa.array(a[keep].view(np.int64)) for a in arrays), pa.array(n[keep])], names=[*columns, "n"])

        for batch in batches:
            for b, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and held:
                    yield settle()
                    held = []
                bucket = b
                held.append(blobs)
        if held:
            yield settle()

    blobs = docs.mapInArrow(count, "bucket int" + "".join(f", b{i} binary" for i in range(2 if len(columns) == 1 else 6)))
    return blobs.repartition(partitions(docs.sparkSession), "bucket").sortWithinPartitions("bucket").mapInArrow(total, ", ".join(f"{c} bigint" for c in columns) + ", n bigint")


def numbered(states: DataFrame, words: np.ndarray, head: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (state, token): the states and tokens that have numbers, the most frequent ones, and the states that have more than a bucket's
    share of the tokens."""
    low = head_of(states.withColumnRenamed("total", "n"), head, n + 1)
    state, total = gathered(states.filter(F.col("total") >= low), "state", "total")
    order = np.argsort(-total, kind="stable")
    state, total = state.view(np.uint64)[order], total[order]
    return state, words, state[total * (GROUPS * spread(states.sparkSession)) > total.sum()]


def gathered(frame: DataFrame, *columns: str) -> list[np.ndarray]:
    """Columns of a table of bounded size, through Arrow."""
    found = frame.select(*columns).toArrow()
    return [found.column(c).to_numpy() for c in columns]


class Tree:
    """Counts of the training tokens, the heads of the vocabulary and of the weights, and the tables of what the heads leave."""

    def __init__(self, n: int, v: int, words: np.ndarray, counts: np.ndarray):
        self.n, self.v, self.words, self.root = n, v, words, np.log10((counts + 1) / (n + v + 1))
        self.levels: list[tuple[range, DataFrame]] = []  # of each level its retained states, numbered, and the weights by key
        self.bits = np.zeros(1 << (min(FILTER, max(10, n.bit_length() + 1)) - 6), np.uint64)  # candidate contexts
        self.far = self.bits.copy()  # weights outside the head
        self.keys, self.weights = np.zeros(0, np.uint64), np.zeros(0)
        self.tail: DataFrame | None = None


def hashed(frame: DataFrame, of: Callable, columns: str) -> DataFrame:
    """Adds columns of hashes, which `of` makes of a batch's columns by name."""
    new = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = of({c: batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.schema.names if pa.types.is_int64(batch.schema.field(c).type)})
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(a.view(np.int64)) for a in made)], names=[*batch.schema.names, *new])

    return frame.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema) + f", {columns}")


def head_of(table: DataFrame, head: int, none: int) -> int:
    """The least count from which at most `head` rows of a table have theirs: counts are taken in halves of powers of two."""
    steps = table.groupBy(F.floor(2 * F.log2("n")).alias("k")).agg(F.count("*").alias("m"), F.min("n").alias("low")).orderBy(F.desc("k")).collect()
    limit, held = None, 0
    for r in steps:
        if held + r["m"] > head:
            break
        held, limit = held + r["m"], r["low"]
    return limit if limit is not None else none


def sorted_by_key(table: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    keys, values = gathered(table, key, value)
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], values[order]


def probable(grams: DataFrame, states: DataFrame, lower: DataFrame) -> DataFrame:
    """Of rows (state, token, n) those of candidates, with their key and probabilities. `states` has each candidate's number of
    tokens and its suffix, `lower` the probability of (`suffix`, token) in the suffix's longest retained suffix, by the key that
    rows have as `below`."""
    stored = grams.groupBy("state").agg(F.sum("n").alias("stored"), F.count("*").alias("size"))
    states = states.join(stored, "state").withColumn("left", F.greatest(1 - (F.col("stored") - DISCOUNT * F.col("size")) / F.col("total"), F.lit(1e-12)))
    rows = hashed(grams.join(states, "state"), lambda c: [follow(c["state"], c["token"]), follow(c["suffix"], c["token"])], "gram bigint, above bigint")
    rows = rows.withColumn("below", F.col("token") if "word" in lower.columns else F.col("above")).join(lower.withColumnRenamed("word", "below"), "below")
    return rows.drop("below", "above").withColumn("p", (F.col("n") - DISCOUNT) / F.col("total") + F.col("left") * F.col("lower"))


def retained(rows: DataFrame, bits: float) -> DataFrame:
    """States that pass the divergence test: (state, total, left)."""
    one = [F.first(c).alias(c) for c in ("total", "left", "stored", "size")]
    of = rows.groupBy("state").agg(F.sum(F.col("n") * F.log2(F.col("p") / F.col("lower"))).alias("gain"), *one)
    gain = F.col("gain") + (F.col("total") - F.col("stored")) * F.log2("left")
    return of.filter(gain > bits * (1 + F.col("size"))).select("state", "total", "left")


def learn(docs: DataFrame, scratch: Scratch, depth: int | None = None, least: int = LEAST, bits: float = BITS, head: int = HEAD, heavy: int = HEAVY) -> tuple[Tree, DataFrame, int]:
    """The tree, the table of word counts (h, n), and the limit from which words are in the tree's head."""
    if depth is not None and depth < 0:
        raise ValueError("a depth of nothing or more")
    spark = docs.sparkSession
    words = scratch.write(counted(docs, ["h"], lambda h, n: [h]), "words")
    scratch.release()
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    limit = head_of(words, head, n + 1)
    tree = Tree(n, v, *sorted_by_key(words.filter(F.col("n") >= limit), "h", "n"))
    follow_of = max(1, least // FOLLOW)
    often = (F.col("n") >= least) & (F.col("token") != int(END))
    first = words.select(F.col("h").alias("token"), F.col("n").alias("total")).filter((F.col("total") >= least) & (F.col("token") != int(END)))
    start = lambda c: [longer(np.full(len(c["token"]), SEED, np.uint64), c["token"]), np.full(len(c["token"]), SEED, np.uint64)]
    states = scratch.write(hashed(first, start, "state bigint, suffix bigint").select("state", "total", "suffix"), "states-1")
    lower = words.filter(F.col("n") >= follow_of).select(F.col("h").alias("word"), ((F.col("n") + 1) / float(n + v + 1)).alias("lower"))
    enough, often_words = (words.filter(F.col("n") >= follow_of), "h"), tree.words[np.argsort(-tree.root, kind="stable")]
    level = 0
    while level != depth:
        level += 1
        tree.bits = added(tree.bits, states, "state")
        table = spark.sparkContext.broadcast(tree.bits)
        if level > 2 and (level - 1) & (level - 2) == 0:  # levels 3, 5, 9, ...: from there on only these runs are read
            docs = scratch.write(runs(docs, table, level), f"runs-{level}")
            if level > 3:
                scratch.drop(f"runs-{(level - 1) // 2 + 1}")

        asked = spark.sparkContext.broadcast(added(np.zeros_like(tree.bits), *enough))
        known = spark.sparkContext.broadcast(numbered(states, often_words, head, n))

        def rows(h: np.ndarray, n: np.ndarray, level=level, table=table, asked=asked) -> list[np.ndarray]:
            # a successor is seen often enough only where it is after the suffix, too: others aren't counted
            often = among(asked.value, h) if level == 1 else np.zeros(len(h), bool)
            for k, (at, key) in enumerate(chain(h, n, table.value, level), 1):
                if k == level - 1:
                    often[at] = among(asked.value, follow(key, h[at]))
            keep = often[at]
            return [key[keep], h[at[keep]]]

        grams = scratch.write(counted(docs, ["state", "token"], rows, follow_of, known), f"grams-{level}")
        for sent in (table, asked, known):  # on the disk of each executor till then
            sent.destroy()
        scratch.release()
        made = scratch.write(probable(grams, states, lower), f"level-{level}")
        scratch.drop(f"grams-{level}")
        scratch.drop(f"states-{level}")
        scratch.release()
        kept = scratch.write(retained(made, bits), f"kept-{level}")
        stored = made.join(kept.select("state"), "state", "left_semi")
        weights = kept.select(F.col("state").alias("key"), F.col("total").alias("n"), F.log10("left").alias("w"))
        weights = weights.unionByName(stored.select(F.col("gram").alias("key"), "n", (F.log10("p") - F.log10("lower") - F.log10("left")).alias("w")))
        count = kept.count()
        tree.levels.append((range(count), weights))
        if not count or level == depth:
            break
        longest = lambda c: [longer(c["state"], c["token"]), longer(c["suffix"], c["token"])]
        further = hashed(made.filter(often).select("state", "token", "n", "suffix"), longest, "next bigint, shorter bigint")
        further = further.join(kept.select(F.col("state").alias("shorter")), "shorter", "left_semi")
        states = scratch.write(further.select(F.col("next").alias("state"), F.col("n").alias("total"), F.col("shorter").alias("suffix")), f"states-{level + 1}")
        if states.isEmpty():
            break
        lower = stored.select(F.col("gram").alias("below"), F.col("p").alias("lower"))
        enough = stored, "gram"
    while tree.levels and not tree.levels[-1][0] and depth is None:
        tree.levels.pop()
    if tree.levels:
        each = [weights.withColumn("level", F.lit(i)) for i, (_, weights) in enumerate(tree.levels)]
        every = scratch.write(reduce(DataFrame.unionByName, each), "weights")
        tree.levels = [(states, every.filter(F.col("level") == i).drop("level")) for i, (states, _) in enumerate(tree.levels)]
        low = head_of(every, heavy, n + 1)
        tree.keys, tree.weights = sorted_by_key(every.filter(F.col("n") >= low), "key", "w")
        tree.tail = every.filter(F.col("n") < low)
        tree.far = added(tree.far, tree.tail, "key")
    for k in range(1, level + 2):  # all that scoring reads are the words and the weights
        for name in ("states", "level", "kept", "runs"):
            scratch.drop(f"{name}-{k}")
    scratch.release()
    return tree, words, limit


def by_row(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (row, key) once, by row: its row, its key, how often it stands there."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])) if len(key) else np.zeros(0, np.int64)
    return owner[first], key[first], np.diff(np.append(first, len(key)))


def score(docs: DataFrame, tree: Tree, words: DataFrame, limit: int, scratch: Scratch) -> DataFrame:
    """Of each row of (text, ...): its tokens, known ones, base score and score; columns but the text and those stay."""
    spark = docs.sparkSession
    depth = len(tree.levels)
    shared = spark.sparkContext.broadcast((tree.words, tree.root, tree.keys, tree.weights, tree.bits, tree.far))
    names = [c for c in docs.columns if c.lower() not in ("text", *RESULTS)]
    kept = [f"kept_{i}" for i in range(len(names))]  # names of their own, whatever the input's are
    docs = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, kept, strict=True)), "text")
    extra = {"row": pa.int64(), "n_tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "more": pa.float64()}

    def listed(owner: np.ndarray, key: np.ndarray, rows: int) -> pa.ListArray:
        """Of each row its keys, each once, with how often it stands there."""
        own, keys, n = by_row(owner, key)
        cut = np.searchsorted(own, np.arange(rows + 1))
        struct = pa.StructArray.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["h", "m"])
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, root, keys, weights, bits, beyond), number = shared.value, TaskContext.get().partitionId() << 36
        words, table = Table(words), Table(keys)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 19):
                h, n = tokens(batch.column("text"))
                rows, owner = len(n), np.repeat(np.arange(len(n)), n)
                at = words.find(h)
                head = at >= 0
                base = np.where(head, root[at] if len(root) else 0.0, 0.0)
                more, rest = np.zeros(rows), []
                for place, key in chain(h, n, bits, depth):
                    for one in (key, follow(key, h[place])):
                        at = table.find(one)
                        here = at >= 0
                        more += np.bincount(owner[place[here]], weights[at[here]], rows)
                        here = ~here & among(beyond, one)
                        rest.append((owner[place[here]], one[here]))
                sums = [np.bincount(owner, x, rows) for x in (head, base)]
                numbers = number + np.arange(rows)
                number += rows
                far = [np.concatenate(x) for x in zip(*rest, strict=True)] if rest else [owner[:0], h[:0]]
                cols = [pa.array(numbers), pa.array(n, pa.int64()), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(more), listed(owner[~head], h[~head], rows), listed(*far, rows)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *cols], names=[*kept, *extra, "rare", "far"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    bag = "array<struct<h:bigint,m:bigint>>"
    part = scratch.write(docs.select(*kept, "text").mapInArrow(run, f"{schema}, row bigint, n_tokens bigint, known bigint, base double, more double, rare {bag}, far {bag}"), "scored")
    shared.destroy()

    def exploded(column: str) -> DataFrame:
        return part.select("row", F.explode(column).alias("r")).select("row", F.col("r.h").alias("h"), F.col("r.m").alias("m"))

    log = F.log10((F.coalesce("n", F.lit(0)) + 1) / float(tree.n + tree.v + 1))
    zero = F.lit(0.0)
    rare = exploded("rare").join(words.filter(F.col("n") < limit), "h", "left").select("row", F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0).alias("known2"), (F.col("m") * log).alias("base2"), zero.alias("more2"))
    if tree.tail is not None:
        far = exploded("far").join(tree.tail.select(F.col("key").alias("h"), "w"), "h")
        rare = rare.unionByName(far.select("row", F.lit(0).cast("long").alias("known2"), zero.alias("base2"), (F.col("m") * F.col("w")).alias("more2")))
    sums = rare.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("known2", "base2", "more2")))
    base = F.col("base") + F.coalesce("base2", zero)
    return part.join(sums, "row", "left").select(
        *(F.col(k).alias(c) for c, k in zip(names, kept, strict=True)), "n_tokens", (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"), F.lit(tree.n).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("more") + F.coalesce("more2", zero)).alias("score")
    )
