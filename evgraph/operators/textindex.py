"""A written positional index of a text column, kept in step by batches of changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import search_tokens
from ..plans.versions import Versions

#: Buckets of a segment by token, parts of a bucket by key, and segments beyond which a batch compacts.
BUCKETS, SALTS, SEGMENTS = 32, 8, 8
#: Bytes of words that become blocks at once, what a text counts beside them, keys that a broadcast may hold, and what files look like.
BLOCK, TEXT, BROADCAST, LAYOUT = 16 << 20, 256, 1_000_000, 2


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _moved(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in runs of about BLOCK bytes of words, so of BLOCK / TEXT rows at most; one longer text is a run of its own."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("words")).to_numpy(zero_copy_only=False) + TEXT, dtype=np.int64)
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + (not held), int(np.searchsorted(ends, base + BLOCK - size, "right")))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1] - base)
                start = stop
            if start < len(ends) or size >= BLOCK:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of texts (key, words with a space between them, size), a row for each token of a run of texts."""
    for run in _runs(batches):
        run = run.sort_by("key").combine_chunks()
        key, size = run["key"].combine_chunks(), run["size"].to_numpy()
        token = pc.split_pattern(run["words"], " ").combine_chunks().flatten().dictionary_encode()
        text = np.repeat(np.arange(len(size)), size)
        position = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        order = np.sort((token.indices.to_numpy().astype(np.int64) << 32) | np.arange(len(text)))
        code, order = order >> 32, order & 0xFFFFFFFF
        text, position = text[order], position[order].astype(np.int32)
        posting = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (text[1:] != text[:-1])])  # where each posting begins
        group = np.flatnonzero(np.r_[True, code[posting][1:] != code[posting][:-1]])  # where each token begins among postings
        start = posting[group]
        per = np.diff(np.r_[group, len(posting)])
        ends = (np.r_[posting[1:], len(text)] - np.repeat(start, per)).astype(np.int32)
        listed = lambda values, at, of: pa.ListArray.from_arrays(pa.array(np.r_[at, len(of)].astype(np.int32)), values)
        yield pa.RecordBatch.from_arrays(
            [token.dictionary.take(pa.array(code[start])), listed(key.take(pa.array(text[posting])), group, posting), listed(pa.array(size[text[posting]].astype(np.int32)), group, posting), listed(pa.array(ends), group, posting), listed(pa.array(position), start, text)],
            ["token", "keys", "sizes", "ends", "positions"],
        )


class TextIndex:
    """An inverted index as versions of segments.

    A segment holds postings (token, key, positions, size) in folders by a hash of the token, sorted by token, so that a search reads
    the folders of its words and of those the row groups that hold them; the number of documents of each token; the documents with
    their sizes; and the keys of earlier segments that it takes away. A posting counts if no later segment takes its key away. Each
    batch of changes is one segment, and one version; compaction writes the live postings as one segment.

    Texts become postings where they are read, so no text is shuffled, and postings of a token are a row for each run of texts: its
    keys, their sizes, and all positions with where each key's end. Rows of a frequent token are dealt over tasks.

    A null or blank text is a document without tokens; a row without a key isn't indexed. Rows of one key in a batch are one
    change: the greatest text, if any of them has one, else a removal.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.store = spark, Versions(spark, root)
        self.version = self.store.latest() if version is None else version
        self.manifest = self.store.manifest(self.version)

    @property
    def exists(self) -> bool:
        return bool(self.manifest)

    # ------------------------------------------------------------ writing

    @classmethod
    def build(cls, spark: SparkSession, root: str, frame: DataFrame, key: str, text: Column, buckets: int = BUCKETS) -> TextIndex:
        """A first version over all rows of a table."""
        empty = cls(spark, root, 0)
        rows = empty._single(frame.select(F.col(key).alias("key"), text.cast("string").alias("text")).filter("key IS NOT NULL"))
        empty.manifest = {"layout": LAYOUT, "buckets": buckets, "key": rows.schema["key"].dataType.simpleString(), "segments": [], "documents": 0, "tokens": 0}
        return empty._publish(rows, None)

    def apply(self, changes: DataFrame, most: int = SEGMENTS) -> TextIndex:
        """The version after a batch of changes (key, text, gone): rows to insert or replace, and keys to take away."""
        if not self.exists:
            raise ValueError("no index has been built here")
        kind = self.manifest["key"]
        text = F.when(F.coalesce("gone", F.lit(False)), None).otherwise(F.coalesce("text", F.lit("")))
        batch = self._single(changes.filter("key IS NOT NULL").select(F.col("key").cast(kind).alias("key"), text.alias("text")))
        after = self._publish(batch.filter("text IS NOT NULL"), batch.select("key"))
        return after.compact() if len(after.manifest["segments"]) > most else after

    def compact(self) -> TextIndex:
        """A version of one segment with what counts of all."""
        store, name, seq = self.store, self.store.stage(), max(s["seq"] for s in self.manifest["segments"]) + 1
        each = self.postings().select("token", F.array("key").alias("keys"), F.array(F.col("size").cast("int")).alias("sizes"), F.array(F.size("positions")).alias("ends"), "positions")
        self._write(name, each, self.documents().select("key", "size"), None)
        return self._next({**self.manifest, "segments": [{"name": name, "seq": seq, "gone": 0}]}, store)

    def _single(self, rows: DataFrame) -> DataFrame:
        """Rows (key, text) with the greatest text of each key. Only texts of keys that come twice are grouped."""
        twice = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
        if twice.isEmpty():
            return rows
        name = f"{self.store.stage()}/twice"
        self.store.write(twice, name)
        twice = self.store.read(name)
        return rows.join(twice, "key", "left_anti").unionByName(rows.join(twice, "key", "left_semi").groupBy("key").agg(F.max("text").alias("text")))

    def _publish(self, rows: DataFrame, touched: DataFrame | None) -> TextIndex:
        store, name = self.store, self.store.stage()
        words = rows.select("key", search_tokens(F.coalesce("text", F.lit(""))).alias("w")).select("key", "w", F.size("w").cast("long").alias("size"))
        held = words.filter("size > 0").select("key", F.array_join("w", " ").alias("words"), "size")
        postings = held.mapInArrow(_blocks, f"token string, {self._lists()}")
        before = self.documents().join(touched, "key", "left_semi") if touched is not None else None
        self._write(name, postings, words.select("key", "size"), before.select("key", "size") if before is not None else None)
        total = lambda part: store.read(f"{name}/{part}").agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
        added, lost = total("documents"), total("gone") if before is not None else None
        seq = max((s["seq"] for s in self.manifest["segments"]), default=0) + 1
        sums = {"documents": self.manifest["documents"] + added["n"] - (lost["n"] if lost else 0), "tokens": self.manifest["tokens"] + added["size"] - (lost["size"] if lost else 0)}
        return self._next({**self.manifest, **sums, "segments": [*self.manifest["segments"], {"name": name, "seq": seq, "gone": lost["n"] if lost else 0}]}, store)

    def _write(self, name: str, postings: DataFrame, documents: DataFrame, gone: DataFrame | None) -> None:
        first = F.col("keys")[0]
        placed = postings.select(_bucket(F.col("token"), self.manifest["buckets"]).alias("bucket"), "token", first.alias("key"), "keys", "sizes", "ends", "positions")
        dealt = placed.repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(SALTS))).sortWithinPartitions("bucket", "token", "key").drop("key")
        self.store.write(dealt, f"{name}/postings", "bucket")
        self.store.write(documents, f"{name}/documents")
        schema = self._schema()
        self.store.write(self.store.read(f"{name}/postings", schema).groupBy("bucket", "token").agg(F.sum(F.size("keys")).alias("df")).select("token", "df").sortWithinPartitions("token"), f"{name}/tokens")
        if gone is not None:
            self.store.write(gone, f"{name}/gone")

    def _next(self, manifest: dict, store: Versions) -> TextIndex:
        return TextIndex(self.spark, store.root, store.publish(manifest, self.version))

    # ------------------------------------------------------------ reading

    def _lists(self) -> str:
        return f"keys array<{self.manifest['key']}>, sizes array<int>, ends array<int>, positions array<int>"

    def _schema(self) -> str:
        if self.manifest.get("layout") != LAYOUT:
            raise ValueError("this index is of another layout: build it anew")
        return f"token string, {self._lists()}, bucket int"

    def _union(self, part: str, schema: str, keep=lambda f: f) -> DataFrame:
        found = [keep(self.store.read(f"{s['name']}/{part}", schema)).withColumn("seq", F.lit(s["seq"])) for s in self.manifest["segments"] if part != "gone" or s["gone"]]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], f"{schema}, seq int")

    def _live(self, rows: DataFrame) -> DataFrame:
        """Rows of segments that a later one takes from are held against the keys that it takes; the others count as they are. The
        keys are broadcast where they are few, else hashed, so that no row is sorted for it."""
        gone = [s for s in self.manifest["segments"] if s["gone"]]
        if not gone:
            return rows
        last = max(s["seq"] for s in gone)
        until = self._union("gone", f"key {self.manifest['key']}, size long").groupBy("key").agg(F.max("seq").alias("_until"))
        until = until.hint("broadcast" if sum(s["gone"] for s in gone) <= BROADCAST else "shuffle_hash")
        old = rows.filter(F.col("seq") < last).join(until, "key", "left").filter("_until IS NULL OR seq >= _until").drop("_until")
        return old.unionByName(rows.filter(F.col("seq") >= last))

    def documents(self) -> DataFrame:
        """(key, size, seq) of all indexed rows."""
        return self._live(self._union("documents", f"key {self.manifest['key']}, size long"))

    def _each(self, tokens: list[str] | None, name: str, value: Callable[[Column, Column], Column]) -> DataFrame:
        """What counts of some tokens or all, a row for each key of a token; `value` gets where its positions begin and how many they are.

        The lists of a row become one list of what its keys have, so that no key's row bears the lists of all while it waits."""

        def keep(frame: DataFrame) -> DataFrame:
            if tokens is not None:
                buckets = [r["b"] for r in self.spark.createDataFrame([(t,) for t in tokens], "t string").select(_bucket(F.col("t"), self.manifest["buckets"]).alias("b")).distinct().collect()]
                frame = frame.filter(F.col("bucket").isin(buckets) & F.col("token").isin(tokens))
            return frame.drop("bucket")

        def one(key: Column, i: Column) -> Column:
            begin = F.when(i == 0, 0).otherwise(F.get("ends", i - 1))
            return F.struct(key.alias("key"), value(begin, F.get("ends", i) - begin).alias(name), F.get("sizes", i).cast("long").alias("size"))

        return self._live(self._union("postings", self._schema(), keep).select("token", F.inline(F.transform("keys", one)), "seq"))

    def postings(self, tokens: list[str] | None = None) -> DataFrame:
        """(token, key, positions, size, seq) that count, of some tokens or all."""
        return self._each(tokens, "positions", lambda begin, n: F.slice("positions", begin + 1, n))

    def counts(self, tokens: list[str] | None = None) -> DataFrame:
        """(token, key, n, size, seq): how often a key has a token, without reading where."""
        return self._each(tokens, "n", lambda _, n: n)

    def words(self, phrase: str) -> list[str]:
        return self.spark.range(1).select(search_tokens(F.lit(phrase)).alias("w")).first()["w"]

    def frequencies(self, tokens: list[str]) -> dict[str, int]:
        """Postings of some tokens in all segments, those that no longer count too: an order for joins, and 0 for what no row has."""
        rows = self._union("tokens", "token string, df long", lambda f: f.filter(F.col("token").isin(tokens))).groupBy("token").agg(F.sum("df").alias("df")).collect()
        return dict.fromkeys(tokens, 0) | {r["token"]: r["df"] for r in rows}

    def phrase(self, words: str) -> DataFrame:
        """(key, n, size) of rows that hold the words one after another, n times. Positions of the rarest word come first, then of the
        next, each moved to where the phrase begins."""
        tokens = self.words(words)
        none = self.spark.createDataFrame([], f"key {self.manifest['key']}, n int, size long")
        df = self.frequencies(list(dict.fromkeys(tokens)))
        if not tokens or not all(df.values()):
            return none
        found = None
        for i in sorted(range(len(tokens)), key=lambda i: (df[tokens[i]], i)):
            rows = self.postings([tokens[i]]).select("key", _moved(F.col("positions"), i).alias("_at"), "size")
            if found is None:
                found = rows.withColumnRenamed("_at", "at")
            else:
                found = found.join(rows.drop("size"), "key").select("key", F.array_intersect("at", "_at").alias("at"), "size").filter(F.size("at") > 0)
        return found.select("key", F.size("at").alias("n"), "size")

    def _scored(self, hits: DataFrame, df: Column, k1: float, b: float) -> Column:
        n, mean = self.manifest["documents"], self.manifest["tokens"] / max(1, self.manifest["documents"])
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        return idf * F.col("n") * (k1 + 1) / (F.col("n") + k1 * (1 - b + b * F.col("size") / max(mean, 1e-9)))

    def ranked_phrase(self, words: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(key, score) of rows that hold a phrase, by BM25 of the phrase as one term."""
        hits = self.phrase(words)
        counted = hits.crossJoin(hits.agg(F.count("*").alias("df")))  # one row
        return counted.select("key", self._scored(counted, F.col("df"), k1, b).alias("score"))

    def relevance(self, words: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(key, score) of rows that hold any of the words, by BM25."""
        tokens = list(dict.fromkeys(self.words(words)))
        hits = self.counts(tokens).select("token", "key", "n", "size")
        both = hits.join(hits.groupBy("token").agg(F.count("*").alias("df")), "token")
        return both.groupBy("key").agg(F.sum(self._scored(both, F.col("df"), k1, b)).alias("score"))
