"""Byte-level BPE encoding and decoding in overlapping chunks.

Every text of more than one chunk is cut into chunks that overlap. Chunks are pre-tokenised each from its own start. The pattern
looks only ahead, so where two neighbouring chunks share a pre-token boundary inside their overlap they agree from there on: the text
is stitched at that boundary, and the pieces between stitches are encoded and their ids joined in order. Where a seam doesn't
resynchronise (a run longer than the overlap), the text is encoded as one piece. Within a task chunks are small and follow one
another; a text of more than SPREAD code points is first cut in the same way into larger ones, which are dealt over tasks.

Null and empty texts have no ids; repeated rows are told apart by a row key of their own; ties don't arise; an empty table gives an
empty result; columns other than the id and the text are ignored, whatever their names. A null doc_id stays null.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, slices

#: Code points of a chunk and of its overlap with the next, within a task; texts of more than SPREAD are dealt over tasks.
CHUNK, OVERLAP = 4_096, 256
SPREAD, SPREAD_OVERLAP = 32_768, 1_024
#: What a boundary near a chunk's end may still depend on.
MARGIN = 4

_codecs: dict[str, "Codec"] = {}


class Codec:
    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        path = name if "/" in name else public_tokenizers.path(name)
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
        self.encode = lambda text: encode(text, disallowed_special=())
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.pattern = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]

    def pieces(self, text: str, chunk: int, overlap: int) -> list[str]:
        """A text cut where the boundaries of overlapping chunks, each pre-tokenised from its own start, meet. From a common boundary
        on, two chunks agree, so each piece starts and ends at boundaries of the whole text; where some don't meet, it stays whole."""
        if len(text) <= chunk + overlap:
            return [text]
        seams, tail = [0], None
        for start in range(0, len(text) - overlap, chunk):
            body = text[start : start + chunk + overlap]
            found = self.boundaries(body)
            if tail is not None:
                seam = next((start + b for b in found if b < overlap and start + b in tail), None)
                if seam is None:
                    return [text]
                seams.append(seam)
            tail = {start + b for b in found[bisect_left(found, len(body) - overlap) :] if b <= len(body) - MARGIN}
        return [text[a:b] for a, b in zip(seams, [*seams[1:], len(text)], strict=True)]

    def encode_in_chunks(self, text: str, chunk: int, overlap: int) -> np.ndarray:
        pieces = self.pieces(text, chunk, overlap)
        return self.encode(text) if len(pieces) == 1 else np.concatenate([self.encode(x) for x in pieces])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(name: str) -> Codec:
    """One codec for each Python worker."""
    if name not in _codecs:
        _codecs[name] = Codec(name)
    return _codecs[name]


def _encoded(frame: DataFrame, ranks: str, keys: str, raw: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Ids of each row's text in the text's place; with `raw`, also the bytes that they decode to."""
    names = [k.split()[0] for k in keys.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks)
        none = np.zeros(0, np.uint32)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                ids = [own.encode_in_chunks(t, chunk, overlap) if t else none for t in batch.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, ids)])
                cols = [batch.column(n) for n in names] + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([none, *ids]).astype(np.int32)))]
                if raw:
                    cols.append(pa.array([own.decode(x.tolist()) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "ids", "raw"][: len(cols)])

    return frame.select(*names, "text").mapInArrow(run, f"{keys}, ids array<int>" + ", raw binary" * raw)


def _edges(frame: DataFrame, ranks: str, overlap: int) -> DataFrame:
    """Adds the boundaries of a chunk in its first and in its last `overlap` code points, from the text's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = codec(ranks).boundaries
        for batch in batches:
            head, tail = [], []
            for text, start, last in zip(batch.column("text").to_pylist(), batch.column("start").to_pylist(), batch.column("last").to_pylist(), strict=True):
                found = at(text)
                head.append([start + b for b in found if b < overlap])
                tail.append([start + b for b in found if len(text) - overlap <= b <= len(text) - MARGIN] if not last else [])
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in batch.schema.names] + [pa.array(x, pa.list_(pa.int64())) for x in (head, tail)], names=[*batch.schema.names, "head", "tail"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
    return frame.mapInArrow(run, f"{schema}, head array<bigint>, tail array<bigint>")


def _long(base: DataFrame, ranks: str, chunk: int, overlap: int) -> DataFrame:
    # a long row's key: rows of equal id and text are the same work, done once and dealt back by their number
    long = base.filter(F.length("text") > chunk).groupBy("doc_id", F.sha2("text", 256).alias("row")).agg(F.first("text").alias("text"), F.count("*").alias("copies"), F.length(F.first("text")).alias("n"))
    starts = F.sequence(F.lit(0).cast("long"), (F.col("n") - overlap - 1).cast("long"), F.lit(chunk).cast("long"))
    cut = long.select("doc_id", "row", "copies", "n", "text", F.posexplode(starts).alias("k", "start"))
    cut = cut.select("doc_id", "row", "copies", "k", "start", (F.col("start") + chunk + overlap >= F.col("n")).alias("last"), F.expr(f"substring(text, cast(start + 1 as int), {chunk + overlap})").alias("text"))
    ordered = Window.partitionBy("doc_id", "row").orderBy("k")
    seams = _edges(cut.repartition("doc_id", "row", "k"), ranks, overlap)
    seams = seams.withColumn("seam", F.array_min(F.array_intersect("tail", F.lead("head").over(ordered)))).withColumn("from", F.lag("seam").over(ordered))
    bad = F.max(~F.col("last") & F.col("seam").isNull()).over(Window.partitionBy("doc_id", "row"))
    seams = seams.withColumn("bad", bad)
    # the piece runs from the seam before to the seam after; both lie in this chunk's text
    begin = F.coalesce(F.col("from"), F.lit(0))
    end = F.when(F.col("last"), F.col("start") + F.length("text")).otherwise(F.col("seam"))
    piece = F.expr("substring(text, cast(begin - start + 1 as int), cast(end - begin as int))")
    own = seams.withColumns({"begin": begin, "end": end}).select("doc_id", "row", "copies", "k", F.when(F.col("bad"), F.expr(f"CASE WHEN last THEN text ELSE substring(text, 1, {chunk}) END")).otherwise(piece).alias("text"), "bad")
    good = own.filter(~F.col("bad")).select("doc_id", "row", "copies", "k", "text")
    joined = own.filter("bad").groupBy("doc_id", "row", "copies").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "").alias("text"))
    pieces = good.unionByName(joined.withColumn("k", F.lit(0)))
    ids = _encoded(pieces.repartition("doc_id", "row", "k"), ranks, "doc_id bigint, row string, copies bigint, k int")
    back = ids.groupBy("doc_id", "row", "copies").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    return back.select("doc_id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "ids")


def _split(docs: DataFrame, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    if not 2 * overlap < chunk:
        raise ValueError("chunks must be longer than two overlaps")
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return base.filter(F.coalesce(F.length("text"), F.lit(0)) <= chunk), base


def encode(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", chunk: int = SPREAD, overlap: int = SPREAD_OVERLAP) -> DataFrame:
    """doc_id and ids of each row's text, as the library would encode the whole text."""
    short, base = _split(docs, chunk, overlap)
    return _encoded(short, ranks, "doc_id bigint").unionByName(_long(base, ranks, chunk, overlap))


def round_trip(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", chunk: int = SPREAD, overlap: int = SPREAD_OVERLAP) -> DataFrame:
    """`decode` of `encode`; texts that aren't dealt over tasks take both steps in one pass."""
    short, base = _split(docs, chunk, overlap)
    return _encoded(short, ranks, "doc_id bigint", True).unionByName(decode(_long(base, ranks, chunk, overlap), ranks))


def decode(tokens: DataFrame, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Adds the raw bytes of the ids; those of a whole text are its UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(ranks).bytes_of.__getitem__
        for batch in batches:
            ids = batch.column("ids")
            for a in range(0, batch.num_rows, 500):
                raw = [b"".join(map(of, x)) for x in ids.slice(a, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(a, 500) for n in ("doc_id", "ids")), pa.array(raw, pa.binary())], names=["doc_id", "ids", "raw"])

    return tokens.mapInArrow(run, "doc_id bigint, ids array<int>, raw binary")


def digest(decoded: DataFrame) -> DataFrame:
    """Numbers and SHA-256 digests of the ids (as decimals joined by one space) and of the decoded bytes."""
    said = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))
