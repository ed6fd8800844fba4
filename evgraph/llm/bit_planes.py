"""Token-id files: blocks of ids transposed into bit planes, each plane compressed with zstandard, behind a chunk index.

A file is `BPL1`, a header (plane kind, ids per block, number of ids, number of blocks), the chunk index (for each block: its
place, its number of ids, and the compressed size of each plane; a size of 0 stands for a plane of zeros) and the planes. Any
block can be read alone. A shard is a file together with the row index of the documents whose ids it holds.

Shards are stored as rows of a Parquet table in the shared folder, since executors can write whole files to any store that
Spark reaches only through Spark's committer; `export` copies their contents into plain files.

Order: documents by ascending doc_id. Ranges of doc_id become buckets, of which there are no more than shuffle partitions;
one task writes a bucket's shards in order, so only a total for each bucket is summed in one place.

Null and empty texts give the end id alone. Rows that share a doc_id keep their number and stand side by side, ordered by
their ids' bytes; a null doc_id comes first. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, encoder, partitions, slices

MAGIC = b"BPL1"
BLOCK = 65_536
SHARD_IDS = 1 << 20
PLANES = {"bit": 32, "byte": 4}


def write_planes(ids: np.ndarray, kind: str = "bit", block: int = BLOCK, level: int = 3) -> bytes:
    """A file of unsigned 32-bit ids."""
    ids, n_planes, press = ids.astype("<u4", copy=False), PLANES[kind], zstandard.ZstdCompressor(level=level).compress
    blocks = [ids[i : i + block] for i in range(0, len(ids), block)]
    index, data, at = [], [], 0
    for part in blocks:
        top = int(part.max()).bit_length()
        planes = []
        for p in range(n_planes):
            if kind == "bit":
                raw = np.packbits(((part >> np.uint32(p)) & np.uint32(1)).astype(np.uint8)) if p < top else None
            else:
                raw = ((part >> np.uint32(8 * p)) & np.uint32(255)).astype(np.uint8) if 8 * p < top else None
            planes.append(press(raw.tobytes()) if raw is not None else b"")
        index.append(struct.pack(f"<QI{n_planes}I", at, len(part), *map(len, planes)))
        data += planes
        at += sum(map(len, planes))
    return b"".join([MAGIC, struct.pack("<BIQI", n_planes, block, len(ids), len(blocks)), *index, *data])


def read_planes(file: bytes, blocks: range | None = None) -> np.ndarray:
    """All ids of a file, or those of some of its blocks."""
    if file[:4] != MAGIC:
        raise ValueError("not a bit-plane file")
    n_planes, _, _, n_blocks = struct.unpack_from("<BIQI", file, 4)
    entry, first = struct.Struct(f"<QI{n_planes}I"), 4 + struct.calcsize("<BIQI")
    data, grow, out = first + entry.size * n_blocks, zstandard.ZstdDecompressor().decompress, []
    for b in blocks if blocks is not None else range(n_blocks):
        at, n, *sizes = entry.unpack_from(file, first + b * entry.size)
        ids, at = np.zeros(n, np.uint32), data + at
        for p, size in enumerate(sizes):
            if size:
                raw = np.frombuffer(grow(file[at : at + size]), np.uint8)
                ids |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(p) if n_planes == 32 else raw.astype(np.uint32) << np.uint32(8 * p)
                at += size
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def encode(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """doc_id, its ids (little-endian) with the end id last, and how many bytes wide an id is: two where all ids fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, path=path)
        for whole in batches:
            for batch in slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), own.documents(batch.column("text"), end_id).cast(pa.binary()), pa.array(np.full(batch.num_rows, own.kind.itemsize, np.int8))], names=["doc_id", "ids", "width"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, ids binary, width tinyint")


def id_bounds(docs: DataFrame, n: int, column: str = "doc_id") -> list[int]:
    """At most n - 1 ascending ids that split the rows into ranges of about equal numbers; from the id column alone."""
    found = docs.select(F.percentile_approx(F.col(column), [i / n for i in range(1, n)], min(20 * n, 1_000_000)).alias("b")).first()["b"] if n > 1 else None
    return sorted(set(found or []))


def bucket_of(column: str, bounds: list[int]):
    """The number of bounds that an id isn't below, by binary search in a literal array; nulls come first."""
    if not bounds:
        return F.lit(0)
    known, id_ = F.lit(np.array(bounds, np.int64)), F.col(column)
    powers = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    found = F.aggregate(powers, F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & (F.get(known, at + step - 1) <= id_), at + step).otherwise(at))
    return F.when(id_.isNull(), F.lit(0)).otherwise(found)


def write_shards(tokens: DataFrame, scratch: Scratch, bounds: list[int], kind: str = "bit", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes (doc_id, ids, width) as shards: bucket, shard, first id's place in the bucket, ids, docs' row index, file."""
    spark = scratch.spark
    names = {"bucket": pa.int32(), "shard": pa.int64(), "place": pa.int64(), "n_ids": pa.int64(), "docs": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "file": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"bucket": None, "shard": 0, "place": 0}
        docs, ids, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, ids, held
            array = np.concatenate(ids)
            row = [state["bucket"], state["shard"], state["place"], len(array), docs, list(map(len, ids)), write_planes(array, kind)]
            state["shard"] += 1
            state["place"] += len(array)
            docs, ids, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, names.values(), strict=True)], names=list(names))

        for batch in batches:
            for bucket, doc, x, w in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "ids", "width")), strict=True):
                if bucket != state["bucket"] or held > shard_ids:
                    if docs:
                        yield flush()
                    if bucket != state["bucket"]:
                        state |= {"bucket": bucket, "shard": 0, "place": 0}
                docs.append(doc)
                ids.append(np.frombuffer(x, f"<u{w}"))
                held += len(ids[-1])
        if docs:
            yield flush()

    n = partitions(spark)
    dealt = tokens.withColumn("bucket", bucket_of("doc_id", bounds)).repartition(n, "bucket").sortWithinPartitions("bucket", "doc_id", "ids")
    return scratch.write(dealt.mapInArrow(run, "bucket int, shard bigint, place bigint, n_ids bigint, docs array<bigint>, sizes array<bigint>, file binary"), "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), ids."""
    totals = shards.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    # a row for each bucket, of which there are no more than shuffle partitions: small enough for one window and a broadcast
    bases = totals.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(whole.num_rows):
                row = {n: whole.column(n)[i].as_py() for n in whole.schema.names}
                ids, ends = read_planes(row["file"]).astype("<u4"), np.cumsum(np.array(row["sizes"], np.int64))
                starts = ends - np.array(row["sizes"], np.int64)
                for a in range(0, len(ends), 2000):
                    cut = list(zip(starts[a : a + 2000], ends[a : a + 2000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(row["docs"][a : a + 2000], pa.int64()), pa.array(starts[a : a + 2000] + row["base"] + row["place"]), pa.array([ids[s:e].tobytes() for s, e in cut], pa.binary())], names=["doc_id", "start", "ids"])

    # few rows to a batch, as each holds a file
    return shards.join(F.broadcast(bases), "bucket").mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def export(shards: DataFrame, folder: str | Path) -> int:
    """Copies the files of a small table of shards into a folder, one at a time; gives their number."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    n = 0
    for row in shards.select("bucket", "shard", "file").toLocalIterator():
        Path(folder, f"{row['bucket']:05d}-{row['shard']:06d}.bpl").write_bytes(bytes(row["file"]))
        n += 1
    return n


def store(spark: SparkSession, docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, kind: str = "bit", path: str | None = None) -> DataFrame:
    """Encodes, writes and gives the table of shards."""
    bounds = id_bounds(docs, partitions(spark))
    return write_shards(encode(docs, tokenizer, end_id, path), Scratch(spark, "planes"), bounds, kind)


def digest(documents: DataFrame) -> DataFrame:
    """A crc32 of each document's ids in the ids' place."""
    return documents.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
