"""Token ids in a plane-shuffled, zstandard-compressed chunk format.

Layout.  Ids stand in ascending document order, cut into chunks of whole documents of
about ``chunk_ids`` ids (a longer document is a chunk of its own).  A chunk holds its
document bounds and its ids in blocks of ``block_ids``; every block is transposed into
byte planes (all lowest bytes, then the next, ...) or bit planes (bit 0 of all ids,
then bit 1, ...), equal planes of all blocks are joined, and each is compressed by
zstandard; planes of zeros alone are left out.  The chunk index (shard, chunk, first
document, number of documents and ids) is a table of its own.  Both are written by
Spark's committed Parquet writer, one row a chunk, so a lost task leaves no half file
and any store works.

``write_store`` range-partitions the documents by id (one shuffle of the texts) and
encodes inside the sorted partitions.  ``read_store`` decodes chunks independently.

Edge cases: NULL and empty texts have the end id only; NULL document ids come first;
equal ids stay apart, ordered by text; an empty table gives an empty store.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import encoder
from .util import arrow_map, pieces, scratch, text_bytes

_MAGIC = b"TPL1"


def pack_ids(ids: np.ndarray, planes: str = "byte", block_ids: int = 65536, level: int = 3) -> bytes:
    """One chunk of uint32 ids as planes: magic, kind, counts, then (length, data) of each plane."""
    z = zstandard.ZstdCompressor(level=level)
    n, width = len(ids), 4 if planes == "byte" else 32
    split: list[list[bytes]] = [[] for _ in range(width)]
    for at in range(0, n, block_ids):
        block = np.ascontiguousarray(ids[at:at + block_ids], "<u4")
        rows = block.view(np.uint8).reshape(-1, 4)
        if planes == "byte":
            for k in range(4):
                split[k].append(rows[:, k].tobytes())
        else:
            bits = np.unpackbits(rows, axis=1, bitorder="little")
            for k in range(32):
                split[k].append(np.packbits(bits[:, k], bitorder="little").tobytes())
    out = [_MAGIC, struct.pack("<BII", width, n, block_ids)]
    for parts in split:
        data = b"".join(parts)
        data = z.compress(data) if data.strip(b"\0") else b""
        out += [struct.pack("<I", len(data)), data]
    return b"".join(out)


def unpack_ids(data: bytes) -> np.ndarray:
    """The exact inverse of ``pack_ids``."""
    if data[:4] != _MAGIC:
        raise ValueError("not a chunk of this format")
    width, n, block_ids = struct.unpack_from("<BII", data, 4)
    at, z, planes = 13, zstandard.ZstdDecompressor(), []
    for _ in range(width):
        size, = struct.unpack_from("<I", data, at)
        planes.append(np.frombuffer(z.decompress(data[at + 4:at + 4 + size]), np.uint8) if size else None)
        at += 4 + size
    ids = np.zeros(n, "<u4")
    if width == 4:
        rows = ids.view(np.uint8).reshape(-1, 4)
        for k, p in enumerate(planes):
            if p is not None:
                rows[:, k] = p
        return ids
    for k, p in enumerate(planes):
        if p is not None:
            off = 0
            for i in range(0, n, block_ids):
                m = min(block_ids, n - i)
                ids[i:i + m] |= np.unpackbits(p[off:off + -(-m // 8)], bitorder="little", count=m).astype("<u4") << np.uint32(k)
                off += -(-m // 8)
    return ids


@dataclass
class TokenStore:
    spark: SparkSession
    path: str

    def chunks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/chunks")

    def index(self) -> DataFrame:
        """(shard, chunk, first_doc, n_docs, n_ids): the chunk index."""
        return self.spark.read.parquet(f"{self.path}/index")


def write_store(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", planes: str = "byte", chunk_ids: int = 1 << 18,
                shard_bytes: int = 32 << 20) -> TokenStore:
    """Encode all texts, add ``end_id`` to each, and write the store in ascending id order."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    shards = pieces(text_bytes(docs, text_col), shard_bytes)
    # near-equal texts make near-equal ids: the text breaks ties of the id and splits a hot one
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text"))
    end = struct.pack("<I", end_id)

    def write(batches):
        enc, shard, chunk = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, held, n = [], [], 0

        def flush():
            nonlocal ids, held, n, chunk
            flat = np.frombuffer(b"".join(held), "<u4")
            lens = np.array([len(h) // 4 for h in held], "<i8")
            row = {"shard": [shard], "chunk": [chunk], "n_docs": [len(ids)], "n_ids": [len(flat)], "first_doc": [ids[0]],
                   "doc_ids": [ids], "lengths": [lens.tolist()], "payload": [pack_ids(flat, planes)]}
            ids, held, n, chunk = [], [], 0, chunk + 1
            return pa.RecordBatch.from_pydict(row, schema=_CHUNK)
        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), enc.ids(b.column(1).to_pylist())):
                if n and n + len(data) // 4 + 1 > chunk_ids:
                    yield flush()
                ids.append(i)
                held.append(data + end)
                n += len(data) // 4 + 1
        if ids:
            yield flush()
    out = arrow_map(rows, write, "shard int, chunk int, n_docs long, n_ids long, first_doc long, doc_ids array<long>, "
                                 "lengths array<long>, payload binary")
    out.write.option("compression", "none").parquet(f"{path}/chunks")
    spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "first_doc", "n_docs", "n_ids") \
        .coalesce(1).write.parquet(f"{path}/index")
    return TokenStore(spark, path)


_CHUNK = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                    ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("payload", pa.binary())])


def read_store(store: TokenStore, with_ids: bool = True) -> DataFrame:
    """One row a document: doc_id, start, n_tokens, ids_crc32 and, where asked for, ids."""
    from pyspark.sql import Window
    index = store.index()
    # shards are few (one for 32 MB of text), and so are their totals
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = index.withColumn("inside", F.coalesce(inside, F.lit(0))).join(shards, "shard") \
        .select("shard", "chunk", (F.col("base") + F.col("inside")).alias("chunk_start"))

    def decode(batches):
        for b in batches:
            for r in range(b.num_rows):
                start, docs, lens, data = (b.column(c)[r].as_py() for c in range(4))
                ids = unpack_ids(data)
                ends = np.cumsum(np.array(lens, np.int64))
                first, raw = ends - np.array(lens, np.int64), ids.tobytes()
                crc = [zlib.crc32(raw[a * 4:e * 4]) for a, e in zip(first.tolist(), ends.tolist())]
                cols = [pa.array(docs, pa.int64()), pa.array(first + start, pa.int64()), pa.array(lens, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[first, len(ids)], pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
    rows = store.chunks().join(starts, ["shard", "chunk"]).select("chunk_start", "doc_ids", "lengths", "payload")
    # a chunk is up to a megabyte of ids: a few at a time
    return arrow_map(rows, decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
