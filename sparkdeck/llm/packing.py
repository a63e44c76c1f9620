"""Packing by power-of-two decomposition.

A document of L tokens (its ids and the end id) is cut into ``L // max_len`` pieces of
the full length and the powers of two of the remainder, longest first.  A piece of
length 2^k is a whole sequence of the 2^k bucket: no sequence holds two documents and
none needs padding.  Sequences are numbered without gaps, bucket after bucket (longest
first), so a trainer can read batches of equal length.

Numbers come from per-task counts of each bucket (one small row for each task and
bucket), not from a sort of the pieces; a lost task makes the same pieces again.

Edge cases: NULL and empty texts hold the end id only; NULL, repeated and clashing
document ids keep one set of pieces per input row; an empty table gives no row.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import encoder
from .util import arrow_map, stored


def decompose(n: int, max_len: int) -> list[int]:
    """Piece lengths of n tokens: full sequences, then the binary digits of the rest."""
    full, rest = divmod(n, max_len)
    return [max_len] * full + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def cut_all(n: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of all pieces of documents of ``n`` tokens, in the order of the documents."""
    full, rest = n // max_len, n % max_len
    doc = [np.repeat(np.arange(len(n)), full)]
    start = [(np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)) * max_len]
    length = [np.full(len(doc[0]), max_len)]
    for k in range(max_len.bit_length() - 1):
        has = np.flatnonzero(rest >> k & 1)
        doc.append(has)
        start.append(full[has] * max_len + (rest[has] >> (k + 1) << (k + 1)))
        length.append(np.full(len(has), 1 << k))
    doc, start, length = map(np.concatenate, (doc, start, length))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


def pack(docs: DataFrame, tokenizer: str, end_id: int, max_len: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, where asked for,
    ``ids``, the piece's ids as little-endian bytes (16 bits each where the vocabulary allows)."""
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    spark, end = docs.sparkSession, struct.pack("<I", end_id)

    def cut(batches):
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        narrow = max(len(enc.mark), end_id + 1) <= 1 << 16
        seen = [0] * max_len.bit_length()
        for b in batches:
            held = [data + end for data in enc.ids(b.column(1).to_pylist())]
            n = np.array([len(x) // 4 for x in held], np.int64)
            doc, start, length = cut_all(n, max_len)
            data = memoryview(b"".join(held))
            at = ((np.cumsum(n) - n)[doc] + start) * 4
            crc = [zlib.crc32(data[x:y]) for x, y in zip(at.tolist(), (at + 4 * length).tolist())]
            bucket, nth = np.log2(length).astype(np.int32), np.empty(len(doc), np.int64)
            for k in range(len(seen)):
                mine = np.flatnonzero(bucket == k)
                nth[mine] = seen[k] + np.arange(len(mine))
                seen[k] += len(mine)
            cols = [pa.array(np.full(len(doc), part, np.int32)), b.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                    pa.array(n[doc]), pa.array(bucket), pa.array(nth)]
            if with_ids:
                ids = np.frombuffer(data, "<u4")
                ids, w = (ids.astype("<u2").tobytes(), 2) if narrow else (data.tobytes(), 4)
                cols.append(pa.array([ids[x:y] for x, y in zip((at // 4 * w).tolist(), ((at // 4 + length) * w).tolist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, _NAMES[:len(cols)])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kept = stored(spark, arrow_map(rows, cut, _SCHEMA + ", ids binary" * with_ids), "pieces")
    counts = kept.groupBy("part", "bucket").agg(F.count("*").alias("n"))
    # a row for each task and bucket: a few thousand for a hundred terabytes of text
    before = F.sum("n").over(Window.orderBy(F.desc("bucket"), "part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("part", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    return kept.join(base, ["part", "bucket"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids)


_NAMES = ["part", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket", "nth", "ids"]
_SCHEMA = "part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int, nth long"
