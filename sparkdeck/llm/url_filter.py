"""URL rules: a blocked Bloom filter in front of an exact hash join.

A rule is (host, path, verdict).  It fits its host and every subdomain when the URL's
path starts with the rule's path; the longest host + path wins (equal lengths: the
longer host).  Every URL is turned into the few canonical keys ``host suffix + path
prefix`` that some rule could have (only label counts and path lengths that occur
among the rules), and these are tested in a blocked Bloom filter: one 512-bit block
per key, eight bits in it.  Keys that pass go to an exact hash join with the rules,
which removes the false positives; URLs with no passing key never reach the join.

Size bounds.  The filter takes ``bits_per_key`` bits per rule, at most ``max_bytes``;
with more rules than fit, it merely passes more keys to the join.  Rules are joined
by Spark's own choice (broadcast under its size threshold, else shuffled).

Edge cases: NULL URL or no ``://`` gives an empty host and path, no rule and the
default verdict.  Rule rows with a NULL host, path or verdict are ignored; of equal
rules the smallest verdict holds.  Duplicate and NULL page ids keep one row per input row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import arrow_map

_END_HOST = re.compile(r"[/?#]")
_END_PATH = re.compile(r"[?#]")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the contract defines them."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = _END_HOST.search(rest)
    host, rest = (rest, "") if m is None else (rest[:m.start()], rest[m.start():])
    return host.translate(_LOWER), _END_PATH.split(rest, maxsplit=1)[0]


def _bits(key: str, n_blocks: int) -> tuple[int, np.ndarray]:
    """The block of a key and the 8 words of its mask (one bit per 64-bit word)."""
    h = xxhash.xxh3_128_intdigest(key)
    mask = np.array([1 << ((h >> (64 + 6 * i)) & 63) for i in range(8)], np.uint64)
    return (h & 0xFFFFFFFFFFFFFFFF) % n_blocks, mask


def build_filter(rules: DataFrame, bits_per_key: int = 16, max_bytes: int = 32 << 20):
    """(filter words as (blocks, 8) uint64, label counts, path lengths) of the rule keys.

    Tasks set bits of their own rules and Spark ORs the blocks, so the driver receives
    at most ``max_bytes`` whatever the number of rules, and two lists of numbers: no more
    label counts than a host has, no more path lengths than the longest rule's."""
    n = rules.count()
    n_blocks = int(max(1, min(-(-n * bits_per_key // 512), max_bytes // 64)))

    def blocks(batches):
        for b in batches:
            rows = [(*_bits(h + p, n_blocks), h.count(".") + 1, len(p))
                    for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            cols = [[r[0] for r in rows]] + [[int(r[1][i].astype(np.int64)) for r in rows] for i in range(8)]
            cols += [[r[2] for r in rows], [r[3] for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["block", *[f"w{i}" for i in range(8)], "labels", "plen"])
    words = ", ".join(f"w{i} long" for i in range(8))
    bits = arrow_map(rules.select("r_host", "r_path"), blocks, f"block long, {words}, labels long, plen long")
    table = np.zeros((n_blocks, 8), np.uint64)
    for r in bits.groupBy("block").agg(*[F.bit_or(f"w{i}") for i in range(8)]).toLocalIterator():
        table[r[0]] = np.array(r[1:], np.int64).view(np.uint64)
    labels, lengths = (sorted(bits.select(c).distinct().toArrow().column(0).to_pylist()) for c in ("labels", "plen"))
    return table, labels, lengths


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", bits_per_key: int = 16) -> DataFrame:
    """``rules``: columns host, path, verdict.  Returns id, host, path, rule, verdict."""
    spark = pages.sparkSession
    rules = (rules.select(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("r_host"),
                          F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
             .dropna().groupBy("r_host", "r_path").agg(F.min("r_verdict").alias("r_verdict")))
    table, labels, lengths = build_filter(rules, bits_per_key)
    sent = spark.sparkContext.broadcast((table, labels, lengths))

    def judge(batches):
        words, labels, lengths = sent.value
        n_blocks = len(words)

        def passing(host, path):
            parts = host.split(".")
            out = []
            for k in labels:
                if k > len(parts) or not host:
                    continue
                suffix = ".".join(parts[-k:])
                for n in lengths:
                    if n <= len(path):
                        block, mask = _bits(suffix + path[:n], n_blocks)
                        if ((words[block] & mask) == mask).all():
                            out.append({"h": suffix, "p": path[:n]})
            return out
        for b in batches:
            urls = [split_url(u) for u in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([h for h, _ in urls], pa.string()), pa.array([p for _, p in urls], pa.string()),
                 pa.array([passing(h, p) for h, p in urls], pa.list_(pa.struct([("h", pa.string()), ("p", pa.string())])))],
                [id_col, "host", "path", "keys"])
    kind = pages.schema[id_col].dataType.simpleString()
    judged = arrow_map(pages.select(id_col, url_col), judge,
                       f"`{id_col}` {kind}, host string, path string, keys array<struct<h:string,p:string>>")
    # the rule is a function of (host, path), so equal URLs are joined once
    hits = (judged.where(F.size("keys") > 0).select("host", "path", "keys").distinct()
            .select("host", "path", F.explode("keys").alias("k")))
    best = (hits.join(rules, (F.col("k.h") == F.col("r_host")) & (F.col("k.p") == F.col("r_path")))
            .groupBy("host", "path")
            .agg(F.max(F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("hn"),
                                F.concat("r_host", "r_path").alias("rule"), "r_verdict")).alias("best")))
    return (judged.select(id_col, "host", "path").join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.r_verdict", F.lit(default)).alias("verdict")))
