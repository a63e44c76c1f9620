"""Benchmark decontamination with one Aho-Corasick automaton.

Words are the maximal runs of letters and digits (any non-ASCII character counts) of
the text with A-Z in lower case.  Every window of ``window`` consecutive item words -
an item with fewer words is one window - is a pattern.  A pattern's words become
single symbols, so the automaton (pyahocorasick) works on words: it reads a document's
words once, overlapping occurrences included, and a hit's position is its word number,
which maps back to character offsets of the original text.

Size.  The automaton is broadcast; one holds at most ``max_windows`` window rows,
which is the checked bound.  A larger benchmark is dealt into several automata by
window hash; the scans' hits are then merged by the text's SHA-256 digest.

Edge cases: NULL and empty texts have no words and no hits; NULL item ids mark words
as hit but are not listed; repeated items and documents each count; no benchmark rows
means no hits.  Other columns of either table are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import arrow_map, pieces, raw, stored

#: A-Z in lower case; every byte that no word holds becomes a blank.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BUILT: dict[tuple, tuple] = {}


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def _symbol(i: int) -> str:
    i += 1                                          # 0 stands for every other word
    return chr(i if i < 0xD800 else i + 0x800)


class Matcher:
    """Windows (tuples of words with their item ids) as an automaton over words."""

    def __init__(self, windows: list[tuple[list[bytes], list[int]]]):
        import ahocorasick
        self.symbol: dict[bytes, str] = {}
        self.auto = ahocorasick.Automaton()
        for words, items in windows:
            key = "".join(self.symbol.setdefault(w, _symbol(len(self.symbol))) for w in words)
            self.auto.add_word(key, (len(key), items))
        if len(self.auto):
            self.auto.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words are hit, and the ids of the items whose windows occur."""
        if not len(self.auto):
            return None, set()
        get, items, marks = self.symbol.get, set(), None
        for end, (n, ids) in self.auto.iter("".join([get(w, "\0") for w in words])):
            if marks is None:
                marks = np.zeros(len(words) + 1, np.int32)
            marks[end + 1 - n] += 1
            marks[end + 1] -= 1
            items.update(ids)
        return (None if marks is None else np.cumsum(marks[:-1]) > 0), items


def _windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(window, items): distinct windows with the sorted distinct ids of their items."""
    def cut(batches):
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), raw(b.column(1))):
                w = words_of(text)
                rows += [(b" ".join(w[i:i + window]).decode(), item) for i in range(max(1, len(w) - window + 1)) if w]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.int64())], ["window", "item"])
    return (arrow_map(benchmark.select(F.col(id_col).cast("long"), text_col), cut, "window string, item long")
            .groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")))


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Maximal runs of hit words as character offsets of the original text."""
    at = [m.span() for m in _WORD.finditer(text)]
    edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in items)).encode()).hexdigest()


def _rows(rows, kind) -> pa.RecordBatch:
    n, hits, items, digests, spans = ([r[k] for r in rows] for k in range(1, 6))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.int64()),
         pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_()),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])


_SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "spans array<struct<start:long,end:long>>")
_NO_ITEMS = _digest([])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", max_windows: int = 100_000) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    spark = docs.sparkSession
    windows = stored(spark, _windows(benchmark, item_col, item_text_col, window), "windows")
    # an item listed for a window costs as much as a window
    size = windows.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    parts = pieces(size, max_windows)
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts)))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def automaton(part: int):
        rows = [(r["window"].encode().split(b" "), list(r["items"])) for r in dealt.where(F.col("part") == part).collect()]
        return spark.sparkContext.broadcast((uuid.uuid4().hex, rows))

    def matcher(sent) -> Matcher:
        name, rows = sent.value                      # the name tells automata apart in a worker that is used again
        key = (os.getpid(), name)
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Matcher(rows)
        return _BUILT[key]

    if parts == 1:
        sent = automaton(0)

        def scan(batches):
            m = matcher(sent)
            for b in batches:
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), raw(b.column(1))):
                    w = words_of(text)
                    hit, items = m.scan(w)
                    if hit is None:
                        rows.append((doc, len(w), 0, 0, _NO_ITEMS, []))
                    else:
                        rows.append((doc, len(w), int(hit.sum()), len(items), _digest(items), _spans(text.decode(), hit)))
                yield _rows(rows, pa.int64())
        return arrow_map(texts, scan, _SCHEMA)

    hits = None
    for part in range(parts):                       # the hits of equal texts are equal
        def part_scan(batches, sent=automaton(part)):
            m = matcher(sent)
            for b in batches:
                rows = []
                for text in raw(b.column(0)):
                    hit, items = m.scan(words_of(text))
                    if hit is not None:
                        rows.append((hashlib.sha256(text).hexdigest(), np.flatnonzero(hit).tolist(), sorted(items)))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                                  *[pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (1, 2)]], ["key", "hit", "items"])
        found = arrow_map(texts.select("text"), part_scan, "key string, hit array<long>, items array<long>")
        hits = found if hits is None else hits.unionByName(found)
    merged = (hits.distinct().groupBy("key")
              .agg(F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
                   F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
    joined = (texts.withColumn("key", F.sha2("text", 256)).join(merged, "key", "left").select("doc_id", "text", "hit", "items"))

    def finish(batches):
        for b in batches:
            rows = []
            for doc, text, hit, items in zip(b.column(0).to_pylist(), raw(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                w = words_of(text)
                if hit is None:
                    rows.append((doc, len(w), 0, 0, _NO_ITEMS, []))
                else:
                    mark = np.zeros(len(w), bool)
                    mark[hit] = True
                    rows.append((doc, len(w), len(hit), len(items), _digest(items), _spans(text.decode(), mark)))
            yield _rows(rows, pa.int64())
    return arrow_map(joined, finish, _SCHEMA)
