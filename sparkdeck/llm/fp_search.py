"""Ranked lexical search of many items over all documents through document FP-trees.

Score of a document for an item, over the item's distinct terms: ``w * (10^9 tf div (1000 tf + 20 m))`` with the term's
weight ``w = floor(1000 ln((2N+2) / (2df+1)))`` and the document's ``m = 50 + (50 n N div L)``; all corpus counts (N, L, df)
are taken over every document.

How it runs.

1. Items with one text are one item; their distinct terms are the vocabulary.  An item block holds at most ``item_bytes``
   of text on average (texts are dealt by hash), which bounds what is broadcast; more text makes more blocks.
2. One pass over the documents counts terms and keeps each document's vector restricted to the vocabulary.  Vectors
   are stored in blocks of documents, with N, L and df as sums over the blocks.
3. Each block becomes an FP-tree: terms of a vector in descending frequency, so documents with the same frequent terms
   share a path.  Nodes of fewer than ``leaf`` documents are leaves.  Every node holds the largest tf of each term in its
   subtree and the subtree's smallest m, which give an upper bound of any score below it.
4. An item walks a tree depth first, best child first, and skips subtrees whose bound is below its k-th best score.  A first
   wave of a sixteenth of the blocks gives every item a k-th best that the other blocks start from; bounds never cut
   a document that could be among the k best, so results are exact.
5. Each block sends at most k rows an item; a window with Spark's group limit (k rows an item leave each task) ranks them.

Edge cases: NULL texts, texts and items without terms and scores of 0 give no row; fewer hits than k give all; equal scores
go by ascending document id, NULL ids last, and repeated ids keep a row each; repeated items (same id or
same text) are each answered; an empty table on either side gives no row.  Other columns are not read.  50 n N must stay
below 2^63.  A text is held in memory whole, its terms a few megabytes at a time.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import arrow_map, pieces, raw, stored

#: Bytes of a term: digits, letters (capitals become small) and everything beyond ASCII.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: One block in this many goes first and gives the others their first k-th best.
WAVE = 16


def terms(data: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in lists of a few megabytes."""
    data, at = data.translate(_TERM), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _blocks(docs: DataFrame, vocab, block_docs: int, block_entries: int) -> DataFrame:
    """Restricted vectors of all documents, a block a row, with the block's share of N, L and df."""
    def run(batches):
        known, part, nth = vocab.value, TaskContext.get().partitionId(), 0
        held: list = [[], [], [], [], []]           # ids, n, vector lengths, terms, tfs
        seen = [0, 0]

        def flush():
            nonlocal held, seen, nth
            ids, n, lens, term, tf = held
            data = np.array(n, "<i8").tobytes() + np.array(lens, "<i4").tobytes() + np.array(term, "<i4").tobytes() + np.array(tf, "<i4").tobytes()
            df = np.bincount(np.array(term, np.int64))
            has = np.flatnonzero(df)
            row = {"block": [part << 32 | nth], "n_docs": [seen[0]], "n_terms": [seen[1]], "term": [has], "df": [df[has]], "doc_ids": [ids],
                   "vectors": [zstandard.ZstdCompressor(level=1).compress(data)]}
            held, seen, nth = [[], [], [], [], []], [0, 0], nth + 1
            return pa.RecordBatch.from_pydict(row, schema=_BLOCK)
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), raw(b.column(1))):
                counts: Counter = Counter()
                n = 0
                for some in terms(text or b""):
                    n += len(some)
                    counts.update(map(known.get, some))
                if not n:
                    continue
                counts.pop(None, None)
                seen[0] += 1
                seen[1] += n
                if counts:
                    for c, v in zip(held, (i, n, len(counts))):
                        c.append(v)
                    held[3].extend(counts.keys())
                    held[4].extend(counts.values())
                if seen[0] >= block_docs or len(held[3]) >= block_entries:
                    yield flush()
        if seen[0]:
            yield flush()
    return arrow_map(docs, run, "block long, n_docs long, n_terms long, term array<int>, df array<long>, doc_ids array<long>, vectors binary")


_BLOCK = pa.schema([("block", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("term", pa.list_(pa.int32())), ("df", pa.list_(pa.int64())),
                    ("doc_ids", pa.list_(pa.int64())), ("vectors", pa.binary())])


def saturate(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Tree:
    """The FP-tree of a block: documents in path order, nodes in preorder with their bounds.

    ``rank`` orders the terms, the most frequent first."""

    def __init__(self, ids: list, n: np.ndarray, lens: np.ndarray, term: np.ndarray, tf: np.ndarray, rank: np.ndarray, total: int, length: int, leaf: int):
        size = len(ids)
        doc = np.repeat(np.arange(size), lens)
        by = np.lexsort((rank[term], doc))
        term, tf = term[by].astype(np.int64), tf[by].astype(np.int64)
        path, ends = rank[term].astype(">u4"), np.r_[0, np.cumsum(lens)].astype(np.int64)
        data, cut = path.tobytes(), (4 * ends).tolist()
        keys = [data[a:b] for a, b in zip(cut, cut[1:])]
        order = np.array(sorted(range(size), key=keys.__getitem__), np.int64)
        self.lens = lens[order].astype(np.int64)
        self.at = np.r_[0, np.cumsum(self.lens)]
        entry = np.repeat(ends[order] - self.at[:-1], self.lens) + np.arange(len(term))
        self.term, tf = term[entry], tf[entry]
        self.path = rank[self.term]
        self.ids = [ids[i] for i in order.tolist()]
        m = 50 + 50 * n[order].astype(np.int64) * total // max(1, length)
        doc = np.repeat(np.arange(size), self.lens)
        self.gain = saturate(tf, m[doc])
        place = np.empty(size, np.int64)             # ascending ids, NULL last
        place[sorted(range(size), key=lambda i: (self.ids[i] is None, self.ids[i] or 0, i))] = np.arange(size)
        self.place = place.tolist()
        self._split(size, leaf)
        self._bounds(doc, tf, m)

    def _split(self, size: int, leaf: int) -> None:
        """Nodes (lo, hi, children); a run of small siblings shares a leaf."""
        self.lo, self.hi, self.children, self.parent, self.depth = [], [], [], [], []
        todo = [(0, size, 0, -1, False)] if size else []
        while todo:
            lo, hi, d, up, whole = todo.pop()
            me = len(self.lo)
            for c, v in zip((self.lo, self.hi, self.children, self.parent, self.depth), (lo, hi, [], up, self.depth[up] + 1 if up >= 0 else 0)):
                c.append(v)
            if up >= 0:
                self.children[up].append(me)
            if whole or hi - lo <= leaf:
                continue
            # a path without branches is one node; equal vectors never part
            while self.lens[lo] > d and self.lens[hi - 1] > d and self.path[self.at[lo] + d] == self.path[self.at[hi - 1] + d]:
                d += 1
            here = np.where(self.lens[lo:hi] > d, self.path[np.minimum(self.at[lo:hi] + d, len(self.path) - 1)], -1)
            edge = [0, *(np.flatnonzero(here[1:] != here[:-1]) + 1).tolist(), hi - lo]
            parts, start = [], 0
            for a, b in zip(edge, edge[1:]):
                if b - a > leaf:
                    if start < a:
                        parts.append((lo + start, lo + a, d + 1, me, True))
                    parts.append((lo + a, lo + b, d + 1, me, bool(here[a] < 0)))
                    start = b
                elif b - start > leaf:
                    parts.append((lo + start, lo + a, d + 1, me, True))
                    start = a
            if start < hi - lo:
                parts.append((lo + start, hi, d + 1, me, True))
            if len(parts) > 1:
                todo.extend(reversed(parts))

    def _bounds(self, doc: np.ndarray, tf: np.ndarray, m: np.ndarray) -> None:
        """For each term the nodes that hold it and the largest gain below them."""
        count = len(self.lo)
        leaf_of = np.zeros(len(m), np.int64)
        for k in range(count):
            if not self.children[k]:
                leaf_of[self.lo[k]:self.hi[k]] = k
        least = np.array([int(m[a:b].min()) for a, b in zip(self.lo, self.hi)], np.int64)
        wide = 1 + int(self.term.max(initial=0))
        depth, parent = np.array(self.depth, np.int64), np.array(self.parent, np.int64)
        key, most = _largest(leaf_of[doc] * wide + self.term, tf)
        done_key, done_tf = [], []
        for d in range(int(depth.max(initial=0)), -1, -1):
            here = depth[key // wide] == d
            done_key.append(key[here])
            done_tf.append(most[here])
            if d:
                up = parent[key[here] // wide] * wide + key[here] % wide
                key, most = _largest(np.r_[key[~here], up], np.r_[most[~here], most[here]])
        key, most = np.concatenate(done_key), np.concatenate(done_tf)
        order = np.argsort(key % wide, kind="stable")
        key, most = key[order], most[order]
        self.node, self.bound = key // wide, saturate(most, least[key // wide]).astype(np.float64)
        self.of_term = np.searchsorted(key % wide, np.arange(wide + 1))
        self.wide = wide

    def search(self, item: list[int], weight: np.ndarray, k: int, floor: int, scratch: np.ndarray) -> list[tuple[int, int]]:
        """The k best (score, document) of scores not below ``floor``; ``scratch`` is zero for all terms before and after."""
        item = [t for t in item if t < self.wide and self.of_term[t + 1] > self.of_term[t]]
        if not item:
            return []
        bounds = np.zeros(len(self.lo))
        for t in item:          # sums of integers below 2^53
            a, b = self.of_term[t], self.of_term[t + 1]
            bounds[self.node[a:b]] += weight[t] * self.bound[a:b]
        bounds = bounds.tolist()
        scratch[item] = weight[item]
        best: list[tuple[int, int]] = []
        floor = max(floor, 1)
        stack = [0]
        while stack:
            node = stack.pop()
            if bounds[node] < floor:
                continue
            if self.children[node]:
                stack.extend(sorted(self.children[node], key=bounds.__getitem__))
                continue
            lo, hi = self.lo[node], self.hi[node]
            a, b = self.at[lo], self.at[hi]
            score = np.add.reduceat(scratch[self.term[a:b]] * self.gain[a:b], self.at[lo:hi] - a)
            for i in np.flatnonzero(score >= floor).tolist():
                got = (int(score[i]), -self.place[lo + i], lo + i)
                if len(best) < k:
                    heapq.heappush(best, got)
                elif got > best[0]:
                    heapq.heapreplace(best, got)
            if len(best) == k:
                floor = max(floor, best[0][0])
        scratch[item] = 0
        return [(s, d) for s, _, d in best]


def _largest(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, each with its largest value."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.maximum.reduceat(value, first)


_HITS = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _walk(blocks: DataFrame, sent, k: int, leaf: int) -> DataFrame:
    def run(batches):
        items, weight, rank, total, length, floors = sent.value
        scratch = np.zeros(len(weight), np.int64)
        for b in batches:
            for r in range(b.num_rows):
                ids = b.column(0)[r].as_py()
                if not ids:
                    continue
                data = zstandard.ZstdDecompressor().decompress(b.column(1)[r].as_py())
                n, lens = np.frombuffer(data, "<i8", len(ids)), np.frombuffer(data, "<i4", len(ids), 8 * len(ids))
                m = (len(data) - 12 * len(ids)) // 8
                term, tf = np.frombuffer(data, "<i4", m, 12 * len(ids)), np.frombuffer(data, "<i4", m, 12 * len(ids) + 4 * m)
                tree = Tree(ids, n, lens, term, tf, rank, total, length, leaf)
                out: tuple[list, list, list] = ([], [], [])
                for i, item in enumerate(items):
                    for s, d in tree.search(item, weight, k, floors[i], scratch):
                        for c, v in zip(out, (i, tree.ids[d], s)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _HITS)], schema=_HITS)
    return arrow_map(blocks.select("doc_ids", "vectors"), run, "item int, doc_id long, score long")


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", item_bytes: int = 16 << 20, block_docs: int = 16384, block_entries: int = 2_000_000, leaf: int = 32) -> DataFrame:
    """item_id, rank (int), doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("asked")).where("asked is not null") \
        .withColumn("key", F.sha2("asked", 256))
    texts = stored(spark, asked.groupBy("key").agg(F.first("asked").alias("asked")), "items")
    held = texts.agg(F.sum(F.octet_length("asked"))).first()[0] or 0
    n_blocks = pieces(held, item_bytes)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for nth in range(n_blocks):
        keys, wanted, vocab = [], [], {}
        for key, text in texts.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == nth).sort("key").collect():      # item_bytes on average
            words = dict.fromkeys(w for some in terms(text.encode()) for w in some)
            if words:
                keys.append(key)
                wanted.append([vocab.setdefault(w, len(vocab)) for w in words])
        sent_vocab = spark.sparkContext.broadcast(vocab)
        blocks = stored(spark, _blocks(read, sent_vocab, block_docs, block_entries), "vectors")
        total, length = (int(x or 0) for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        df = np.zeros(len(vocab), np.int64)
        for t, c in blocks.select(F.explode(F.arrays_zip("term", "df")).alias("e")).groupBy("e.term").agg(F.sum("e.df")).collect():     # a row a term
            df[t] = c
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(c) + 1))) for c in df], np.int64)
        rank = np.empty(len(vocab), np.int64)
        rank[np.lexsort((np.arange(len(vocab)), -df))] = np.arange(len(vocab))
        first = F.pmod(F.xxhash64("block"), F.lit(WAVE)) == 0
        floors = [0] * len(wanted)
        sent = spark.sparkContext.broadcast((wanted, weight, rank, total, length, floors))
        wave = stored(spark, _best(_walk(blocks.where(first), sent, k, leaf), k), "wave")
        for i, s in wave.where(F.col("rank") == k).select("item", "score").collect():       # a row an item
            floors[i] = s
        sent = spark.sparkContext.broadcast((wanted, weight, rank, total, length, floors))
        best = _best(wave.drop("rank").union(_walk(blocks.where(~first), sent, k, leaf)), k)
        names = spark.createDataFrame(list(enumerate(keys)), "item int, key string")
        best = best.join(F.broadcast(names), "item").drop("item")           # names: a row an item of the block
        found = best if found is None else found.union(best)
    return asked.select("item_id", "key").join(found, "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
