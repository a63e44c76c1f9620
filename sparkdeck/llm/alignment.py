"""Alignment of two tokenizers' ids over the same texts.

Tokenizer A is a byte-level BPE vocabulary (a tokenizers JSON file) over a blank and the text, tokenizer B a sentencepiece
model that adds the blank itself.  Byte offsets at which tokens of both end cut a text into groups; all A and B tokens
of one group are linked, and an id pair's count is the number of documents that hold it linked.

How it runs.

* Neither vocabulary lets a token reach from a visible character over a blank, so texts are cut there and every distinct
  segment is encoded and grouped once for each worker (a bounded cache).  A document is a list of segment numbers.
* ``identity`` maps each A id to the B id of the same bytes.  A group of one token each is such a pair; those pairs
  are counted in vectors of A's vocabulary length, summed by Spark and sent back as a broadcast of that fixed size.
* Only pairs from irregular groups are shuffled: each block of documents sends a distinct pair once with its
  number of documents, Spark adds them up, and a block gets the totals of its own pairs back (one row for each block and
  pair, so a pair that occurs everywhere costs a row a block, not a row a document).

Blocks are parts of the scan's Arrow batches (at most 2,000 documents or 16 MB); the first pass is written to the shared
scratch folder, so a lost executor repeats its own blocks only.

Edge cases: NULL and empty texts, and texts whose joined token bytes differ from a blank and the text (those that hold
U+2581), have no tokens: all numbers are 0 and the digest is ''.  NULL and repeated document ids keep a row each, and
each row counts as a document.  A group without common offsets for long (a text without blanks) is counted
through its distinct ids, never pair by pair.  A text is held in memory whole.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import byte_of
from .util import arrow_map, stored

#: Pairs are ``a << B_BITS | b``.
B_BITS = 15
#: New segments are grouped so many characters at a time; groups of more links than SMALL_GROUP go by their distinct ids.
LEARN_CHARS, SMALL_GROUP = 1 << 19, 32

_BLANKS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= )")
_SHARED: dict[tuple, "Aligner"] = {}


def _merger(path: str):
    """(encode function, bytes of each id) of a byte-level vocabulary; its ids are the merge order."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    byte = byte_of()
    ranks = {bytes(byte[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
    size = 1 + max(spec["model"]["vocab"].values())
    spelt = [b""] * size
    for s, i in ranks.items():
        spelt[i] = s
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, spelt


def _spell(ids: np.ndarray, sizes: np.ndarray, spelt: list[bytes], segs: list[bytes]) -> np.ndarray:
    """Whether the ids of each segment, ``sizes`` of them, spell its bytes."""
    words = list(map(spelt.__getitem__, ids.tolist()))
    at = np.r_[0, np.cumsum(np.array(list(map(len, words)), np.int64))][np.r_[0, np.cumsum(sizes)]]
    if b"".join(words) == b"".join(segs) and np.array_equal(np.diff(at), list(map(len, segs))):
        return np.ones(len(segs), bool)
    edge = np.r_[0, np.cumsum(sizes)].tolist()
    return np.array([b"".join(words[i:j]) == s for i, j, s in zip(edge, edge[1:], segs)])


class Aligner:
    """Segments of texts with their tokens, groups and linked pairs, each computed once."""

    def __init__(self, a_path: str, b_path: str, keep: int = 300_000):
        import sentencepiece
        self.encode_a, self.a_bytes = _merger(a_path)
        self.sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n_b = self.sp.get_piece_size()
        if n_b > 1 << B_BITS or len(self.a_bytes) >> 16:
            raise ValueError("the vocabularies are too large for 31-bit pairs")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode() if not
                        (self.sp.is_control(i) or self.sp.is_unknown(i)) else b"" for i, p in enumerate(map(self.sp.id_to_piece, range(n_b)))]
        same: dict[bytes, int] = {}
        for i, s in enumerate(self.b_bytes):       # a piece goes before a byte token of the same bytes
            if s and (s not in same or self.sp.is_byte(same[s])):
                same[s] = i
        self.identity = np.array([same.get(s, -1) for s in self.a_bytes], np.int64)
        self.a_lens, self.b_lens = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.blank = self.sp.piece_to_id("▁")
        self.keep = keep
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.digests: list[bytes] = []
        self.numbers = array("q")            # n_a, n_b, n_groups, n_links of each segment; n_a is -1 where bytes differ
        self.pairs, self.times, self.ends = array("q"), array("q"), array("q", [0])

    def segments(self, text: str) -> list[str]:
        """Segments without the blank that each begins with."""
        if text[0].isspace() or _BLANKS.search(text):
            return [s[1:] for s in _CUT.split(" " + text)]
        return text.split(" ")

    def encoded(self, keys: list[str], lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all segments, one after the other, and how many each has.  Segments that end in a visible
        character go as one text: no token reaches from there over the blank of the next."""
        alone = np.array([not key or key[-1].isspace() for key in keys])
        plain, sizes = np.flatnonzero(~alone), np.zeros(len(keys), np.int64)
        ids = np.array(self.encode_a(" " + " ".join(map(keys.__getitem__, plain.tolist()))) if len(plain) else [], np.int64)
        ends, want = np.cumsum(self.a_lens[ids]), np.cumsum(lens[plain])
        last = np.searchsorted(ends, want)
        if len(plain) and (last[-1] != len(ids) - 1 or (ends[last] != want).any()):
            alone[:], plain, ids, last = True, plain[:0], ids[:0], last[:0]
        sizes[plain] = np.diff(last, prepend=-1)
        if not alone.any():
            return ids, sizes
        others = [self.encode_a(" " + keys[i]) for i in np.flatnonzero(alone).tolist()]
        sizes[alone] = [len(x) for x in others]
        out, mine = np.empty(int(sizes.sum()), np.int64), np.repeat(alone, sizes)
        out[~mine], out[mine] = ids, [t for x in others for t in x]
        return out, sizes

    def learn(self, keys: list[str]) -> None:
        part = np.cumsum([len(key) + 1 for key in keys]) // LEARN_CHARS
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(keys)]
        for k, e in zip(edges, edges[1:]):
            self._learn(keys[k:e])

    def _learn(self, keys: list[str]) -> None:
        """Number new segments; all their tokens and groups are found at once."""
        segs = [(" " + key).encode() for key in keys]
        lens = np.array(list(map(len, segs)), np.int64)
        a, a_size = self.encoded(keys, lens)
        found = [x or [self.blank] for x in self.sp.encode(keys, num_threads=1)]
        b, b_size = np.array([t for x in found for t in x], np.int64), np.array(list(map(len, found)), np.int64)
        good = _spell(a, a_size, self.a_bytes, segs) & _spell(b, b_size, self.b_bytes, segs)
        self.index.update(zip(keys, range(len(self.digests), len(self.digests) + len(keys))))
        a, b, n_a, n_b = a[np.repeat(good, a_size)], b[np.repeat(good, b_size)], a_size[good], b_size[good]
        # a group ends where tokens of both sides do
        a_end, b_end = np.cumsum(self.a_lens[a]), np.cumsum(self.b_lens[b])
        end = np.intersect1d(a_end, b_end, assume_unique=True)
        of_a, of_b, of_key = np.searchsorted(end, a_end), np.searchsorted(end, b_end), np.searchsorted(np.cumsum(lens[good]), end)
        in_a, in_b = np.bincount(of_a, minlength=len(end)), np.bincount(of_b, minlength=len(end))
        groups = np.bincount(of_key, minlength=len(n_a))
        numbers = np.tile(np.array([-1, 0, 0, 0], np.int64), (len(keys), 1))
        numbers[good] = np.stack([n_a, n_b, groups, np.bincount(of_key, in_a * in_b, minlength=len(n_a)).astype(np.int64)], 1)
        self.numbers.frombytes(numbers.tobytes())
        # digests: A's ids of a group, then B's, as decimals with a sign behind each
        a_first, b_first = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        a_place, b_place = np.arange(len(a)) + b_first[of_a], np.arange(len(b)) + (a_first + in_a)[of_b]
        token, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        token[a_place], token[b_place] = a, b
        sign[a_place[a_first + in_a - 1]] = ord("|")
        sign[b_place[b_first + in_b - 1]] = ord(";")
        sign[b_place[np.cumsum(n_b) - 1]] = ord("\n")
        shown = np.ones((len(token), 6), bool)
        digit = np.empty((len(token), 6), np.uint8)
        for k, power in enumerate((10000, 1000, 100, 10, 1)):
            digit[:, k] = token // power % 10 + ord("0")
            shown[:, k] = token >= power if power > 1 else True
        digit[:, 5] = sign
        said = iter(digit[shown].tobytes().split(b"\n"))
        self.digests.extend(next(said) if g else b"" for g in good.tolist())
        # pairs of each segment: small groups in full, large ones by their distinct ids
        small = in_a * in_b <= SMALL_GROUP
        left = np.flatnonzero(small[of_a])
        n = in_b[of_a[left]]
        right = np.repeat(b_first[of_a[left]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        left = np.repeat(left, n)
        pair, times = [of_key[of_a[left]] << (B_BITS + 16) | a[left] << B_BITS | b[right]], [np.ones(len(left), np.int64)]
        for g in np.flatnonzero(~small).tolist():
            x, xn = np.unique(a[a_first[g]:a_first[g] + in_a[g]], return_counts=True)
            y, yn = np.unique(b[b_first[g]:b_first[g] + in_b[g]], return_counts=True)
            pair.append((of_key[g] << (B_BITS + 16) | x[:, None] << B_BITS | y).ravel())
            times.append((xn[:, None] * yn).ravel())
        pair, times = np.concatenate(pair), np.concatenate(times)
        order = np.argsort(pair)
        pair, times = pair[order], times[order]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        pair, times = pair[first], np.add.reduceat(times, first) if len(first) else times
        held = np.zeros(len(keys), np.int64)
        held[good] = np.bincount(pair >> (B_BITS + 16), minlength=len(n_a))
        self.ends.frombytes((len(self.pairs) + np.cumsum(held)).tobytes())
        self.pairs.frombytes((pair & ((1 << (B_BITS + 16)) - 1)).tobytes())
        self.times.frombytes(times.tobytes())

    def documents(self, texts: list[str | None]):
        """Per text its four numbers and digest input; and the (text, pair, links) triples of all texts in order."""
        if len(self.index) > self.keep:
            self.clear()
        index = self.index
        split = [self.segments(t) if t else [] for t in texts]
        keys = list(chain.from_iterable(split))
        new = [s for s in dict.fromkeys(keys) if s not in index]
        if new:
            self.learn(new)
        numbers = np.frombuffer(self.numbers, np.int64).reshape(-1, 4)
        lens = np.array(list(map(len, split)), np.int64)
        flat = np.fromiter(map(index.__getitem__, keys), np.int64, len(keys))
        edges = np.r_[0, np.cumsum(lens)].tolist()
        said = list(map(self.digests.__getitem__, flat.tolist()))
        del split, keys
        doc = np.repeat(np.arange(len(texts)), lens)
        good = np.ones(len(texts), bool)
        good[doc[numbers[flat, 0] < 0]] = False
        flat, doc = flat[good[doc]], doc[good[doc]]
        at = np.searchsorted(doc, np.arange(len(texts) + 1))
        sums = np.zeros((len(flat) + 1, 4), np.int64)
        np.cumsum(numbers[flat], axis=0, out=sums[1:])
        sums = sums[at[1:]] - sums[at[:-1]]
        digests = [b";".join(said[i:j]) if g else b"" for i, j, g in zip(edges, edges[1:], good.tolist())]
        many = max(1, len(self.digests))
        both, n = np.unique(doc * many + flat, return_counts=True)
        doc, seg = both // many, both % many
        ends = np.frombuffer(self.ends, np.int64)
        size = ends[seg + 1] - ends[seg]
        entry = np.repeat(ends[seg] - np.r_[0, np.cumsum(size)[:-1]] if len(size) else size, size) + np.arange(int(size.sum()))
        key = np.repeat(doc, size) << (B_BITS + 16) | np.frombuffer(self.pairs, np.int64)[entry]
        links = np.repeat(n, size) * np.frombuffer(self.times, np.int64)[entry]
        order = np.argsort(key, kind="stable")
        key, links = key[order], links[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        links = np.add.reduceat(links, first) if len(first) else links
        key = key[first]
        return sums, digests, key >> (B_BITS + 16), key & ((1 << (B_BITS + 16)) - 1), links


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner for each pair of vocabularies and Python worker."""
    key = (os.getpid(), a_path, b_path)
    if key not in _SHARED:
        _SHARED[key] = Aligner(a_path, b_path)
    return _SHARED[key]


_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())),
                    ("a", pa.list_(pa.int32())), ("a_docs", pa.list_(pa.int32())), ("pair", pa.list_(pa.int32())), ("pair_docs", pa.list_(pa.int32())),
                    ("links", pa.binary())])
_BLOCK_SQL = ("block long, doc_ids array<long>, numbers array<long>, groups array<string>, a array<int>, a_docs array<int>, "
              "pair array<int>, pair_docs array<int>, links binary")


@dataclass
class Alignment:
    """``documents``: a row a document; ``pairs``: (a_id, b_id, n_docs) of all linked ids."""
    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> Alignment:
    """Align the ids of both tokenizers over all texts.

    ``documents`` holds doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their A id), count_sum
    (counts added over links), groups_sha256 and, where asked for, ``groups`` itself."""
    spark = docs.sparkSession

    def first(batches):
        work, part, nth = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        for b in (b.slice(k, 2000) for b in batches for k in range(0, b.num_rows, 2000)):
            sums, digests, doc, pair, links = work.documents(b.column(1).to_pylist())
            regular = work.identity[pair >> B_BITS] == pair & ((1 << B_BITS) - 1)
            counts = np.bincount(pair[regular] >> B_BITS, minlength=len(work.identity))
            held = np.flatnonzero(counts)
            odd, odd_docs = np.unique(pair[~regular], return_counts=True)
            packed = zstandard.ZstdCompressor(level=1).compress(
                doc.astype("<i4").tobytes() + pair.astype("<i4").tobytes() + links.astype("<i8").tobytes())
            said = [d.decode() for d in digests] if with_groups else [hashlib.sha256(d).hexdigest() if d else "" for d in digests]
            yield pa.RecordBatch.from_pydict({
                "block": [part << 32 | nth], "doc_ids": [b.column(0)], "numbers": [sums.ravel()], "groups": [said], "a": [held], "a_docs": [counts[held]],
                "pair": [odd], "pair_docs": [odd_docs], "links": [packed]}, schema=_BLOCK)
            nth += 1
    blocks = stored(spark, arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), first, _BLOCK_SQL), "aligned")

    def listed(key: str, n: str) -> DataFrame:
        return blocks.select("block", F.explode(F.arrays_zip(key, n)).alias("e")).select("block", f"e.{key}", F.col(f"e.{n}").cast("long").alias("n"))
    regular = listed("a", "a_docs").groupBy("a").agg(F.sum("n").alias("n"))
    odd = listed("pair", "pair_docs")
    totals = stored(spark, odd.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    best_odd = totals.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("n").alias("n"))
    # both have a row for each id of A's vocabulary at most
    mine = aligner(a_path, b_path)
    count = np.zeros(len(mine.identity), np.int64)
    best = count.copy()
    identity = mine.identity
    _SHARED.clear()
    for a, n in regular.collect():
        count[a] = best[a] = n
    for a, n in best_odd.collect():
        best[a] = max(best[a], n)
    sent = spark.sparkContext.broadcast((identity, count, best))

    def second(_, left, right):
        row = {c: left.column(c).combine_chunks() for c in ("doc_ids", "numbers", "groups", "links")}
        identity, count, best = sent.value
        ids = row["doc_ids"].flatten()
        n = len(ids)
        numbers = row["numbers"].flatten().to_numpy().reshape(n, 4)
        data = zstandard.ZstdDecompressor().decompress(row["links"][0].as_py())
        m = len(data) // 16
        doc, pair, links = np.frombuffer(data, "<i4", m), np.frombuffer(data, "<i4", m, 4 * m), np.frombuffer(data, "<i8", m, 8 * m)
        a = pair >> B_BITS
        each = count[a]
        odd = np.flatnonzero(identity[a] != pair & ((1 << B_BITS) - 1))
        if len(odd):
            known, total = right.column("pair").to_numpy(), right.column("n").to_numpy()
            order = np.argsort(known)
            each[odd] = total[order][np.searchsorted(known[order], pair[odd])]
        at = np.searchsorted(doc, np.arange(n + 1))

        def per_doc(x):
            x = np.r_[0, np.cumsum(x)]
            return x[at[1:]] - x[at[:-1]]
        said = row["groups"].flatten()
        cols = [ids, *(pa.array(numbers[:, k]) for k in range(4)), pa.array(per_doc(np.where(each == best[a], links, 0))), pa.array(per_doc(links * each))]
        if with_groups:
            cols += [pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said.to_pylist()]), said]
        else:
            cols.append(said)
        return pa.Table.from_arrays(cols, names)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * with_groups
    schema = ", ".join(f"{c} long" for c in names[:7]) + ", groups_sha256 string" + ", groups string" * with_groups
    back = odd.join(totals.withColumnRenamed("n", "total"), "pair").select(F.col("block").alias("at"), "pair", F.col("total").alias("n"))
    documents = blocks.select("block", "doc_ids", "numbers", "groups", "links").groupBy("block") \
        .cogroup(back.groupBy("at")).applyInArrow(second, schema)
    low = F.lit((1 << B_BITS) - 1)
    same = spark.createDataFrame([(i, int(b)) for i, b in enumerate(identity.tolist()) if b >= 0], "a int, b int")
    pairs = regular.join(F.broadcast(same), "a").select(F.col("a").alias("a_id"), F.col("b").alias("b_id"), F.col("n").alias("n_docs")).union(
        totals.select(F.shiftright("pair", B_BITS), F.col("pair").bitwiseAND(low), "n"))
    return Alignment(documents, pairs)
