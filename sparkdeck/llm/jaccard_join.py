"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct word shingles.  Two sets of
sizes a and b link when 100 |A and B| >= 75 |A or B|, that is when their symmetric
difference d is at most (a + b) / 7.  A sketch deals the hashes into m parts and keeps
the XOR of each part; d differing shingles change at most d parts, so the number of
differing parts bounds d from below, and two linked sets agree in every part but t =
(a + b) / 7 of them at most.  Pigeonhole: if more than t parts of a set are non-empty,
it shares a non-empty part with every partner.  Parts are numbered within size bands
(the larger set has 2^k to 2^(k+1) shingles), so both sides use the same m; a set near
the top of its band also enters the next.

Frequent parts (boilerplate alone in a part) are dropped without loss: of M non-empty
parts at least M - t are shared, so a set needs only its t + 1 rarest.  Parts seen in
no other set count as rarest; a document without near-duplicates has more than t of
those and leaves at once.

Sets that remain are compared exactly, where their sizes and bit sketches allow a link
(the parities of the shingle counts of 2048 parts: the Hamming distance of two is at most
the symmetric difference; folded to 512 parts where many rows carry them).  Within the group of a part, members are first compared with
one pivot.  Where that leaves different components (short texts around the same passage),
the sets of these groups are joined once more by their rarest single shingles, again with
a pivot first; last, members of different components are compared.  There a shingle's place
counts: all sets order their shingles alike (rare first), so before the first one that two
share, at places i and j, all i - 1 and j - 1 differ, and a link allows 7 (i + j - 2) <= a + b.
Copies of one text with edits of their own do not meet at all if these are too many.  Two sets
meet at the first shingle that they share, not at those that follow: a row carries its set's
last few shingles before, and where one of them is shared the two have met.  Members of a group's largest component never meet one another there.  So
every pair that shares a part is compared, known to be connected or known not to link.
Equal sets count as one throughout and are never paired.

Sketch parts travel as binary rows, one for each batch and bucket, so the exchange has
eight bytes a part; buckets are sized by the corpus.

Edge cases: NULL, empty and blank texts have no set and link with nothing; a text of
fewer than ``size`` words has one shingle, the whole sequence; repeated documents are
linked by their equal sets; rows with a NULL id link like all others and get the smallest id of
their component (NULL if it has none); an empty table gives no row.
"""

from __future__ import annotations

import os
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .hashing import WordHash, mix, runs
from .util import arrow_map, bounded_batches, pieces, raw, stored, stored_with, tidy

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_HASH: dict[int, WordHash] = {}
#: Sets under 2^SMALL shingles use every shingle as a part of its own.
SMALL = 6
#: Bits of a packed entry that number the set within its batch; the rest is the part's key.
_SLOT = 14
#: 64-bit words of a set's bit sketch, and their columns; those of the sketch folded to a quarter.
_WORDS = 32
_SKETCH = [f"s{i}" for i in range(_WORDS)]
_FOLDED = _SKETCH[:_WORDS // 4]
#: Shingles before its own that a row of the last join carries.
_BEFORE = 8


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.translate(_LOWER).split() if text else []
    return np.unique(runs(_HASH.setdefault(os.getpid(), WordHash()).of(words), size)) if words else np.empty(0, _U)


def bands(n: int) -> list[tuple[int, int]]:
    """(band, t): the bands a set of n shingles enters, and its largest difference there."""
    k, most = n.bit_length() - 1, n * 4 // 3
    out = [(k, (n + min(most, (2 << k) - 1)) // 7)]
    if most >= 2 << k:
        out.append((k + 1, (n + most) // 7))
    return out


def sketch(h: np.ndarray, band: int, seed: int) -> np.ndarray:
    """Keys of the non-empty parts: band, part number and the XOR of the part's hashes."""
    salt = mix(np.array([band * 1000003 + seed], _U))[0]
    if band < SMALL:
        return mix(h ^ salt)
    m = (1 << band) if band < 8 else 3 << (band - 2)
    part = (mix(h + salt) % _U(m)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    return mix(np.bitwise_xor.reduceat(mix(h ^ salt)[order], first) + part[first].astype(_U) * _U(0x9E3779B97F4A7C15) + salt)


def bit_sketch(h: np.ndarray) -> np.ndarray:
    """Parities of the number of shingles in each part, as 64-bit words."""
    count = np.bincount((mix(h) % _U(64 * _WORDS)).astype(np.int64), minlength=64 * _WORDS)
    return np.packbits((count & 1).astype(np.uint8)).view("<i8")


def _texts(docs, id_col, text_col):
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))


def _print(h: np.ndarray) -> int:
    """A 63-bit fingerprint of a set."""
    whole = np.array([h.sum(dtype=_U)]) ^ (np.array([np.bitwise_xor.reduce(h)]) * _U(0x9E3779B97F4A7C15) + _U(len(h)))
    return int(mix(whole)[0] >> _U(1))


def _measure(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, fp, row)."""
    def measure(batches):
        for b in batches:
            sets = [shingle_set(t, size) for t in raw(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(h) for h in sets], pa.int64()), pa.array([_print(h) if len(h) else None for h in sets], pa.int64()),
                 b.column(2)],
                ["doc_id", "n", "fp", "row"])
    return arrow_map(texts, measure, "doc_id long, n long, fp long, row long")


def _deal(texts: DataFrame, size: int, buckets: int, seed: int) -> DataFrame:
    """(bucket, data): packed sketch entries of a batch with the sets they belong to."""
    def deal(batches):
        for b in batches:
            sets: dict[tuple[int, int], int] = {}
            side, entries = [], []

            def flush():
                keys = np.concatenate(entries)
                bucket = (keys >> _U(32)) % _U(buckets)
                order = np.lexsort((keys, bucket))
                keys, bucket = keys[order], bucket[order]
                edge = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(keys)]
                table = np.array(side, "<i8")
                out = []
                for a, e in zip(edge[:-1], edge[1:]):
                    used, at = np.unique(keys[a:e] & _U((1 << _SLOT) - 1), return_inverse=True)
                    packed = keys[a:e] >> _U(_SLOT) << _U(_SLOT) | at.astype(_U)
                    out.append(np.array([len(used)], "<i8").tobytes() + table[used.astype(np.int64)].tobytes() + packed.tobytes())
                return pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]].astype(np.int64)), pa.array(out, pa.binary())], ["bucket", "data"])
            for text in raw(b.column(1)):
                h = shingle_set(text, size)
                if not len(h):
                    continue
                fp = _print(h)
                for band, t in bands(len(h)):
                    if (fp, band) in sets:
                        continue
                    keys = sketch(h, band, seed)
                    slot = sets[fp, band] = len(side)
                    side.append((fp, band, t + 1 - len(keys)))
                    entries.append(keys >> _U(_SLOT) << _U(_SLOT) | _U(slot))
                    if len(side) == 1 << _SLOT:
                        yield flush()
                        sets, side, entries = {}, [], []
            if entries:
                yield flush()
    return arrow_map(texts, deal, "bucket long, data binary")


def _repeated(rows: pa.Table) -> pa.Table:
    """Keys of a bucket that several sets hold: key, fp, band, need, freq."""
    keys, sets, base = [], [], 0
    for data in rows["data"].to_pylist():
        k = int(np.frombuffer(data, "<i8", 1)[0])
        sets.append(np.frombuffer(data, "<i8", 3 * k, 8).reshape(-1, 3))
        packed = np.frombuffer(data, "<u8", offset=8 + 24 * k)
        keys.append((packed >> _U(_SLOT), (packed & _U((1 << _SLOT) - 1)).astype(np.int64) + base))
        base += k
    side = np.concatenate(sets)
    key, at = np.concatenate([k for k, _ in keys]), np.concatenate([a for _, a in keys])
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    same = key[1:] == key[:-1]
    some = np.r_[same, False] | np.r_[False, same]
    key, at = key[some], at[some]
    fp = side[at, 0]
    order = np.lexsort((fp, key))                    # equal sets count once
    key, at, fp = key[order], at[order], fp[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])] if len(key) else np.empty(0, bool)
    key, at, fp = key[new], at[new], fp[new]
    _, inverse, freq = np.unique(key, return_inverse=True, return_counts=True)
    freq = freq[inverse] if len(key) else np.empty(0, np.int64)
    keep = freq > 1
    return pa.table({"key": pa.array(key[keep].astype(np.int64)), "fp": pa.array(fp[keep]), "band": pa.array(side[at[keep], 1].astype(np.int32)),
                     "need": pa.array(side[at[keep], 2].astype(np.int32)), "freq": pa.array(freq[keep].astype(np.int64))})


def _may_link(of: str, other: str, words: list[str]):
    """Whether sizes and bit sketches of two sets (their columns end so) allow a link."""
    apart = reduce(add, (F.bit_count(F.col(c + of).bitwiseXOR(F.col(c + other))) for c in words))
    n, m = F.col("n" + of), F.col("n" + other)
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * apart <= n + m)


def _folded(about: DataFrame) -> DataFrame:
    """The sketches with the parts of equal remainders as one: parities add up."""
    step = len(_FOLDED)
    fold = [reduce(lambda x, y: x.bitwiseXOR(y), [F.col(c) for c in _SKETCH[i::step]]).alias(_FOLDED[i]) for i in range(step)]
    return about.select("node", *fold)


def _likely(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) that may link."""
    for side in "ab":
        pairs = pairs.join(about.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", *_SKETCH)]), side)
    return pairs.where(_may_link("_a", "_b", _SKETCH)).select("a", "b")


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(a, b, linked) of the pairs, by their whole sets; None without pairs."""
    pairs, rows = stored_with(sets.sparkSession, pairs, "pairs", F.count("*"))
    if not rows:
        return None
    # only the sets asked for travel, by one plan at every size
    a, b = (sets.join(pairs.select(F.col(c).alias("fp")).distinct(), "fp", "left_semi").select(F.col("fp").alias(c), F.col("h").alias("h" + c)) for c in "ab")

    def check(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])
    met = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("a", "b", "ha", "hb")
    return stored(sets.sparkSession, arrow_map(met, check, "a long, b long, linked boolean"), "compared")


def _prefixes(fps: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, fp, n, nth): each set's rarest shingles, as many as two linked sets must share one of, with their places.

    Of n shingles at least three quarters are in any partner, so of any n / 4 + 1 one is; taken
    in the same order (rare first) by all sets, partners share one within theirs."""
    def single(batches):
        for b in batches:
            for fp, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = np.frombuffer(h, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), fp)), pa.array(np.full(len(h), len(h)))], ["key", "fp", "n"])
    rows = stored(fps.sparkSession, arrow_map(sets.join(fps, "fp").select("fp", "h"), single, "key long, fp long, n long"), "singles")
    often = rows.groupBy("key").agg(F.count("*").alias("freq"))
    nth = F.row_number().over(Window.partitionBy("fp").orderBy("freq", "key"))
    return rows.join(often, "key").withColumn("nth", nth).where("nth <= n div 4 + 1 and freq > 1").select("key", "fp", "n", "nth")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with the label of their set's component; a set without one is its own."""
    if labels is None:
        return rows.withColumn("label", F.col("fp"))
    return rows.join(labels, rows.fp == labels.node, "left").select(*rows.columns, F.coalesce("label", "fp").alias("label"))


def _unsettled(kept: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of the groups whose members have different components, with their label."""
    rows = _labelled(kept, labels)
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return rows.join(mixed, "key")


def _once(rows: DataFrame) -> DataFrame:
    """One key of those with the same members: texts around one passage meet once, not at each of its shingles.
    A key that only one set holds pairs nothing and goes.

    Of shingles it is the first in the order of places, so it is the first of them in every member."""
    place = F.sum("nth") if "nth" in rows.columns else F.lit(0)
    members = rows.groupBy("key").agg(F.count("*").alias("many"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("y"),
                                      place.alias("place")).where("many > 1")
    return rows.join(members.groupBy("many", "x", "y").agg(F.min_by("key", F.struct("place", "key")).alias("key")).select("key"), "key")


def _to_pivot(rows: DataFrame, order) -> DataFrame:
    """Pairs (a, b) of a group's members with its first by ``order``, but for members known to be connected with it."""
    label = "label" if "label" in rows.columns else "fp"
    pivots = rows.groupBy("key").agg(F.min_by(F.struct(F.col("fp").alias("pivot"), F.col(label).alias("known")), order).alias("p")).select("key", "p.*")
    return rows.join(pivots, "key").where((F.col("fp") != F.col("pivot")) & (F.col(label) != F.col("known"))) \
        .select(F.least("fp", "pivot").alias("a"), F.greatest("fp", "pivot").alias("b")).distinct()


def _candidates(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of different components that their places, sizes and sketches allow to link.

    ``left``: key, fp, label, n, nth, main (the group's largest component) and folded bit sketch.  Rows outside the largest
    component meet the others, and it."""
    before = Window.partitionBy("fp").orderBy("nth").rowsBetween(-_BEFORE, -1)
    left = left.withColumn("before", F.collect_list("key").over(before))
    one, two = (left.select("key", "main", *[F.col(c).alias(c + e) for c in ("fp", "label", "n", "nth", "before", *_FOLDED)]) for e in ("_a", "_b"))
    one = one.where("label_a <> main").drop("main")
    once = (F.col("label_b") == F.col("main")) | (F.col("fp_a") < F.col("fp_b"))
    near = 7 * (F.col("nth_a") + F.col("nth_b") - 2) <= F.col("n_a") + F.col("n_b")
    first = ~F.arrays_overlap("before_a", "before_b")
    return one.join(two, (one.key == two.key) & (F.col("label_a") != F.col("label_b")) & once & near & _may_link("_a", "_b", _FOLDED) & first) \
        .select(F.least("fp_a", "fp_b").alias("a"), F.greatest("fp_a", "fp_b").alias("b"))


def link(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text", bucket_parts: int = 1_500_000,
         small_ids: int = 500_000) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    meta, total = stored_with(spark, _measure(texts, size), "sets", F.sum("n"))
    buckets, seed = pieces(total, bucket_parts), 1
    bounded_batches(spark)
    found = (_deal(texts, size, buckets, seed).repartition(buckets, "bucket").groupBy("bucket")
             .applyInArrow(_repeated, "key long, fp long, band int, need int, freq long"))
    found = stored(spark, found, "parts")
    mine = Window.partitionBy("fp", "band")
    kept = (found.withColumn("r", F.count("*").over(mine)).withColumn("nth", F.row_number().over(mine.orderBy("freq", "key")))
            .where(F.col("nth") <= F.col("r") + F.col("need")).select("key", "fp"))
    kept = stored(spark, _once(stored(spark, kept, "rare")), "groups")
    wanted = kept.select("fp").distinct().join(meta.where("fp is not null").groupBy("fp").agg(F.min("row").alias("row")), "fp")
    wanted, many = stored_with(spark, wanted, "wanted", F.count("*"))        # by a hash of id and text: rows without an id have one too
    ids = F.broadcast(wanted) if many <= small_ids else wanted                # 16 bytes a row

    def hashes(batches):
        for b in batches:
            sets = [shingle_set(t, size) for t in raw(b.column(1))]
            same = [i for i, h in enumerate(sets) if len(h) and _print(h) == b.column(0)[i].as_py()]
            words = np.array([bit_sketch(sets[i]) for i in same], np.int64).reshape(-1, _WORDS)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(same, pa.int64())), pa.array([len(sets[i]) for i in same], pa.int64()),
                                              pa.array([sets[i].astype("<u8").tobytes() for i in same], pa.binary()),
                                              *[pa.array(np.ascontiguousarray(w)) for w in words.T]], ["fp", "n", "h", *_SKETCH])
    sets = arrow_map(texts.join(ids, "row").select("fp", "text"), hashes, "fp long, n long, h binary, " + ", ".join(f"{c} long" for c in _SKETCH))
    sets = stored(spark, sets.dropDuplicates(["fp"]), "shingles")
    tidy(spark)
    about = sets.select(F.col("fp").alias("node"), "n", *_SKETCH)
    tested = labels = None

    def settle(pairs):
        """Compares the pairs that were not compared before."""
        nonlocal tested, labels
        more = _compare(_likely(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), about), sets)
        if more is not None:                         # else ten jobs would find nothing
            tested = more if tested is None else tested.union(more)
            labels = components(more.where("linked").select("a", "b"), labels)
        tidy(spark)
    settle(_to_pivot(kept, F.col("fp")))
    # groups whose members are connected already are settled; the sets of the others meet again by single shingles
    groups = stored(spark, _prefixes(_unsettled(kept, labels).select("fp").distinct(), sets), "prefixes")
    tidy(spark)
    settle(_to_pivot(_unsettled(groups, labels), F.xxhash64("fp", "key")))
    # what is left: members of different components
    left = _once(_unsettled(groups, labels))
    counts = left.groupBy("key", "label").agg(F.count("*").alias("c"))
    main = counts.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    left = stored(spark, left.join(main, "key").join(_folded(about).withColumnRenamed("node", "fp"), "fp"), "unsettled")
    tidy(spark)
    settle(_candidates(left).distinct())
    # the smallest document of each set, then of each component
    sets_of = _labelled(meta.where("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), labels)
    least = sets_of.groupBy("label").agg(F.min("least").alias("component"))
    component = sets_of.join(least, "label").select("fp", "component")
    return meta.join(component, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
