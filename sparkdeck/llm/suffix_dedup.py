"""Exact removal of repeated byte strings by a common-prefix-aware merge sort of suffixes.

A byte goes when it lies in a string of ``length`` bytes that also starts anywhere
else.  Sorting a suffix for every byte would move hundreds of bytes for each, so only
suffixes at anchors are sorted: every window of ``length`` bytes picks the position
with the least hash of a ``length / 2``-byte gram inside it, so equal windows pick the
same position in them.  Successive windows with one anchor form a run.

1.  Runs are grouped by their anchor's gram.  A gram met once ends its run.  Runs equal
    in full (64-bit fingerprints) are closed: all their windows repeat; one of them
    stands for the rest.  Runs that share only the gram stay open - a few at the ends of
    each repeated passage.
2.  Open runs and their stand-ins go to suffix sorting.  Each block sorts its suffixes
    (from the anchor on) and sends them front-coded, without the prefix shared with the
    one before, to the bucket of the gram: only suffixes with equal first bytes must meet.
3.  A bucket merges the sorted runs with a loser tree that keeps, for each run's head,
    the prefix shared with the last output, compares characters only behind it, and so
    yields the order together with all neighbours' common prefixes.  From these, the
    suffixes equal in their first d bytes are intervals; a window that starts i bytes
    before the anchor repeats if another member of its interval for d = length - i has
    the same i bytes to the left.
4.  Each block marks its repeated windows and drops the covered bytes.

Blocks are a few megabytes of whole documents.  Grams that more than ``most`` open runs
share are not merged in one task: their windows' fingerprints are grouped by Spark
instead, one small row each.

Edge cases: NULL and empty texts keep nothing and lose nothing; texts shorter than
``length`` stay whole; equal documents of ``length`` bytes or more are removed
entirely, all of them; NULL and repeated ids keep a row each; an empty table, none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix
from .util import arrow_map, bounded_batches, pieces, raw, stored, text_bytes

_U = np.uint64
_POS = 31                        # bits of a position within a block


def _join(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of strings from those of their halves."""
    y = a * _U(salt)
    y += b
    y ^= y >> _U(31)
    y *= _U(0x9E3779B97F4A7C15)
    return y


class Grams:
    """Hashes of all strings of any length between 64 and 128 bytes of a buffer."""

    def __init__(self, buf: np.ndarray):
        h = (buf.astype(_U) + _U(1)) * _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        for k, salt in ((1, 0x9E3779B1), (2, 0x85EBCA6B), (4, 0xC2B2AE35), (8, 0x27D4EB2F), (16, 0x165667B1), (32, 0xA0761D65)):
            h = _join(h[:-k], h[k:], salt)
            if not len(h):
                break
        self.h = h

    def of(self, size: int) -> np.ndarray:
        return _join(self.h[:len(self.h) - (size - 64)], self.h[size - 64:], 0xE7037ED1) if len(self.h) > size - 64 else self.h[:0]


def runs_of(buf: np.ndarray, lens: np.ndarray, length: int, step: int = 1 << 15):
    """(first window, last window, anchor, anchor's gram, fingerprint) of each run of the documents in ``buf``.

    ``step`` windows are looked at at a time, so the work arrays stay in the processor's
    cache whatever the size of the buffer; a run that goes on in the next step is joined.
    The fingerprint of a run is that of the grams at both ends and in the middle, which
    cover all its bytes."""
    k = length // 2
    span, most = length - k + 1, max(0, len(buf) - length + 1)
    start = np.cumsum(lens) - lens
    inside = np.zeros(len(buf) + 1, np.int8)         # windows inside one document
    long = lens >= length
    inside[start[long]] += 1
    inside[(start + lens - length + 1)[long]] -= 1
    np.cumsum(inside, out=inside)
    place, found = np.arange(step + span, dtype=_U), []
    for s in range(0, most, step):
        e = min(s + step, most)
        at = np.flatnonzero(inside[s:e])
        if not len(at):
            continue
        g = Grams(buf[s:e - 1 + length]).of(k)
        least, have = mix(g), 1
        least >>= _U(_POS)
        least <<= _U(_POS)
        least |= place[:len(g)]                      # ties: the leftmost
        while have * 2 <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
        a = (least[at] & _U((1 << _POS) - 1)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)])
        first, last, a = at[new], at[np.r_[new[1:] - 1, len(at) - 1]], a[new]
        found.append((first + s, last + s, a + s, g[a], g[first], g[first + k], g[last + length - k]))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(_U), none.astype(_U)
    first, last, anchor, gram, head, middle, tail = (np.concatenate(c) for c in zip(*found))
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (first[1:] != last[:-1] + 1)])
    end = np.r_[new[1:] - 1, len(first) - 1]
    first, last = first[new], last[end]
    whole = mix(_join(_join(head[new], middle[new], 0x8EBC6AF1), tail[end], 0x589965CD) + (last - first).astype(_U))
    return first, last, anchor[new], gram[new], whole


# ---------------------------------------------------------------- blocks of documents

def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    def cut(batches):
        part, nth, size, rows = TaskContext.get().partitionId(), 0, 0, []
        z = zstandard.ZstdCompressor(level=3)

        def flush():
            head = [np.array([r[0] or 0 for r in rows], "<i8"), np.array([r[0] is None for r in rows], np.uint8),
                    np.array([len(r[1]) for r in rows], "<i8")]
            data = np.array([len(rows)], "<i8").tobytes() + b"".join(h.tobytes() for h in head) + b"".join(r[1] for r in rows)
            return pa.RecordBatch.from_arrays([pa.array([(part << 24) + nth], pa.int64()), pa.array([z.compress(data)], pa.binary())], ["block", "payload"])
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), raw(b.column(1))):
                rows.append((doc, text or b""))
                size += len(text or b"")
                if size >= block_bytes:
                    yield flush()
                    nth, size, rows = nth + 1, 0, []
        if rows:
            yield flush()
    return arrow_map(docs, cut, "block long, payload binary")


def _open(payload: bytes):
    """(ids, null flags, lengths, text) of a block."""
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    return (np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, np.uint8, n, 8 + 8 * n).astype(bool), np.frombuffer(data, "<i8", n, 8 + 9 * n),
            np.frombuffer(data, np.uint8, offset=8 + 17 * n))


def _by_bucket(bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    edge = np.r_[np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]), len(order)] if len(order) else [0]
    for a, e in zip(edge[:-1], edge[1:]):
        yield int(bucket[order[a]]), order[a:e]


# ---------------------------------------------------------------- step 1: grams

_STATE = "block long, closed binary, active binary"


def _grams(length: int, buckets: int):
    def emit(batches):
        for b in batches:
            for block, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                _, _, lens, buf = _open(payload)
                first, _, _, gram, whole = runs_of(buf, lens, length)
                if not len(first):
                    continue
                got = [(k, np.array([block], "<i8").tobytes() + gram[i].tobytes() + whole[i].tobytes() + i.astype("<u4").tobytes())
                       for k, i in _by_bucket((mix(gram) % _U(buckets)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int64()), pa.array([d for _, d in got], pa.binary())], ["bucket", "data"])
    return emit


def _classes(most: int):
    def find(rows: pa.Table) -> pa.Table:
        """Closed runs, and the open ones with their stand-ins, of each block.  ``active`` rows:
        run, kind (1 open, 2 stand-in; plus 2 for grams that too many runs share)."""
        blocks, parts = [], []
        for data in rows["data"].to_pylist():
            n = (len(data) - 8) // 20
            blocks.append(np.full(n, np.frombuffer(data, "<i8", 1)[0]))
            parts.append((np.frombuffer(data, "<u8", n, 8), np.frombuffer(data, "<u8", n, 8 + 8 * n), np.frombuffer(data, "<u4", n, 8 + 16 * n)))
        block = np.concatenate(blocks)
        gram, whole, run = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((run, block, whole, gram))
        gram, whole, run, block = gram[order], whole[order], run[order], block[order]
        new_gram = np.r_[True, gram[1:] != gram[:-1]]
        new_class = new_gram | np.r_[True, whole[1:] != whole[:-1]]
        group, cls = np.cumsum(new_gram) - 1, np.cumsum(new_class) - 1
        closed = np.bincount(cls)[cls] > 1
        shared = np.bincount(group)[group] > 1
        is_open = shared & ~closed
        any_open = (np.bincount(group, is_open) > 0)[group]
        active = is_open | (closed & new_class & any_open)
        crowd = (np.bincount(group, active) > most)[group]
        kind = np.where(is_open, 1, 2) + np.where(crowd, 2, 0)
        out = []
        touched = closed | active
        for b, i in _by_bucket(block[touched]):
            j = np.flatnonzero(touched)[i]
            out.append((b, run[j[closed[j]]].astype("<u4").tobytes(),
                        np.column_stack([run[j[active[j]]], kind[j[active[j]]]]).astype("<u4").tobytes()))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "closed": pa.array([o[1] for o in out], pa.binary()),
                         "active": pa.array([o[2] for o in out], pa.binary())})
    return find


# ---------------------------------------------------------------- step 2: sorted suffix runs

def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, hi = known, n                                # equal before lo, different before hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(rows: list[tuple]) -> bytes:
    """Rows (suffix, left, first i, last i, block, run, open) sorted by suffix, as one binary run."""
    rows.sort(key=lambda r: r[0])
    shared = [0] + [common(x[0], y[0], 0) for x, y in zip(rows, rows[1:])]
    tails = [r[0][s:] for r, s in zip(rows, shared)]
    meta = np.array([(s, len(t), len(r[1]), r[2], r[3], r[6]) for r, s, t in zip(rows, shared, tails)], "<u4")
    where = np.array([(r[4], r[5]) for r in rows], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(
        np.array([len(rows)], "<i8").tobytes() + meta.tobytes() + where.tobytes() + b"".join(tails) + b"".join(r[1] for r in rows))


def decode(data: bytes):
    """The rows of a front-coded run, each with the prefix shared with the row before."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    meta = np.frombuffer(data, "<u4", 6 * n, 8).reshape(n, 6).tolist()
    where = np.frombuffer(data, "<i8", 2 * n, 8 + 24 * n).reshape(n, 2).tolist()
    at = 8 + 40 * n
    left_at, last = at + sum(m[1] for m in meta), b""
    for m, w in zip(meta, where):
        last = last[:m[0]] + data[at:at + m[1]]
        yield last, m[0], (data[left_at:left_at + m[2]], m[3], m[4], w[0], w[1], m[5])
        at, left_at = at + m[1], left_at + m[2]


def merge(runs: list) -> tuple[list, list[int]]:
    """All rows of sorted runs in order, with the prefix each shares with the one before.

    A loser tree: a node keeps the run that lost there.  Each run's head carries the
    prefix it shares with the last output; of two heads the one that shares more is the
    smaller, and only if they share the same amount are characters behind it compared.
    The loser then knows what it shares with the winner, the next output."""
    sources = [iter(r) for r in runs]
    size = 1 << max(0, len(sources) - 1).bit_length()
    heads = [next(s, None) for s in sources] + [None] * (size - len(sources))
    shares = [0] * size
    tree = [0] * size

    def smaller(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's share becomes that with the winner."""
        a, b = heads[x], heads[y]
        if a is None or b is None:
            return (y, x) if a is None else (x, y)
        if shares[x] != shares[y]:
            return (x, y) if shares[x] > shares[y] else (y, x)
        k = common(a[0], b[0], shares[x])
        win, lose = (x, y) if a[0][k:k + 1] <= b[0][k:k + 1] else (y, x)
        shares[lose] = k
        return win, lose

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, tree[node] = smaller(build(2 * node), build(2 * node + 1))
        return win
    best, rows, lcps = build(1), [], []
    while heads[best] is not None:
        rows.append(heads[best])
        lcps.append(shares[best])
        heads[best] = nxt = next(sources[best], None)
        shares[best] = nxt[1] if nxt else 0          # the run's own order tells what its next head shares
        node = (best + size) // 2
        while node:
            best, tree[node] = smaller(best, tree[node])
            node //= 2
    return rows, lcps


def repeats(rows: list, lcps: list[int], length: int) -> np.ndarray:
    """For merged rows, which windows (i bytes before the anchor) repeat: rows x (i)."""
    n, most = len(rows), length // 2 + 1
    lo, hi = np.array([r[2][1] for r in rows]), np.array([r[2][2] for r in rows])
    left = np.zeros((n, most), np.uint8)             # column c: the byte c + 1 before the anchor
    for j, r in enumerate(rows):
        if r[2][0]:
            left[j, :len(r[2][0])] = np.frombuffer(r[2][0], np.uint8)[::-1]
    out, lcp, hashed = np.zeros((n, most), bool), np.array(lcps), np.zeros(n, _U)
    for i in range(most):
        if i:
            hashed = _join(hashed, left[:, i - 1].astype(_U) + _U(1), 0x9E3779B1)
        some = np.flatnonzero((lo <= i) & (i <= hi))
        if len(some) < 2:
            continue
        interval = np.cumsum(lcp < length - i)[some]
        order = np.lexsort((hashed[some], interval))
        a, b = interval[order], hashed[some][order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        out[some[order], i] = np.r_[same, False] | np.r_[False, same]
    return out


def _active(state: pa.Table) -> np.ndarray:
    parts = [np.frombuffer(d, "<u4").reshape(-1, 2) for d in state["active"].to_pylist()]
    return np.concatenate(parts).astype(np.int64) if parts else np.empty((0, 2), np.int64)


def _suffixes(length: int, buckets: int):
    def cut(blocks: pa.Table, state: pa.Table) -> pa.Table:
        """Front-coded suffix runs of a block; window fingerprints where a gram is too common."""
        bucket, data, crowd = [], [], []
        act = _active(state)
        if blocks.num_rows and len(act):
            block = blocks["block"][0].as_py()
            _, _, lens, buf = _open(blocks["payload"][0].as_py())
            first, last, anchor, gram, _ = runs_of(buf, lens, length)
            text = buf.tobytes()
            few = act[act[:, 1] <= 2]
            for k, i in _by_bucket((mix(gram[few[:, 0]]) % _U(buckets)).astype(np.int64)):
                rows = []
                for run, kind in few[i].tolist():
                    a, p, q = int(anchor[run]), int(first[run]), int(last[run])
                    rows.append((text[a:q + length], text[p:a], a - q if a > q else 0, a - p, block, run, int(kind == 1)))
                bucket.append(k)
                data.append(front_code(rows))
            many = act[act[:, 1] > 2]
            for run, kind in many.tolist():
                p, q = int(first[run]), int(last[run])
                for w in range(p, q + 1):
                    crowd.append((hashlib.blake2b(text[w:w + length], digest_size=16).digest(), block, run, w - p, kind == 3))
        n, m = len(bucket), len(crowd)
        return pa.table({"bucket": pa.array(bucket + [None] * m, pa.int64()), "data": pa.array(data + [None] * m, pa.binary()),
                         "window": pa.array([None] * n + [c[0] for c in crowd], pa.binary()),
                         "block": pa.array([None] * n + [c[1] for c in crowd], pa.int64()),
                         "run": pa.array([None] * n + [c[2] for c in crowd], pa.int64()),
                         "off": pa.array([None] * n + [c[3] for c in crowd], pa.int32()),
                         "is_open": pa.array([None] * n + [bool(c[4]) for c in crowd], pa.bool_())})
    return cut


def _merged(length: int):
    def find(rows: pa.Table) -> pa.Table:
        """Repeated windows of a bucket's open runs: block, run, windows (bits from the run's first)."""
        merged, lcps = merge([decode(d) for d in rows["data"].to_pylist()])
        hits = repeats(merged, lcps, length)
        out = []
        for j in np.flatnonzero(hits.any(1)).tolist():
            _, lo, hi, block, run, is_open = merged[j][2]
            if is_open:
                out.append((block, run, np.packbits(hits[j, lo:hi + 1][::-1]).tobytes()))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "run": pa.array([o[1] for o in out], pa.int64()),
                         "windows": pa.array([o[2] for o in out], pa.binary())})
    return find


# ---------------------------------------------------------------- the operator

def deduplicate(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4 << 20,
                bucket_bytes: int = 24 << 20, most: int = 50_000) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left)."""
    if not 128 <= length <= 256 or length % 2:
        raise ValueError("length must be even and from 128 to 256")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = pieces(text_bytes(texts, "text"), bucket_bytes)
    blocks = stored(spark, _blocks(texts, block_bytes), "blocks")
    bounded_batches(spark)
    state = (blocks.mapInArrow(_grams(length, buckets), "bucket long, data binary").repartition(buckets, "bucket")
             .groupBy("bucket").applyInArrow(_classes(most), _STATE))
    state = stored(spark, state, "state")
    cut = (blocks.groupBy("block").cogroup(state.where(F.octet_length("active") > 0).select("block", "active").groupBy("block"))
           .applyInArrow(_suffixes(length, buckets), "bucket long, data binary, window binary, block long, run long, off int, is_open boolean"))
    cut = stored(spark, cut, "suffixes")
    found = (cut.where("bucket is not null").select("bucket", "data").repartition(buckets, "bucket")
             .groupBy("bucket").applyInArrow(_merged(length), "block long, run long, windows binary"))
    rows = cut.where("window is not null").select("window", "block", "run", "off", "is_open")
    twice = rows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    crowded = rows.where("is_open").join(twice, "window").select("block", "run", "off")
    marks = (found.select("block", F.lit(None).cast("binary").alias("closed"), "run", "windows", F.lit(None).cast("int").alias("off"))
             .unionByName(crowded.select("block", F.lit(None).cast("binary").alias("closed"), "run", F.lit(None).cast("binary").alias("windows"), "off"))
             .unionByName(state.where(F.octet_length("closed") > 0).select("block", "closed", F.lit(None).cast("long").alias("run"),
                                                                         F.lit(None).cast("binary").alias("windows"), F.lit(None).cast("int").alias("off"))))

    def finish(block: pa.Table, marked: pa.Table) -> pa.Table:
        ids, null, lens, buf = _open(block["payload"][0].as_py())
        start, n = np.cumsum(lens) - lens, len(lens)
        removed, spans, text, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), buf.tobytes(), {}
        if marked.num_rows:
            gone = np.zeros(len(buf) + 1, np.int32)
            first, last, _, _, _ = runs_of(buf, lens, length)
            for closed, run, windows, off in zip(*(marked[c].to_pylist() for c in ("closed", "run", "windows", "off"))):
                if closed is not None:
                    i = np.frombuffer(closed, "<u4")
                    np.add.at(gone, first[i], 1)
                    np.add.at(gone, last[i] + length, -1)
                    continue
                at = first[run] + (np.array([off]) if windows is None else
                                   np.flatnonzero(np.unpackbits(np.frombuffer(windows, np.uint8))[:last[run] - first[run] + 1]))
                np.add.at(gone, at, 1)
                np.add.at(gone, at + length, -1)
            bad = np.cumsum(gone[:-1], out=gone[:-1]) > 0
            some = np.flatnonzero(lens)                # a removed string lies within one document
            removed[some] = np.add.reduceat(bad.astype(np.int64), start[some])
            begins = bad.copy()
            begins[1:] &= ~bad[:-1]
            begins[start[some]] = bad[start[some]]
            spans[some] = np.add.reduceat(begins.astype(np.int64), start[some])
            for j in np.flatnonzero(removed).tolist():
                s, e = int(start[j]), int(start[j] + lens[j])
                kept[j] = buf[s:e][~bad[s:e]].tobytes()
        left = [kept[j] if j in kept else text[s:s + m] for j, (s, m) in enumerate(zip(start.tolist(), lens.tolist()))]
        return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=null), "n_bytes": pa.array(lens, pa.int64()),
                         "n_removed": pa.array(removed), "n_spans": pa.array(spans),
                         "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()), "kept": pa.array(left, pa.binary())})
    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def as_text(rows: DataFrame, key_col: str, bytes_col: str) -> DataFrame:
    """(key, text) with the bytes as text; a character that lost some of its bytes goes whole."""
    def decode_all(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else x.decode("utf-8", "ignore") for x in b.column(1).to_pylist()], pa.string())],
                                             [key_col, bytes_col])
    kind = rows.schema[key_col].dataType.simpleString()
    return arrow_map(rows.select(key_col, bytes_col), decode_all, f"`{key_col}` {kind}, `{bytes_col}` string")
