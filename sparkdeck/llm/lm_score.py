"""LM scoring by logistic context mixing over the bits of words.

The text is a sequence of tokens: words (A-Z in lower case) and one end.  A token is
spelled in bytes - a word ends with a blank, the end is a single tab - and every byte
in the bits of its Huffman code (from the byte counts of the training words, all 256
counted once more, so frequent bytes take few predictions).  Several predictors, each a table of bit counts under a hashed context
(last two bytes, last three, last four, the word so far, the word so far and the
document's class, the word so far and the word before it), propose a probability; a mixer adds their logits with weights
that a gate picks by how often the longest contexts were seen; an adaptive
probability map per gate refines the result.  A document's class is a hash of its most
frequent word, sent ahead at a cost of log10(classes), so the sum stays a true code length.

Learning.  Five contexts stay inside a token: Spark counts all (class, word) of the
training text exactly and tasks turn their share into bit counts.  The sixth spans the
word before (the end token before a text's first word): tasks count it over the ordered
training texts.  Pages of the tables are summed over tasks.  The mixer learns online over
all (class, word before, word) of the training text, weighted by frequency, with each own
occurrence taken out of the counts (otherwise it would trust contexts it has only seen
there); tasks' weights are averaged, map counts added.  The gate and five of the logits
belong to the (class, word) alone, so they are found once for all the words before it;
only the sixth predictor is looked up for every pair.  Tables have a fixed size (about
55 MB), which bounds the broadcast whatever the corpus; cells carry no check, so contexts
share cells once a corpus holds more of them than slots.

Scoring.  Blocks of whole documents keep their ordered tokens as indexes into the block's
words.  Training counts of words are joined to the blocks that ask for them; each block
scores its distinct (class, word before, word) once and sums its documents.  No vocabulary
is ever collected or broadcast.

Edge cases: NULL and empty texts hold only the end token; very long tokens are spelled
in full; repeated documents each count; a NULL id counts as the text '' for the split;
without training documents every count is zero and all tables are empty.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import mix
from .labels import fold
from .util import arrow_map, bounded_batches, pieces, raw, stored

CLASSES = 32
#: log2 of the slots of each predictor's table: last 2, 3, 4 bytes, prefix, prefix and class, prefix and the word before.
SLOTS = (18, 20, 20, 22, 22, 24)
INSIDE = 5                      # predictors whose context stays inside the token
PAGE = 1 << 15
GATES, BUCKETS = 64, 33
TOP, STEPS = 14, 32              # largest logit, and steps a unit in the table of costs
_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = b"\t"                     # no word holds it


# ---------------------------------------------------------------- counts on a byte scale

def quantise(n: np.ndarray) -> np.ndarray:
    """Counts as bytes: 0 to 16 exactly, then eight steps to a doubling."""
    n = np.asarray(n, float)
    return np.minimum(np.where(n < 16, np.rint(n), 16 + np.rint(8 * np.log2(np.maximum(n, 16) / 16))), 255).astype(np.uint16)


_VALUE = np.where(np.arange(256) < 16, np.arange(256), 16 * 2.0 ** ((np.arange(256) - 16) / 8))
_LESS = quantise(np.maximum(_VALUE - 1, 0))
_N1, _N0 = _VALUE[np.arange(65536) >> 8], _VALUE[np.arange(65536) & 255]
#: Cells as they are, then with a zero taken out, then with a one taken out.
_CELL = np.arange(65536)
_CELL = np.concatenate([_CELL, _CELL & 0xFF00 | _LESS[_CELL & 255], _LESS[_CELL >> 8].astype(np.int64) << 8 | _CELL & 255])
_LOGIT = np.log((_N1 + 0.3) / (_N0 + 0.3)).astype(np.float32)[_CELL]
_SEEN = np.minimum(np.frexp(_N1 + _N0)[1], 7).astype(np.uint8)       # 0, 1, 2-3, 4-7, ... as 0 to 7
_SEEN[0] = 0
_SEEN = _SEEN[_CELL]


# ---------------------------------------------------------------- bits and contexts

class Code:
    """A Huffman code of the 256 bytes: the inner node and the branch of each bit."""

    def __init__(self, counts: np.ndarray | None = None):
        heap = [(int(c) + 1, i, i) for i, c in enumerate(np.zeros(256, np.int64) if counts is None else counts)]
        heapq.heapify(heap)
        up = {}                                      # node -> (parent's number, branch)
        for k in range(255):
            (ca, _, a), (cb, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            up[a], up[b] = (k, 0), (k, 1)
            heapq.heappush(heap, (ca + cb, 256 + k, 256 + k))
        paths = []
        for byte in range(256):
            path, at = [], byte
            while at in up:
                path.append(up[at])
                at = 256 + path[-1][0]
            paths.append(path[::-1])
        self.size = np.array([len(p) for p in paths])
        self.first = np.cumsum(self.size) - self.size
        self.node = np.array([n for p in paths for n, _ in p], np.uint32)
        self.bit = np.array([b for p in paths for _, b in p], np.uint8)


def prints(words: list[bytes]) -> np.ndarray:
    """Hashes of words, for the context of the word that follows."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that start at ``first``, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Spelled:
    """Words of a class as bytes and bits.

    ``slots``: base slot of each predictor inside a token, a byte; ``byte``, ``node``, ``bit``: a bit."""

    def __init__(self, words: list[bytes], classes: np.ndarray, code: Code):
        spelled = [w if w == END else w + b" " for w in words]
        buf = np.frombuffer(b"".join(spelled), np.uint8)
        self.lens = lens = np.array([len(w) for w in spelled], np.int64)
        self.starts = starts = np.cumsum(lens) - lens
        word = np.repeat(np.arange(len(lens)), lens)
        at = np.arange(len(buf)) - starts[word]
        prev = []
        for k in range(1, 5):                        # the k-th last byte, 0 before the word
            p = np.zeros(len(buf), _U)
            p[k:] = buf[:-k]
            p[at < k] = 0
            prev.append(p)
        sums = np.cumsum(mix(buf.astype(_U) + at.astype(_U) * _U(256) + _U(1 << 40)))
        before = np.zeros(len(buf), _U)
        before[1:] = sums[:-1]
        self.prefix = prefix = before - before[starts][word]
        short = prev[0] | prev[1] << _U(8)
        contexts = [short | _U(1 << 48), short | prev[2] << _U(16) | _U(2 << 48), short | prev[2] << _U(16) | prev[3] << _U(24) | _U(3 << 48),
                    prefix ^ _U(0x51ED27), prefix + (classes.astype(_U)[word] + _U(1)) * _U(0x9E3779B97F4A7C15)]
        self.slots = [(mix(c) >> _U(64 - s)).astype(np.uint32) for c, s in zip(contexts, SLOTS)]
        self.size = code.size[buf]                   # bits of each byte
        self.byte = np.repeat(np.arange(len(buf)), self.size)
        place = _ranges(code.first[buf], self.size)
        self.node, self.bit = code.node[place], code.bit[place]
        self.bits = np.add.reduceat(self.size, starts)
        self.first = np.cumsum(self.bits) - self.bits

    def after(self, word: np.ndarray, last: np.ndarray):
        """(slot in the last table, number of the word's bit, bits of each pair) for pairs of a word and the hash before it."""
        byte = _ranges(self.starts[word], self.lens[word])
        context = self.prefix[byte] + np.repeat(mix(last ^ _U(0x2545F491)), self.lens[word])
        base = np.repeat((mix(context) >> _U(64 - SLOTS[INSIDE])).astype(np.uint32), self.size[byte])
        bits = self.bits[word]
        at = _ranges(self.first[word], bits)
        return base ^ self.node.take(at), at, bits


def _batches(word: np.ndarray, words: list[bytes], size: int):
    """Cuts of pairs, sorted by word, into about ``size`` bytes: (first pair, end, first word, end)."""
    lens = np.cumsum(np.array([len(w) + 1 for w in words], np.int64)[word])
    a = 0
    while a < len(word):
        b = max(a + 1, int(np.searchsorted(lens, (lens[a - 1] if a else 0) + size)))
        yield a, b, int(word[a]), int(word[b - 1]) + 1
        a = b


class Model:
    """Tables (counts of ones and zeros on the byte scale), byte code, gate weights and probability map."""

    def __init__(self, tables, code=None, weights=None, ones=None, seen=None):
        self.tables = tables
        self.code = Code() if code is None else code
        self.weights = np.tile(np.array([0.1, 0.15, 0.2, 0.3, 0.25, 0.2, 0.0], np.float32), (GATES, 1)) if weights is None else weights
        self.ones = np.zeros((GATES, BUCKETS)) if ones is None else ones
        self.seen = np.zeros((GATES, BUCKETS)) if seen is None else seen

    def inside(self, s: Spelled, less=0):
        """Of each bit: the logits of the predictors inside the token, the gate, their weighted sum and
        the last predictor's weight.  ``less`` (0, or 1 + the bit, times 65536) takes one occurrence out."""
        cells = [t.take(slot.take(s.byte) ^ s.node) + less for t, slot in zip(self.tables, s.slots)]
        x = [_LOGIT.take(c) for c in cells]
        gate = _SEEN.take(cells[3]).astype(np.int64) * 8 + _SEEN.take(cells[4])
        weights = np.ascontiguousarray(self.weights.T)
        total = weights[INSIDE + 1].take(gate)
        for w, xi in zip(weights, x):
            total += w.take(gate) * xi
        return x, gate, total, weights[INSIDE].take(gate)

    def map_place(self, logit):
        return np.rint((np.clip(logit, -8, 8) + 8) * 2).astype(np.int64)

    def costs(self) -> np.ndarray:
        """log10 of the refined probability of (gate, bit, logit in steps of 1 / STEPS): half the mixer's
        probability, half what happened at such logits under this gate."""
        logit = np.arange(2 * TOP * STEPS + 1) / STEPS - TOP
        p, k = 1 / (1 + np.exp(-logit)), self.map_place(logit)
        known = (self.ones[:, k] + 2 * p) / (self.seen[:, k] + 2)
        p = np.clip((p + known) / 2, 1e-7, 1 - 1e-7)
        return np.log10(np.stack([1 - p, p], 1)).astype(np.float32).ravel()

    def log10(self, words: list[bytes], classes: np.ndarray, last: np.ndarray | None = None, word: np.ndarray | None = None,
              batch: int = 1 << 15) -> np.ndarray:
        """log10 probability of each pair: a number of ``words`` (``word``, ascending; by default each once) after
        the word of hash ``last`` (by default the end token)."""
        word = np.arange(len(words)) if word is None else word
        last = np.repeat(prints([END]), len(word)) if last is None else last
        out, cost, width = np.zeros(len(word)), self.costs(), 2 * TOP * STEPS + 1
        for a, b, c, d in _batches(word, words, batch):
            s = Spelled(words[c:d], classes[c:d], self.code)
            _, gate, total, weight = self.inside(s)
            row = (gate * 2 + s.bit) * width
            slot, at, bits = s.after(word[a:b] - c, last[a:b])
            logit = total.take(at) + weight.take(at) * _LOGIT.take(self.tables[INSIDE].take(slot))
            np.clip(logit, -TOP, TOP, out=logit)
            place = ((logit + np.float32(TOP)) * np.float32(STEPS) + np.float32(0.5)).astype(np.int64)
            out[a:b] = np.add.reduceat(cost.take(row.take(at) + place), np.cumsum(bits) - bits, dtype=np.float64)
        return out

    def learn(self, words, classes, word, counts, last, batch: int = 1 << 14, rate: float = 0.05) -> None:
        """Online gradient steps over batches of pairs, then the map from the later half."""
        power = np.full_like(self.weights, 1e-3, dtype=np.float64)
        for a, b, c, d in _batches(word, words, batch):
            s = Spelled(words[c:d], classes[c:d], self.code)
            less = (s.bit.astype(np.int32) + 1) << 16
            x, gate, total, weight = self.inside(s, less)
            slot, at, bits = s.after(word[a:b] - c, last[a:b])
            x_last = _LOGIT.take(self.tables[INSIDE].take(slot) + less.take(at))
            logit = total.take(at) + weight.take(at) * x_last
            np.clip(logit, -TOP, TOP, out=logit)
            n = np.repeat(counts[a:b].astype(np.float32), bits)
            if a * 2 >= len(word):
                k = gate.take(at) * BUCKETS + self.map_place(logit)
                self.seen += np.bincount(k, n, minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)
                self.ones += np.bincount(k, n * s.bit.take(at), minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)
            err = (1 / (1 + np.exp(-logit)) - s.bit.take(at)) * n
            # summed over the words before first: the other inputs belong to the word
            k = len(s.bit)
            mass = np.bincount(gate, np.bincount(at, n, minlength=k), minlength=GATES) + 1e-9
            own, by_last = np.bincount(at, err, minlength=k), np.bincount(at, err * x_last, minlength=k)
            grad = np.stack([np.bincount(gate, v, minlength=GATES) for v in [*(own * xi for xi in x), by_last, own]], 1) / mass[:, None]
            power += grad * grad
            self.weights = (self.weights - rate * grad / np.sqrt(power)).astype(np.float32)


# ---------------------------------------------------------------- Spark jobs

def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of two kinds.  Words of a block: block, cls, word, idx, n (training tokens).
    Documents of a block: block, payload (the block's words and each document's tokens in order)."""
    def cut(batches):
        part, nth = TaskContext.get().partitionId(), 0
        z = zstandard.ZstdCompressor(level=1)
        size, place, rows = 0, defaultdict(count().__next__), []

        def flush():
            nonlocal size, place, rows, nth
            block = (part << 24) + nth
            nth += 1
            keys = list(place)
            order = np.argsort(mix(np.arange(len(keys), dtype=_U)))      # the mixer learns from a shuffled order
            keys = [keys[i] for i in order]
            number = np.empty(len(order), np.uint32)
            number[order] = np.arange(len(order))
            lens = np.array([len(r[2]) for r in rows], "<i8")
            tokens, held = number[np.concatenate([r[2] for r in rows])], np.array([r[1] for r in rows], bool)
            train = np.bincount(tokens, np.repeat(~held, lens), minlength=len(keys)).astype(np.int64)
            for a in range(0, len(keys), 50_000):
                some = keys[a:a + 50_000]
                yield _batch(block, [k[0] for k in some], [k[1:] for k in some], range(a, a + len(some)), train[a:a + 50_000])
            payload = b"".join([np.array([len(rows), len(keys)], "<i8").tobytes(), np.array([r[0] or 0 for r in rows], "<i8").tobytes(),
                                lens.tobytes(), tokens.astype("<u4").tobytes(), np.array([r[0] is None for r in rows], np.uint8).tobytes(),
                                held.tobytes(), bytes(k[0] for k in keys), b"\n".join(k[1:] for k in keys)])
            yield pa.RecordBatch.from_pydict({"block": [block], "cls": [None], "word": [None], "idx": [None], "n": [None],
                                              "payload": [z.compress(payload)]}, schema=_ROWS)
            size, place, rows = 0, defaultdict(count().__next__), []
        for b in batches:
            for doc, held, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw(b.column(2))):
                tokens = (text or b"").translate(_LOWER).split()
                counts = Counter(tokens)
                most = max(counts.values(), default=0)
                top = min((w for w, k in counts.items() if k == most), default=b"")
                cls = bytes([int(mix(np.array([int.from_bytes((top[:7] + bytes([len(top) & 255])).ljust(8, b"\0"), "little")], _U))[0] % CLASSES)])
                counts[END] = 1
                tokens.append(END)
                at = dict(zip(counts, map(place.__getitem__, [cls + w for w in counts])))
                rows.append((doc, held, np.fromiter(map(at.__getitem__, tokens), np.uint32, len(tokens))))
                size += len(text or b"") + 64
                if size >= block_bytes:
                    yield from flush()
        if rows:
            yield from flush()
    # bytes.split() also cuts at 0x0B and 0x0C, which [^\x20\x09-\x0D] does too
    return arrow_map(docs, cut, "block long, cls int, word binary, idx int, n long, payload binary")


_ROWS = pa.schema([("block", pa.int64()), ("cls", pa.int32()), ("word", pa.binary()), ("idx", pa.int32()), ("n", pa.int64()),
                   ("payload", pa.binary())])


def _batch(block, classes, words, idx, n):
    return pa.RecordBatch.from_arrays([pa.array([block] * len(words), pa.int64()), pa.array(classes, pa.int32()), pa.array(words, pa.binary()),
                                       pa.array(idx, pa.int32()), pa.array(n, pa.int64()), pa.nulls(len(words), pa.binary())], schema=_ROWS)


class Block:
    """The documents of a payload: ids, NULL ids, held-out flags, words with their classes and the tokens in order.
    What there is for each token is made when asked for and not kept: a worker holds one large array, not all."""

    def __init__(self, payload: bytes):
        data = zstandard.ZstdDecompressor().decompress(payload)
        n, k = (int(v) for v in np.frombuffer(data, "<i8", 2))
        self.ids, self.lens = np.frombuffer(data, "<i8", n, 16), np.frombuffer(data, "<i8", n, 16 + 8 * n)
        at, ends = 16 + 16 * n, np.cumsum(self.lens)
        self.tokens = np.frombuffer(data, "<u4", int(ends[-1]), at).copy()
        at += 4 * len(self.tokens)
        self.null, self.held = np.frombuffer(data, np.uint8, n, at).astype(bool), np.frombuffer(data, np.uint8, n, at + n).astype(bool)
        self.classes, self.words = np.frombuffer(data, np.uint8, k, at + 2 * n).astype(np.int32), data[at + 2 * n + k:].split(b"\n")

    def keys(self, training: bool = False) -> np.ndarray:
        """Each token's pair (word << 32 | word before), in order, of all or of the training documents."""
        ends, tokens = np.cumsum(self.lens), self.tokens
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[ends - self.lens] = tokens[ends - 1]                # a text starts after its class's end token
        if training:
            kept = np.repeat(~self.held, self.lens)
            tokens, before = tokens[kept], before[kept]
        keys = tokens.astype(_U)
        keys <<= _U(32)
        keys |= before
        return keys

    def add(self, values: np.ndarray) -> np.ndarray:
        """Sums of the tokens' values, a document."""
        return np.bincount(np.repeat(np.arange(len(self.lens), dtype=np.int32), self.lens), values, minlength=len(self.lens))

    def parts(self, keys):
        """(word, hash of the word before) of pairs."""
        return (keys >> _U(32)).view(np.int64), prints(self.words)[keys.astype(np.uint32)]      # the cast keeps the low half

    def training(self):
        """(words, classes, word, counts, last) of the distinct pairs of the training documents."""
        keys = self.keys(training=True)
        keys.sort()
        first = np.flatnonzero(np.r_[np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])
        n, keys = np.diff(first, append=len(keys)), keys[first]
        del first
        word, last = self.parts(keys)
        return self.words, self.classes, word, n, last


def _trained(batches):
    """The training pairs of each payload."""
    for b in batches:
        for payload in b.column(1):
            yield Block(payload.as_py()).training()


def _byte_code(vocab: DataFrame) -> Code:
    """The code by the byte counts of all training words."""
    def count(batches):
        total = np.zeros(256)
        for b in batches:
            for n, words in _by_count(b):
                total += n * np.bincount(np.frombuffer(b" ".join(words) + b" ", np.uint8), minlength=256)
        yield pa.RecordBatch.from_pydict({"byte": np.arange(256), "n": total})
    total = np.zeros(256)
    for r in arrow_map(vocab, count, "byte long, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect():   # 256 rows
        total[r["byte"]] = r["n"]
    return Code(total.astype(np.int64))


def _by_count(batch):
    """(count, words) of the rows of a batch, the words of equal counts together."""
    groups: dict[int, list[bytes]] = {}
    for w, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
        groups.setdefault(n, []).append(w)
    return groups.items()


def _planes(counts: np.ndarray) -> bytes:
    """Whole numbers as 32-bit integers, byte by byte (mostly zeros, so they compress well)."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _tables(vocab: DataFrame, payloads: DataFrame, code: Code, parts: int, shares: int) -> list[np.ndarray]:
    """The predictors' counts over all training words and pairs, on the byte scale."""
    def pages(some, groups):
        """Sums of (table, slot * 2 + bit, counts), as the pages that hold any."""
        sums = {t: np.zeros(2 << SLOTS[t], np.float32) for t in some}
        for t, cell, n in groups:
            np.add.at(sums[t], cell, n)
        z = zstandard.ZstdCompressor(level=1)
        for t in some:
            for p in range(0, 1 << SLOTS[t], PAGE):
                page = sums[t][2 * p:2 * (p + PAGE)]
                if page.any():
                    yield pa.RecordBatch.from_pydict({"tab": [t], "page": [p], "data": [z.compress(_planes(page))]},
                                                     schema=pa.schema([("tab", pa.int32()), ("page", pa.int32()), ("data", pa.binary())]))
            del sums[t]

    def cells_of_words(batches):
        for b in batches:
            if b.num_rows:
                s = Spelled(b.column(0).to_pylist(), b.column(1).to_numpy(), code)
                n = np.repeat(b.column(2).to_numpy().astype(np.float32), s.bits)
                for t, slot in enumerate(s.slots):
                    yield t, (slot[s.byte] ^ s.node).astype(np.int64) * 2 + s.bit, n

    def cells_of_pairs(batches):
        for words, classes, word, counts, last in _trained(batches):
            for a, b, c, d in _batches(word, words, 1 << 15):
                s = Spelled(words[c:d], classes[c:d], code)
                slot, at, bits = s.after(word[a:b] - c, last[a:b])
                yield INSIDE, slot.astype(np.int64) * 2 + s.bit[at], np.repeat(counts[a:b].astype(np.float32), bits)
            del words, classes, word, counts, last      # before the next block is read

    def add(rows: pa.Table) -> pa.Table:
        z, total = zstandard.ZstdDecompressor(), np.zeros(2 * PAGE)
        for d in rows["data"].to_pylist():
            total += np.frombuffer(z.decompress(d), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
        cells = quantise(total[1::2]) << 8 | quantise(total[::2])
        data = zstandard.ZstdCompressor(level=1).compress(cells.astype("<u2").tobytes())
        return pa.table({"tab": rows["tab"][:1], "page": rows["page"][:1], "data": pa.array([data], pa.binary())})
    schema = "tab int, page int, data binary"
    inside = arrow_map(vocab.coalesce(parts), lambda b: pages(range(INSIDE), cells_of_words(b)), schema)
    across = arrow_map(payloads.coalesce(shares), lambda b: pages([INSIDE], cells_of_pairs(b)), schema)
    tables, z = [np.zeros(1 << s, np.uint16) for s in SLOTS], zstandard.ZstdDecompressor()
    # the tables have a fixed size, so do the pages that the driver gets
    for r in inside.union(across).groupBy("tab", "page").applyInArrow(add, schema).collect():
        tables[r["tab"]][r["page"]:r["page"] + PAGE] = np.frombuffer(z.decompress(bytes(r["data"])), "<u2")
    return tables


def fit(vocab: DataFrame, payloads: DataFrame, total: int, share_rows: int = 500_000, share_tokens: int = 8_000_000):
    """Byte code, tables, gate weights and map from (word, cls, n) and the ordered texts of all training text, and the
    broadcast of the tables: scoring reads the same one, since each sent lies on every executor's disk."""
    spark = vocab.sparkSession
    code = _byte_code(vocab)
    tables = spark.sparkContext.broadcast(_tables(vocab, payloads, code, pieces(vocab.count(), share_rows), pieces(total, share_tokens)))

    def learn(batches):
        m, mass = Model(tables.value, code), 0.0
        for words, classes, word, counts, last in _trained(batches):
            m.learn(words, classes, word, counts, last)
            mass += float(counts.sum())
        if mass:
            yield pa.RecordBatch.from_pydict({"n": [mass], "data": [np.concatenate([m.weights.ravel(), m.ones.ravel(), m.seen.ravel()]).astype("<f8").tobytes()]},
                                             schema=pa.schema([("n", pa.float64()), ("data", pa.binary())]))
    k, m = GATES * (len(SLOTS) + 1), GATES * BUCKETS
    shares = arrow_map(payloads.coalesce(pieces(total, share_tokens // 2)), learn, "n double, data binary")

    def add(rows: pa.Table) -> pa.Table:
        ordered = sorted(zip(rows["data"].to_pylist(), rows["n"].to_pylist()))       # sums in one order at every run
        mass, parts = np.array([n for _, n in ordered]), np.stack([np.frombuffer(d, "<f8") for d, _ in ordered])
        parts[:, :k] *= mass[:, None]
        parts = parts.sum(0)
        parts[:k] /= mass.sum()
        return pa.table({"n": [mass.sum()], "data": [parts.astype("<f8").tobytes()]}, schema=pa.schema([("n", pa.float64()), ("data", pa.binary())]))
    # a few kilobytes from each task, averaged in two steps
    some = shares.groupBy(F.pmod(F.hash("data"), F.lit(64)).alias("g")).applyInArrow(add, "n double, data binary")
    whole = some.groupBy(F.lit(0).alias("g")).applyInArrow(add, "n double, data binary").collect()
    if not whole:
        return Model(tables.value, code), tables
    data = np.frombuffer(bytes(whole[0]["data"]), "<f8")
    return Model(tables.value, code, data[:k].reshape(GATES, -1).astype(np.float32), data[k:k + m].reshape(GATES, BUCKETS), data[k + m:].reshape(GATES, BUCKETS)), tables


def score(docs: DataFrame, held_out=None, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes (spelled) and bits_per_byte.  Learns from the documents where ``held_out`` is false."""
    spark = docs.sparkSession
    held = fold(id_col, 7) == 2 if held_out is None else held_out
    rows = stored(spark, _blocks(docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text")),
                                 block_bytes), "blocks")
    asked = rows.where("payload is null").select("block", "cls", "word", "idx", "n")
    # dealt by word once: a block names a word once a class, so nothing is lost by not adding before
    all_of_word = Window.partitionBy("word")
    vocab = stored(spark, asked.select("cls", "word", "n").repartition("word").groupBy("cls", "word").agg(F.sum("n").alias("n"))
                   .withColumn("c", F.sum("n").over(all_of_word)), "vocabulary")
    known = vocab.where("n > 0").select("word", "cls", "n")
    total, distinct = vocab.where("n > 0").agg(F.sum("n"), F.sum(F.col("n") / F.col("c"))).first()
    total, distinct = int(total or 0), round(distinct or 0)       # each word's classes sum to one
    payloads = rows.where("payload is not null").select("block", "payload")
    model, tables = fit(known, payloads, total)
    sent = spark.sparkContext.broadcast((model.code, model.weights, model.ones, model.seen))

    answers = asked.select("block", "idx", "word", "n").withColumn("c", F.sum("n").over(all_of_word)).select("block", "idx", "c")

    def bundle(batches):
        """Answers of a task, a few large rows for each block instead of one for each word."""
        held, n = [], 0

        def flush():
            t = pa.Table.from_batches(held).sort_by("block")
            block = t["block"].to_numpy()
            edge = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)]
            cols = [t[c].to_numpy().astype(k) for c, k in (("idx", "<u4"), ("c", "<i8"))]
            data = [b"".join(c[a:e].tobytes() for c in cols) for a, e in zip(edge, edge[1:])]
            return pa.RecordBatch.from_arrays([pa.array(block[edge[:-1]]), pa.array(data, pa.binary())], ["block", "data"])
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
                if n >= 500_000:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()
    bundles = arrow_map(answers, bundle, "block long, data binary")
    base = math.log10(total + distinct + 1)

    def sum_up(docs_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        block, m = Block(docs_of["payload"][0].as_py()), Model(tables.value, *sent.value)
        c = np.zeros(len(block.words))
        for data in answers_of["data"].to_pylist():
            k = len(data) // 12
            c[np.frombuffer(data, "<u4", k)] = np.frombuffer(data, "<i8", k, 4 * k)
        keys, pair = np.unique(block.keys(), return_inverse=True)
        word, last = block.parts(keys)
        del keys
        p, size, n = m.log10(block.words, block.classes, last, word), np.array([len(w) for w in block.words]), len(block.ids)
        value = block.add(p[pair]) - math.log10(CLASSES)
        del p, pair, word, last
        add = lambda v: block.add(v[block.tokens])
        tokens, nbytes = block.lens, add(size + 1) - 1
        return pa.table({"doc_id": pa.array(block.ids, pa.int64(), mask=block.null), "held_out": pa.array(block.held),
                         "n_tokens": pa.array(tokens.astype(np.int64)), "n_known": pa.array(add((c > 0).astype(float)).astype(np.int64)),
                         "train_tokens": pa.array(np.full(n, total, np.int64)),
                         "base_score": pa.array(add(np.log10(c + 1)) - tokens * base), "score": pa.array(value),
                         "n_bytes": pa.array(nbytes.astype(np.int64)), "bits_per_byte": pa.array(-value / math.log10(2) / nbytes)})
    bounded_batches(spark)
    return payloads.groupBy("block").cogroup(bundles.groupBy("block")).applyInArrow(
        sum_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                "n_bytes long, bits_per_byte double")
