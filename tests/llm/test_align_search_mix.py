"""Alignment, ranked search and source mixing against brute force on small tables with odd rows."""

import hashlib
import heapq
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.llm import alignment, fp_search, mixing, tokens

A, B = tokens.public_path("byte_bpe_50k.json"), tokens.public_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, source string, block long, item int, h long, n long, key string, src string, size long"


def _texts():
    rng = np.random.default_rng(8)
    vocab = ["".join(rng.choice(list("abcdeéß中"), int(k))) for k in rng.integers(1, 9, 90)]
    say = lambda n: " ".join(rng.choice(vocab, n))
    return [None, "", " ", "  a  b ", "\n x\n\n y", "tab\tand\n line ", "U+2581 ▁ here", "<|endoftext|> </s> <s> <0x41> it's we'll", "x" * 3000, "中" * 800,
            "a\x00b \x1c c \x85d   e", "One one ONE oNe éÉ", say(5000), *[say(int(k)) for k in rng.integers(1, 90, 60)], say(30).upper(), say(30).title()]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s%d" % (i % 4) if i % 7 else None, 1, 2, 3, 4, "k", "s", 9) for i, t in enumerate(_texts())]
    rows += [(None, "no id here", "s1", None, None, None, None, None, None, None), rows[12], rows[12], rows[20]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _aligned(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    byte = tokens.byte_of()
    found, docs_of = [], Counter()
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        pa = [bytes(byte[c] for c in tok.id_to_token(i)) for i in a]
        pb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(pa) != (" " + t).encode() or b"".join(pb) != (" " + t).encode():
            found.append(([], []))
            continue
        ea, eb = np.cumsum([len(x) for x in pa]), np.cumsum([len(x) for x in pb])
        cuts = sorted(set(ea.tolist()) & set(eb.tolist()))
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, a, ea), (1, b, eb)):
            for i, e in zip(ids, ends.tolist()):
                groups[next(k for k, c in enumerate(cuts) if c >= e) if len(cuts) < 50 else int(np.searchsorted(cuts, e))][side].append(i)
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        found.append((groups, links))
        docs_of.update(set(links))
    best = defaultdict(int)
    for (x, _), n in docs_of.items():
        best[x] = max(best[x], n)
    out = []
    for groups, links in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(docs_of[p] == best[p[0]] for p in links),
                    sum(docs_of[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return out, docs_of


def test_alignment(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, counts = _aligned([t for _, t in rows])
    got = alignment.align(docs, A, B, with_groups=True)
    seen = [tuple(r)[:8] for r in got.documents.collect()]
    assert sorted(seen, key=repr) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert {(r.a_id, r.b_id): r.n_docs for r in got.pairs.collect()} == dict(counts)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got.documents.collect() if r.groups)


def test_alignment_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, _ = _aligned([t for _, t in rows])
    got = [tuple(r) for r in alignment.align(docs, A, B).documents.collect()]
    assert sorted(got) == sorted((i, *w) for (i, _), w in zip(rows, want))


def test_aligner_forgets_within_its_bound():
    work = alignment.Aligner(A, B, keep=5)
    one = [work.documents([t])[0].tolist() for t in ("some words here", "and quite other words than these", "some words here")]
    assert one[0] == one[2] and len(work.index) <= 5 + 6


def test_new_segments_are_encoded_at_once():
    work, calls = alignment.Aligner(A, B), []
    encode = work.encode_a
    work.encode_a = lambda s: calls.append(s) or encode(s)
    texts = [" ".join(f"w{i}x{i * 7919}é" for i in range(300)), "two  blanks ", " x", "a▁b plain", "漢字" * 40 + " ab" + "x" * 200]
    want, _ = _aligned(texts)
    sums, digests, *_ = work.documents(texts)
    assert len(calls) < 10                   # one by one only what is empty or ends in a blank
    assert sums.tolist() == [list(w[0:4]) for w in want]


def _ranked(rows, items, k):
    word = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(split(t))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(split(text)) if c[t])
            if s:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


@pytest.mark.parametrize("k,item_bytes,block_docs,leaf", [(50, 1 << 24, 16384, 32), (4, 2500, 9, 2), (3, 1 << 24, 1000, 1)])
def test_search(spark, docs, k, item_bytes, block_docs, leaf):
    texts = [t for t in _texts() if t]
    items = [(i, t) for i, t in enumerate(texts[12:30])] + [(3, texts[40]), (3, texts[40]), (None, texts[41]), (90, None), (91, ""), (92, "--"), (93, "nowhere")]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, doc_id string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in fp_search.search(docs, table, k=k, item_bytes=item_bytes, block_docs=block_docs, leaf=leaf)
           .select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == sorted(_ranked(rows, items, k), key=repr)


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    vectors = [np.unique(rng.zipf(1.3, 12) % 200) for _ in range(3000)]
    lens, term = np.array([len(v) for v in vectors]), np.concatenate(vectors)
    tf, n = rng.integers(1, 5, len(term)), rng.integers(20, 400, 3000)
    df = np.bincount(term, minlength=200)
    rank = np.empty(200, np.int64)
    rank[np.lexsort((np.arange(200), -df))] = np.arange(200)
    tree = fp_search.Tree(list(range(3000)), n, lens, term, tf, rank, 3000, int(n.sum()), 16)
    assert max(h - low for low, h, c in zip(tree.lo, tree.hi, tree.children) if not c) <= 3000 and len(tree.lo) > 100
    weight = np.array([int(1000 * math.log(6002 / (2 * d + 1))) for d in df.tolist()])
    m = 50 + 50 * n * 3000 // n.sum()
    doc = np.repeat(np.arange(3000), lens)
    gain = fp_search.saturate(tf, m[doc])
    scratch = np.zeros(200, np.int64)
    for _ in range(20):
        item = rng.choice(200, 6, replace=False).tolist()
        score = np.bincount(doc, np.where(np.isin(term, item), weight[term] * gain, 0), 3000).astype(int)
        want = sorted(((s, -i) for i, s in enumerate(score.tolist()) if s), reverse=True)[:10]
        got = sorted(((s, -tree.ids[d]) for s, d in tree.search(item, weight, 10, 0, scratch)), reverse=True)
        assert got == want and not scratch.any()
        floor = want[4][0]
        assert sorted((s for s, _ in tree.search(item, weight, 10, floor, scratch)), reverse=True) == [s for s, _ in want if s >= floor]


def _seats(weights, n):
    heap = [(-Fraction(w), i, 0) for i, w in enumerate(weights) if w]
    heapq.heapify(heap)
    got = [0] * len(weights)
    for _ in range(n):
        _, i, k = heapq.heappop(heap)
        got[i] += 1
        heapq.heappush(heap, (-Fraction(weights[i]) / (2 * k + 3), i, k + 1))
    return got


def test_apportionment(spark):
    rng = np.random.default_rng(4)
    groups = {"a": (rng.integers(1, 5000, 40).tolist(), 333), "b": ([7, 7, 7, 7], 2), "c": ([5], 9), "d": ([100_000, *[49] * 60], 1000), "e": ([3, 0, 9], 0),
              "f": (rng.integers(1, 10, 30).tolist(), 11), "g": ([0, 0], 0)}
    parties = spark.createDataFrame([(g, i, w) for g, (ws, _) in groups.items() for i, w in enumerate(ws)], "g string, p int, w long")
    seats = spark.createDataFrame([(g, n) for g, (_, n) in groups.items()], "g string, seats long")
    got = {(r.g, r.p): r.quota for r in mixing.apportion(parties, "g", "p", "w", seats).collect()}
    for g, (ws, n) in groups.items():
        assert [got[g, i] for i in range(len(ws))] == _seats(ws, n), g


def _targets(sizes, weights):
    whole, full = 1.5 * sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weights.items() if s not in full}
        level = (whole - sum(full.values())) / sum(left.values())
        over = [s for s, w in left.items() if level * w > 2 * sizes[s]]
        if not over:
            return full | {s: level * w for s, w in left.items()}
        full |= {s: 2 * sizes[s] for s in over}


@pytest.mark.parametrize("shard_words", [4_000_000, 900])
def test_mixing(docs, shard_words):
    rows = docs.select("doc_id", "text", "source").collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
    order = sorted((s for s in sizes if s is not None)) + [None]
    target = _targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    mix = mixing.mix(docs, shard_words=shard_words)
    got = mix.documents.collect()
    by_size = {sizes[s]: s for s in sizes}
    assert len(by_size) == len(sizes) and sorted(r.doc_id or -1 for r in got) == sorted(r.doc_id or -1 for r in rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.target == pytest.approx(target[by_size[r.source_size]])
        taken[by_size[r.source_size]] += r.taken
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r.doc_id or -1, size(r.text)) for r in rows)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 16 * 3 + 0.01 * target[s]
    again = mixing.mix(docs.repartition(7), shard_words=shard_words).documents.collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    quotas = {r.source: r.quota for r in mix.sources.collect()}
    per_shard = Counter()
    for r in mix.shards.collect():
        per_shard[r.source] += r.quota
    assert {s: q for s, q in quotas.items() if q} == dict(per_shard)


def test_taking_blocks():
    sizes = np.array([3, 0, 40, 7, 1])
    for quota in range(0, 12):
        got = mixing.take(sizes, quota, 10, 2, 5)
        assert (got <= 2 * sizes).all() and abs(got.sum() - min(10 * quota, 102)) <= 18
    assert mixing.take(np.array([0, 0]), 0, 10, 2, 5).tolist() == [0, 0]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    assert alignment.align(none, A, B).documents.count() == 0
    assert mixing.mix(none).documents.count() == 0
    assert fp_search.search(none, items).count() == 0 and fp_search.search(docs, items.limit(0)).count() == 0
