"""The operators against brute force on small tables with NULLs, ties, repeats and clashing columns."""

import hashlib
import re
import struct
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkdeck.llm import (ann, decontam, jaccard_join, lm_score, packing, pu_quality, suffix_dedup, token_store, tokens,
                           toxicity, url_filter)
from sparkdeck.llm.components import components
from sparkdeck.llm.util import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, fp long, block long"


def _texts():
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdefgéß"), 4)) for _ in range(120)]
    say = lambda n: " ".join(rng.choice(vocab, n))
    base, passage = say(120), say(45)
    rows = [None, "", " \n\t ", "one", "Two words", base, base, base.upper(), passage, say(4000), "x" * 700, "ab" * 400]
    for k in range(12):
        w = base.split()
        w[7 * k % 100] = "edit%d" % k
        rows.append(" ".join(w))
        rows.append(say(20) + " " + passage + " " + say(15))
    rows += [say(int(n)) for n in rng.integers(1, 200, 20)]
    rows += ["  a  b", "tab\tbetween", "line\n\nline", "It's 12,5 <|endoftext|>", "Σας İ"]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xx", "s", len(t or ""), 0.5, 1, 2, 3) for i, t in enumerate(_texts())]
    rows += [(None, "no id here", None, None, None, None, None, None, None), rows[5]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _sorted(x):
    return sorted(x, key=repr)


@pytest.mark.parametrize("limit", [100_000, 40])
def test_decontamination(spark, docs, rows, limit):
    whole = [t for _, t in rows if t and len(t.split()) > 60][0].split()
    items = [(0, " ".join(whole[10:40])), (1, "Two words"), (2, None), (3, ""), (4, " ".join(whole[20:32])), (None, "one"), (10, "Two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.decontaminate(docs, bench, window=10, max_windows=limit)
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    wins = defaultdict(set)
    for i, t in items:
        w = word(t)
        for k in range(max(1, len(w) - 9)):
            if w:
                wins[tuple(w[k:k + 10])].add(i)
    want = []
    for d, t in rows:
        w, hit, found = word(t), set(), set()
        for win, ids in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= ids - {None}
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    assert _sorted(tuple(r)[:6] for r in got.collect()) == _sorted(want)
    text = dict(rows)
    for r in got.where("contaminated and doc_id is not null").collect():
        assert sum(len(word(text[r.doc_id][s.start:s.end])) for s in r.spans) == r.n_hit


def test_suffix_dedup(docs, rows):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i:i + 200] for i in range(len(b) - 199))
    want = []
    for d, t in rows:
        b = (t or "").encode()
        gone = set()
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone |= set(range(i, i + 200))
        want.append((d, len(b), len(gone), sum(i - 1 not in gone for i in gone),
                     hashlib.sha256(bytes(x for i, x in enumerate(b) if i not in gone)).hexdigest()))
    for most in (50_000, 1):       # by merged suffixes, and by window fingerprints alone
        got = suffix_dedup.deduplicate(docs, block_bytes=2000, bucket_bytes=10_000, most=most).drop("kept")
        assert _sorted(map(tuple, got.collect())) == _sorted(want)


def test_loser_tree_order_and_prefixes():
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice([97, 98], int(n))) for n in rng.integers(1, 12, 300)]
    runs = [suffix_dedup.front_code([(w, b"", 0, 0, 0, 0, 1) for w in words[k::7]]) for k in range(7)]
    rows, lcps = suffix_dedup.merge([suffix_dedup.decode(r) for r in runs])
    assert [r[0] for r in rows] == sorted(words)
    assert lcps[1:] == [suffix_dedup.common(a[0], b[0], 0) for a, b in zip(rows, rows[1:])]


def _components(rows):
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(t))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return [(d, len(sets[i]), min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)]


def test_jaccard_components(docs, rows):
    assert _sorted(map(tuple, jaccard_join.link(docs).collect())) == _sorted(_components(rows))


def test_jaccard_groups_with_the_same_members_meet_once(spark):
    rows = [(k, f) for k, group in enumerate([(1, 2, 3), (1, 2), (3, 2, 1), (4, 5), (1, 2)]) for f in group]
    got = jaccard_join._once(spark.createDataFrame(rows, "key long, fp long").repartition(3)).collect()
    assert sorted(map(tuple, got)) == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (3, 4), (3, 5)]


def test_jaccard_without_near_copies_takes_few_jobs(spark):
    """Counts are taken while tables are written, and steps without a pair are left out: every job costs the driver memory."""
    rows = [(i, " ".join("w%d" % (17 * i + j) for j in range(30))) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    spark.sparkContext.setJobGroup("few-jobs", "")
    try:
        found = jaccard_join.link(frame)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) < 60
    assert _sorted(map(tuple, found.collect())) == _sorted(_components(rows))


def test_jaccard_outsiders_close_to_a_group(spark):
    """Copies with ever more edits, in two groups that share a passage, near and beyond the limit."""
    rng = np.random.default_rng(8)
    vocab = ["w%d" % i for i in range(3000)]
    shared = list(rng.choice(vocab, 90))
    rows = []
    for g in range(2):
        base = shared + list(rng.choice(vocab, 70))
        for k in range(45):
            w = list(base)
            for at in rng.choice(len(w), k // 3 + 1, replace=False):
                w[at] = "new%d" % rng.integers(1 << 30)
            rows.append((len(rows), " ".join(w)))
    found = jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert _sorted(map(tuple, found)) == _sorted(_components(rows))


def test_jaccard_members_and_outsiders_meet_once(spark):
    """Copies with edits of their own: whoever may link meets, at one shingle, and whoever is too far does not meet."""
    rng = np.random.default_rng(11)
    base, sets = list(range(1000, 1140)), []
    for k in range(40):
        own = set(rng.choice(base, k, replace=False).tolist())
        sets.append([10_000 * (k + 1) + x if x in own else x for x in base])
    often = Counter(x for s in sets for x in s)
    rows = []
    for fp, held in enumerate(sets):
        held = sorted(held, key=lambda x: (often[x], x))
        words = jaccard_join.bit_sketch(np.array(held, np.uint64)).reshape(4, -1)
        folded = [int(w) for w in np.bitwise_xor.reduce(words, 0)]
        rows += [(x, fp, 0 if fp < 12 else fp, len(held), nth, 0, *folded) for nth, x in enumerate(held, 1) if nth <= len(held) // 4 + 1 and often[x] > 1]
    left = spark.createDataFrame(rows, "key long, fp long, label long, n long, nth long, main long, " + ", ".join(f"{c} long" for c in jaccard_join._FOLDED))
    met = Counter((r.a, r.b) for r in jaccard_join._candidates(left).collect())
    near = {(a, b) for a in range(40) for b in range(max(a + 1, 12), 40) if 4 * len(set(sets[a]) & set(sets[b])) >= 3 * len(set(sets[a]) | set(sets[b]))}
    far = {(a, b) for a in range(40) for b in range(a + 1, 40) if a + b > 42}
    assert near and far and near <= set(met) and not far & set(met)
    assert sum(met.values()) <= 1.2 * len(met)


def _least_reached(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return sorted((x, find(x)) for x in root)


def test_components_at_once_and_continued(spark):
    rng = np.random.default_rng(9)
    first = [(100 + k, 101 + k) for k in range(40)] + [(900, 900 - k) for k in range(1, 20)] + rng.integers(0, 60, (30, 2)).tolist()
    first = [(int(a), int(b)) for a, b in first if a != b]
    more = [(120, 5), (890, 2000), (2001, 2000), (101, 100), (7, 7)]
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    found = components(frame(first * 2))
    assert sorted(map(tuple, found.collect())) == _least_reached(first)
    assert sorted(map(tuple, components(frame(more), found).collect())) == _least_reached(first + more[:-1])
    assert sorted(map(tuple, components(frame([]), found).collect())) == _least_reached(first)
    assert components(frame([])).collect() == []


@given(st.integers(0, 2**32), st.integers(1, 900), st.integers(0, 300))
@settings(max_examples=30, deadline=None)
def test_bit_sketches_bound_the_difference(seed, n, other):
    h = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, n + other).astype(np.uint64))
    a, b = h[:n], h[other:]
    words = jaccard_join.bit_sketch(a) ^ jaccard_join.bit_sketch(b)
    assert sum(int(w).bit_count() for w in words.view(np.uint64)) <= len(np.setxor1d(a, b))


def test_lm_base_counts_and_score(docs, rows):
    split = {i: [*re.findall(r"[^\x20\x09-\x0D]+", _lower(t)), None] for i, (_, t) in enumerate(rows)}
    held = {i: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    c = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total = sum(c.values())
    want = _sorted((d, held[i], len(split[i]), sum(c[w] > 0 for w in split[i]), total,
                    round(sum(log10((c[w] + 1) / (total + len(c) + 1)) for w in split[i]), 6)) for i, (d, _) in enumerate(rows))
    got = lm_score.score(docs, block_bytes=3000).collect()
    assert _sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in got)


def test_lm_score_depends_on_word_order(spark):
    rows = [(i, "red car blue sky green tree " * 6) for i in range(60)]
    rows += [(100, "red car blue sky green tree"), (101, "car sky tree red blue green")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm_score.score(docs, held_out=F.col("doc_id") >= 100).collect()}
    assert got[100].base_score == pytest.approx(got[101].base_score)
    assert got[100].score > got[101].score + 0.5


def test_mixer_probabilities_sum_to_one():
    """The spelled tokens are prefix-free, so one- and two-byte tokens cannot pass a mass of one."""
    model = lm_score.Model([np.zeros(1 << s, np.uint16) for s in lm_score.SLOTS])
    firsts = [bytes([i]) for i in range(256) if i not in b" \t\n\r\x0b\x0c"] + [lm_score.END]
    mass = (10.0 ** model.log10(firsts, np.zeros(len(firsts), np.int32))).sum()
    assert 0 < mass <= 1


def test_neighbours_recall_ties_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    vecs = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(600)]
    vecs += [(600 + i, [1.0] * 16) for i in range(80)]
    bad = [(None, [1.0] * 16), (9000, None), (9020, [0.0] * 16), (9040, [float("nan")] + [1.0] * 15), (9060, [None] + [1.0] * 15), (9080, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1.0, 1) for i, v in vecs + bad], "vec_id long, embedding array<float>, score double, rank int").repartition(4)
    got = ann.search(df, F.pmod("vec_id", F.lit(20)) == 0, k=20, segment_rows=50).collect()
    x = np.array([v for _, v in vecs], np.float32).astype(float)
    found = defaultdict(list)
    for r in got:
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    queries = [i for i, _ in vecs if i % 20 == 0]
    assert sorted(found) == queries
    hit = 0
    for q in queries:
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -s))[:20]
        mine = sorted(found[q])
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert all(abs(m[2] - s[m[1]]) < 1e-9 for m in mine)
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        hit += len({m[1] for m in mine} & set(want.tolist()))
    assert hit / (20 * len(queries)) >= 0.9
    assert [m[1] for m in sorted(found[640])] == [i for i in range(600, 622) if i != 640][:20]


def test_tokens_equal_the_library(rows):
    texts = [t or "" for _, t in rows]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc = tokens.Encoder(tokens.public_path(name), keep=50)
        assert enc.ids(texts, group=3) == enc.whole(texts)


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 65536, 70001):
        ids = rng.integers(0, 1 << 32, n).astype("<u4") if n != 8 else np.zeros(8, "<u4")
        assert (token_store.unpack_ids(token_store.pack_ids(ids, planes, block_ids=1000)) == ids).all()


def test_plain_words_are_encoded_at_once():
    """Runs of letters with closing marks are merged in arrays, not learnt one by one, beside chunks of every other kind."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgXYZ"), int(n))) + str(rng.choice(["", "", ",", "...", "?!"])) for n in rng.integers(1, 12, 400)]
    odd = ["", None, " lead", "trail ", "x  y", "a\u2003\u2003b", "a\nb, c\n", "don't 12,5 co-op", "été, naïve", ",", ".,;", "nul\0 in", "\n", "Σας İ", "e\u0301 x", "word\n"]
    texts = [" ".join(rng.choice(words, 60)) + t for t in ("", ".", "\n", " ") for _ in range(5)] + odd
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc = tokens.Encoder(tokens.public_path(name))
        learnt, learn = set(), enc.learn
        enc.learn = lambda missing: learnt.update(missing) or learn(missing)  # noqa: B023
        assert enc.ids(texts, chars=2000) == enc.whole([t or "" for t in texts])
        assert not learnt & {w.lower() for w in words} and not learnt & set(words)


def test_token_store(docs, rows):
    store = token_store.write_store(docs, tokens.public_path("word_bpe_49k.json"), end_id=2, chunk_ids=300, shard_bytes=4000)
    got = sorted(token_store.read_store(store).collect(), key=lambda r: r.start)
    enc = tokens.Encoder(tokens.public_path("word_bpe_49k.json"))
    at = 0
    for r, (d, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), strict=True):
        ids = enc.whole([t or ""])[0] + struct.pack("<I", 2)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids) // 4, zlib.crc32(ids))
        assert np.array(r.ids, "<u4").tobytes() == ids
        at += len(ids) // 4


def test_packing(docs, rows):
    got = packing.pack(docs, tokens.public_path("byte_bpe_50k.json"), end_id=1, max_len=64).collect()
    enc = tokens.Encoder(tokens.public_path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in rows:
        ids = np.frombuffer(enc.whole([t or ""])[0] + struct.pack("<I", 1), "<u4")
        at = 0
        for n in packing.decompose(len(ids), 64):
            want[d, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids), ids[at:at + n].astype("<u2").tobytes()] += 1
            at += n
        assert at == len(ids)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got) == want
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by = sorted(got, key=lambda r: r.sequence_id)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 for r in got)
    assert [r.length for r in by] == sorted((r.length for r in by), reverse=True)


def test_url_filter(spark):
    rules = [("Example.org", "/es/", "block"), ("org", "/", "allow"), ("example.org", "/en/1", "block"), ("com", "/", "block"), (None, "/", "block")]
    urls = [None, "", "nourl", "http://", "http://A.Example.ORG/es/x?q=1#f", "http://notexample.org/es/", "https://x.com", "https://x.com/",
            "http://example.org/en/12", "http://example.org/en/2", "http://x.net/://y.org/"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, urls[4], "", ""), (4, urls[4], "", "")],
                                  "page_id long, url string, host string, rule string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in
           url_filter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), bits_per_key=1).collect()}
    assert (4, "a.example.org", "/es/x", "example.org/es/", "block") in got and (None, "a.example.org", "/es/x", "example.org/es/", "block") in got
    assert (5, "notexample.org", "/es/", "org/", "allow") in got and (6, "x.com", "", None, "allow") in got
    assert (7, "x.com", "/", "com/", "block") in got and (8, "example.org", "/en/12", "example.org/en/1", "block") in got
    assert (0, "", "", None, "allow") in got and (10, "x.net", "/://y.org/", None, "allow") in got and len(got) == len(urls) + 1


def _labelled(spark, clean, dirty):
    rng = np.random.default_rng(3)
    rows = [(i, clean(rng) if i % 4 else dirty(rng), int(i % 4 > 0)) for i in range(400)]
    return (spark.createDataFrame([(i, t, "en") for i, t, _ in rows] + [(None, None, None), (1000, "", None)], "doc_id long, text string, lang string").repartition(3),
            spark.createDataFrame([(i, y, 1 - y) for i, _, y in rows] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int"),
            {i: y for i, _, y in rows})


def test_url_rules_of_very_many_lengths(spark):
    n = 10_400
    rules = spark.range(1, n + 1).select(F.lit("org").alias("host"), F.expr("concat('/', repeat('p', int(id)), 'x')").alias("path"), F.lit("block").alias("verdict"))
    sizes = [1, 2, 37, 5000, 9999, 10_000, 10_001, 10_200, n, n + 1]
    pages = spark.createDataFrame([(k, "https://a.org/" + "p" * k + "x/y") for k in sizes], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {k: "block" if k <= n else "allow" for k in sizes}


def test_classifiers_on_held_out_rows(spark):
    words = ["%c%c%c" % (97 + i % 7, 98 + i % 11, 99 + i % 13) for i in range(300)]
    docs, labels, truth = _labelled(spark, lambda r: " ".join(r.choice(words, 60)),
                                    lambda r: " ".join(f"{w} | awful!!" for w in r.choice(words, 30)))
    for got, flip in ((pu_quality.classify(docs, labels), 0), (toxicity.classify(docs, labels, bits=16), 1)):
        got = got.collect()
        assert len(got) == 402 and all(0 <= r.score <= 1 for r in got)
        held = [r for r in got if r.held_out and r.doc_id in truth]
        assert len(held) > 40 and all(r.predicted == (truth[r.doc_id] ^ flip) for r in held)


@pytest.mark.parametrize("run", [
    lambda d: decontam.decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text")), suffix_dedup.deduplicate, jaccard_join.link, lm_score.score,
    lambda d: token_store.read_store(token_store.write_store(d, tokens.public_path("word_bpe_49k.json"), end_id=2)),
    lambda d: packing.pack(d, tokens.public_path("byte_bpe_50k.json"), end_id=1),
    lambda d: pu_quality.classify(d, d.selectExpr("doc_id", "1 quality")), lambda d: toxicity.classify(d, d.selectExpr("doc_id", "1 toxic"))])
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0


def test_empty_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(df, F.col("vec_id") > 0).count() == 0


def test_quality_equals_plain_gradient_descent():
    """Newton steps on sums against small gradient steps of the non-negative risk, row by row of the formula."""
    rng = np.random.default_rng(3)
    good = rng.random(600) < 0.6
    x = np.column_stack([np.where(good, 1.0, -1.0) + rng.standard_normal(600), rng.standard_normal(600), np.ones(600)])
    pos, prior = x[good][:150], 0.6
    got = pu_quality.nn_pu(pos, lambda of, width: sum(of(part) for part in np.array_split(x, 7)), len(x), prior)

    def risk(w):
        soft = lambda v: np.logaddexp(0, v).mean()
        return prior * soft(-(pos @ w)) + max(0, soft(x @ w) - prior * soft(pos @ w)) + 1e-4 * (w[:-1] @ w[:-1]) / 2

    w = np.zeros(3)
    for _ in range(4000):
        p, u = 1 / (1 + np.exp(-(pos @ w))), 1 / (1 + np.exp(-(x @ w)))
        inside = np.logaddexp(0, x @ w).mean() - prior * np.logaddexp(0, pos @ w).mean()
        grad = prior * pos.T @ (p - 1) / len(pos)
        if inside >= 0:
            grad = grad + x.T @ u / len(x) - prior * pos.T @ p / len(pos)
        w = w - 0.5 * (grad + 1e-4 * np.append(w[:-1], 0))
    assert risk(got) <= risk(w) + 1e-6
    assert got == pytest.approx(w, abs=0.02)


def test_quality_never_leaves_a_negative_bracket():
    """One positive far out: the unbiased risk would drive the estimated risk of the negatives below zero."""
    x = np.column_stack([np.r_[np.linspace(-1, 1, 40), 30.0], np.ones(41)])
    w = pu_quality.nn_pu(x[-1:], lambda of, width: of(x), len(x), 0.5)
    assert np.isfinite(w).all()
    assert np.logaddexp(0, x @ w).mean() - 0.5 * np.logaddexp(0, x[-1:] @ w).mean() >= 0


def test_rows_without_an_id_link_and_bridge(spark):
    words = ["w%d" % i for i in range(200)]

    def text(*changed):
        return " ".join("x%d" % i if i in changed else w for i, w in enumerate(words))
    # 1 and 2 differ by six words and the row without an id by three from each; at five-word shingles only it links them
    rows = [(1, text(10, 50, 90)), (None, text()), (2, text(130, 160, 190)), (3, "quite another text of more than five words"), (None, "and one more without any link at all")]
    got = {(r.doc_id, r.n_shingles): r.component_id
           for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert got == {(1, 196): 1, (None, 196): 1, (2, 196): 1, (3, 4): 3, (None, 4): None}


def test_second_benchmark_of_equal_size_is_not_mistaken(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta epsilon zeta")], "doc_id long, text string").coalesce(1)
    for item, hit in (("alpha beta", 1), ("delta epsilon", 2), ("alpha beta", 1)):
        items = spark.createDataFrame([(7, item)], "item_id long, text string")
        assert [r.doc_id for r in decontam.decontaminate(docs, items, window=2).where("contaminated").collect()] == [hit]


def test_lm_training_pairs_take_little_memory():
    n, k = 400_000, 1000
    rng, words = np.random.default_rng(5), [b"w%d" % i for i in range(k)]
    lens, token = np.array([n // 4 - 5, 5, n // 2, n // 4], "<i8"), rng.integers(0, k, n).astype("<u4")
    held = np.array([False, True, False, False])
    payload = zstandard.ZstdCompressor().compress(b"".join([np.array([4, k], "<i8").tobytes(), np.arange(4, dtype="<i8").tobytes(), lens.tobytes(), token.tobytes(),
                                                            bytes(4), held.tobytes(), bytes(k), b"\n".join(words)]))
    want, start = Counter(), 0
    for m, h in zip(lens.tolist(), held.tolist()):
        doc = token[start:start + m].tolist()
        start += m
        want.update(() if h else zip(doc, [doc[-1], *doc[:-1]]))
    tracemalloc.start()
    _, _, word, counts, last = lm_score.Block(payload).training()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    name = {int(h): i for i, h in enumerate(lm_score.prints(words))}
    assert dict(zip(zip(word.tolist(), (name[int(x)] for x in last)), counts.tolist())) == dict(want)
    assert peak < 46 * n                       # bytes a token


def test_lm_words_are_dealt_by_word_once(spark, docs, monkeypatch):
    """Counts of a word in a class and over all classes come from one exchange, a block's answers from one more."""
    plans = []
    monkeypatch.setattr(lm_score, "stored", lambda s, df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or stored(s, df, name))
    lm_score.score(docs, block_bytes=5000).count()
    assert dict(plans)["vocabulary"].count("Exchange hashpartitioning") == 1
