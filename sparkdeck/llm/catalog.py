"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, decontam, fp_search, jaccard_join, lm_score, mixing, packing, pu_quality, suffix_dedup, token_store, tokens, toxicity, url_filter

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

#: The rules of the URL query.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql.strip() if sql else None)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in REGISTRY.items() if s}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_decontaminate")
def op1_decontaminate(spark, sf):
    """Words of ``documents`` inside occurrences of 10-word windows of ``benchmark``."""
    return decontam.decontaminate(_t(spark, sf, "documents"), _t(spark, sf, "benchmark"), window=10).drop("spans")


@query("op2_lm_score")
def op2_lm_score(spark, sf):
    """log10 probability of every document under context mixing, and under add-one unigrams."""
    return lm_score.score(_t(spark, sf, "documents"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf):
    """Bytes of ``documents`` outside 200-byte strings that start more than once."""
    return suffix_dedup.deduplicate(_t(spark, sf, "documents"), length=200).drop("kept")


@query("op4_ann")
def op4_ann(spark, sf):
    """The 20 nearest rows, by inner product, of every 20th row of ``embeddings``."""
    return ann.search(_t(spark, sf, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20)


@query("op5_pu_quality")
def op5_pu_quality(spark, sf):
    """Quality of every document, learnt from trusted positives and unlabelled text."""
    return pu_quality.classify(_t(spark, sf, "documents"), _t(spark, sf, "labels"), threshold=0.3)


@query("op6_jaccard_join")
def op6_jaccard_join(spark, sf):
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.75."""
    return jaccard_join.link(_t(spark, sf, "documents"), size=5)


@query("op7_token_store")
def op7_token_store(spark, sf):
    """All documents as word-vocabulary ids, written as byte planes and read back."""
    store = token_store.write_store(_t(spark, sf, "documents"), tokens.public_path("word_bpe_49k.json"), end_id=2)
    return token_store.read_store(store, with_ids=False)


@query("op8_toxicity")
def op8_toxicity(spark, sf):
    """Toxicity of every document by FTRL over hashed n-grams."""
    return toxicity.classify(_t(spark, sf, "documents"), _t(spark, sf, "labels"), threshold=0.5)


@query("op9_packing")
def op9_packing(spark, sf):
    """All documents cut into power-of-two pieces of at most 2048 ids."""
    return packing.pack(_t(spark, sf, "documents"), tokens.public_path("byte_bpe_50k.json"), end_id=1, max_len=2048, with_ids=False)


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH r(r_host, r_path, r_verdict) AS (VALUES {rules}),
a AS (SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN '' ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM a),
u AS (SELECT DISTINCT host, path FROM b),
m AS (SELECT host, path, r_host || r_path AS rule, r_verdict,
             row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS k
      FROM u JOIN r ON (host = r_host OR suffix(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, b.host AS host, b.path AS path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM b LEFT JOIN (SELECT * FROM m WHERE k = 1) m ON b.host = m.host AND b.path = m.path
"""


@query("op10_url_filter", _url_sql())
def op10_url_filter(spark, sf):
    """The rule and verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string").coalesce(1)
    return url_filter.filter_urls(_t(spark, sf, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op11_align")
def op11_align(spark, sf):
    """Groups, links and link counts of two tokenizers' ids over every document."""
    return alignment.align(_t(spark, sf, "documents"), tokens.public_path("byte_bpe_50k.json"), tokens.public_path("piece_bpe_32k.model")).documents


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
n AS (SELECT r, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
corpus AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
i AS (SELECT row_number() OVER () AS b, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
q AS (SELECT DISTINCT b, item_id, unnest(ts) AS t FROM i),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM n) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY t),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * n * nn) // ll) AS m FROM n, corpus),
s AS (SELECT b, item_id, m.r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m ON m.r = tf.r GROUP BY b, item_id, m.r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id ASC NULLS LAST) AS k FROM s WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM k WHERE k <= 50
"""


@query("op12_search", SEARCH_SQL)
def op12_search(spark, sf):
    """The 50 best documents of every benchmark item."""
    return fp_search.search(_t(spark, sf, "documents"), _t(spark, sf, "benchmark"), k=50)


@query("op13_mix")
def op13_mix(spark, sf):
    """Words that a mix of 150 % of the corpus takes from every document, sources weighted 5, 2, 1."""
    return mixing.mix(_t(spark, sf, "documents")).documents
