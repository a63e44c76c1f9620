"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
from sparkdeck.llm.util import stored


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "s", 0), (7, "", "en", "s", 0)], docs.schema)
    docs, n = docs.unionByName(odd), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        n.append(docs.count())
    assert n == sorted(n, reverse=True) and 100 < n[-1]
    assert docs.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
