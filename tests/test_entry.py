"""The driver contract in ``__spark_entry__.py``."""

import __spark_entry__ as E


def test_entry_runs_with_stable_schema(spark):
    a = E.entry(spark)
    b = E.entry(spark)
    assert a.schema == b.schema and a.count() == b.count() > 0
    assert a.columns == ["o_day", "o_orderkey", "o_totalprice"]


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 70
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and "select" in s.lower() for s in o.values())
    own = {n for n in q if n == "pipeline" or n.startswith("op") and n[2:3].isdigit()}
    assert len(own) == 13 * (E.llm is not None) + (E.corpus_pipeline is not None)
