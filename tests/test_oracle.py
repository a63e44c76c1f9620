"""Every catalogue query with an oracle must equal DuckDB on the same parquet tables."""

import pytest

from sparkdeck.plans import oracle_sql, queries
from tools.check_oracle import compare, duck

from .conftest import SF_SMALL

ORACLE = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", ORACLE)
def test_matches_duckdb(spark, con, name):
    r = compare(spark, name, queries()[name], oracle_sql()[name], SF_SMALL, con)
    assert r["ok"], r


def test_every_query_has_a_docstring():
    for name, fn in queries().items():
        assert fn.__doc__, name


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ORACLE)
def test_column_types_match_duckdb(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(oracle_sql()[name])
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
