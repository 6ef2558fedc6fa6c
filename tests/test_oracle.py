"""Every registered query with an SQL equivalent, against DuckDB on sf0.001 (order-insensitive)."""

import pytest

import __spark_entry__ as entry
from murmur.plans.verify import compare
from tests.conftest import SF_SMALL

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[key])
    ok, msg = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
    assert ok, msg
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in res.description}
    assert spark_types == duck_types


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["keyword", "day", "volume", "dominant_sentiment", "dominant_n"]
    assert df.count() > 0
