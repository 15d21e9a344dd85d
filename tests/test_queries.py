"""Every registered query against its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "orders documents embeddings pages".split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted((tuple(_norm(r[k]) for k in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    types = dict(zip(duck.sql(sql).columns, [str(t) for t in duck.sql(sql).types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == types[f.name], f.name
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "page_id", "i", "english_text", "khmer_text"]
    assert df.count() > 0
