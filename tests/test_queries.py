"""Every registered query against its DuckDB SQL on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if hasattr(v, "item"):
        v = v.item()
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(got) > 0
        return
    assert _rows(got) == _rows(duck.execute(sql).df())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
