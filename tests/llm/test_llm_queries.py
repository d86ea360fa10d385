import duckdb
import pytest
from tests_llm_prose import SF_SMALL

import __spark_entry__ as entry
from lading.llm.queries import ORACLE, QUERIES


def test_every_operator_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= {*entry.queries()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    got = QUERIES[name](spark, SF_SMALL)
    want = con.sql(ORACLE[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str(tuple(r[k] for k in order)) for r in want.fetchall())
