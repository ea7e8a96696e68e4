"""The queries of text operators that SQL can express, against DuckDB over whole tables."""

import duckdb
import pytest

from tesserae.llm import registry

from ..test_queries import rows

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = registry.queries()[name](spark, sf_dir)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = rows(df.columns, df.collect())
    assert got and got == rows(want.columns, want.fetchall())
