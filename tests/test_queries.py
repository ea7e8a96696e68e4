"""Every query against its SQL in DuckDB, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tesserae.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES + ["embeddings"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int | float) or type(v).__name__ == "Decimal":
        return "None" if isinstance(v, float) and math.isnan(v) else repr(float(v))
    return str(v)


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
