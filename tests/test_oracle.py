"""Registered queries against their DuckDB SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ragtide.plans import catalog
from ragtide.plans.tables import TABLES

KEYS = sorted(set(entry.oracle_sql()) & set(catalog.queries()))


def norm(v):
    if isinstance(v, float):
        return "None" if math.isnan(v) else repr(round(v, 6))
    if v is None:
        return "None"
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = entry.queries()[key](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[key]).df()
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "rank"]
    assert df.count() > 0
