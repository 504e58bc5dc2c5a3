"""Registered queries against their SQL on the smallest tables."""

import math

import duckdb
import pytest

from ragtide.llm import queries


def norm(v):
    return "None" if v is None or v != v else str(int(v) if isinstance(v, float) and math.isfinite(v) and v == int(v) else v)


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, sf, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got, want = queries.queries()[key](spark, sf).toPandas(), con.execute(queries.oracle_sql()[key]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(got) > 0
    rows = [sorted(tuple(norm(r[c]) for c in cols) for r in x.to_dict("records")) for x in (got, want)]
    assert rows[0] == rows[1]
