"""The operators that have SQL against it, row for row."""
from collections import Counter

import duckdb
import pytest

from ledgerlark.llm import oracle, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(oracle.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    want = Counter(tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in cur.fetchall())
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want
    assert sum(want.values()) > 30
