"""The queries that SQL can express, against that SQL."""

from collections import Counter

import duckdb
import pytest

from docketeer.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = Counter(tuple(map(str, row)) for row in result.fetchall())
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(map(str, row)) for row in df.select(columns).collect()) == want
