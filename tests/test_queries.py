"""Every query against its SQL at the smallest scale."""

import math
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from docketeer.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return None if value is None else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = Counter(tuple(map(plain, row)) for row in result.fetchall())
    df = queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    got = Counter(tuple(map(plain, row)) for row in df.select(*(f"`{c}`" for c in columns)).collect())
    assert got == want
    assert got


@pytest.mark.parametrize("name", ["stream_normalize", "stream_enrich"])
def test_streams_take_a_table_of_several_files(spark, tmp_path, name):
    for table in TABLES:
        rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
        (rows.repartition(3) if table == "documents" else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    columns = ["id", "error_reason", "judges", "defense"]
    got, want = (
        Counter(tuple(map(plain, row)) for row in queries()[name](spark, str(f)).select(columns).collect())
        for f in (tmp_path, FOLDER)
    )
    assert got == want and got


@pytest.mark.parametrize("missing", ["ahocorasick", "docketeer.llm", "corpus_pipeline"])
def test_entry_without_a_part(missing):
    """A library or a part that is not there takes its own queries with it, and no others."""
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e;"
        "from docketeer.plans.queries import QUERIES; assert set(QUERIES) <= set(e.queries());"
        "assert 'pipeline' not in e.queries(); assert set(e.oracle_sql()) <= set(e.queries())"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_tasks_do_not_need_the_package(tmp_path):
    """Tasks get their functions by value: the workers of this session cannot import the library."""
    root = Path(__file__).resolve().parents[1]
    code = (
        f"import sys; sys.path.insert(0, {str(root)!r}); from docketeer.session import local_session;"
        "spark = local_session('2', 'alone'); import __spark_entry__ as e;"
        f"[e.queries()[q](spark, {FOLDER!r}).collect() for q in ('normalized_name_counts', 'model_classes')]"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)


def test_entry(spark):
    assert entry(spark).count() == 10
