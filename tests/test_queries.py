"""The registered queries and their SQL agree in names; a spread of them in values too."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = Path("/root/testdata/sf0.001")
CHECKED = [
    "item_window_stats", "user_recent_items", "asof_features_ttl", "kcore_sample", "time_split", "id_map",
    "negative_samples", "skipgram_pairs", "knn_cosine_topk", "rerank_recs", "tfidf_terms", "item_vectors",
    "average_precision", "ranking_metrics", "compaction_bins", "stream_recent_items",
]
needs_tables = pytest.mark.skipif(not SF.exists(), reason="no tables")


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def same(a, b):
    return all(
        math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) if isinstance(x, float) and isinstance(y, float) else x == y
        for x, y in zip(a, b)
    )


@needs_tables
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, db, name):
    df = queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    order = lambda r: tuple((v is None, str(type(v)), v) for v in r)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=order)
    relation = db.sql(oracle_sql()[name])
    assert sorted(relation.columns) == columns
    want = sorted(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall(), key=order)
    assert len(got) == len(want)
    assert all(same(a, b) for a, b in zip(got, want))


@needs_tables
def test_entry_runs(spark):
    assert entry(spark).limit(1).count() == 1
