"""Every registered query against its SQL in DuckDB, and what must hold of the others."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from parley.registry import ORACLES, QUERIES

DATA = os.environ.get("PARLEY_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(DATA, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value)
    return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(cell, r)) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, expected = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_sweep_figures(spark):
    stats = QUERIES["k_sweep"](spark, DATA).collect()
    n = spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert [r.k for r in stats] == [8, 12, 16, 20, 24, 30]
    for r in stats:
        assert -1 <= r.silhouette <= 1 and 0 <= r.min_size <= r.max_size <= n
        assert r.max_share == pytest.approx(r.max_size / n)


def test_assignment_covers_every_vector(spark):
    got = QUERIES["kmeans_assign"](spark, DATA).toPandas()
    assert len(got) == spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert got.cluster_id.between(0, 9).all() and got.similarity.between(-1, 1).all()


def test_metadata_belongs_to_the_clusters_it_describes(spark):
    got = QUERIES["cluster_metadata"](spark, DATA).toPandas()
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert len(got) == got.cluster_count.iloc[0] and set(got.cluster_id) == set(range(len(got)))
    assert got.n.sum() == got.conversation_count.iloc[0] == vectors
    assert set(got.embedding_model) == {"given vectors"} and got.n.min() >= 5 and got.n.max() <= 0.2 * vectors


def test_no_choice_is_said_and_not_made(spark):
    """Neither the statements nor the words of these documents have a viable K: no cluster is made up."""
    got = QUERIES["issue_clusters"](spark, DATA).toPandas()
    rule = got[got.k.notna()]
    assert list(rule.k) == [8, 12, 16, 20, 24, 30]
    for r in rule.itertuples():
        assert (r.verdict == "a cluster is too small") == (r.min_size < 5)
    assert (rule.verdict == "chosen").sum() == int(((rule.min_size >= 5) & (rule.max_share <= 0.2)).any())
    seen = {r.representation: r for r in QUERIES["representation_compare"](spark, DATA).collect()}
    assert set(seen) == {"given", "lexical", "tfidf"}
    assert all((r.k is None) == (r.outcome == "no viable k") for r in seen.values())


def test_encoded_documents_have_unit_length(spark):
    got = QUERIES["encode_long_texts"](spark, DATA).toPandas()
    norms = (got.value ** 2).groupby(got.conversation_id).sum()
    assert ((norms - 1).abs() < 5e-3).all()


def test_live_queries_read_a_table_of_several_files(spark, duck, tmp_path):
    folder = str(tmp_path / "events.parquet")
    spark.read.parquet(f"{DATA}/events.parquet").repartition(3).write.parquet(folder)
    for name in ("live_hourly_counts", "live_alerts"):
        assert rows(QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(duck.sql(ORACLES[name]).df())
