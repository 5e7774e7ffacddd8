"""Every registered query against its SQL, and what its plan must not contain."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from registry import oracle, spark_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = spark_queries.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert unwanted not in plan
    want = db.execute(SQL[name]).df()
    got = df.toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(got) > 0
    got = got[cols].sort_values(cols, ignore_index=True)
    want = want[cols].sort_values(cols, ignore_index=True)
    for col in cols:
        same = (got[col].values == want[col].values) | (got[col].isna() & want[col].isna())
        assert same.all(), col
        assert got[col].dtype == want[col].dtype


@pytest.mark.parametrize("name", ["top5_bigram_mle", "top5_bigram_kn", "top3_trigram_kn"])
def test_top_k_cuts_before_the_shuffle(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    if "Exchange hashpartitioning" not in plan:
        # Counted tables lie in buckets of their context: nothing is shuffled, so nothing has to be cut before.
        assert "WindowGroupLimit" in plan and "Bucketed: true" in plan
        return
    final, partial = plan.index(", Final"), plan.index(", Partial")
    assert final < plan.index("Exchange hashpartitioning", final) < partial


def test_first_words_are_filtered_in_the_scan(spark):
    plan = QUERIES["trim_stop_words"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(w2)" in text and "GreaterThanOrEqual(w1" in text


def test_cleaning_runs_once_per_count(spark):
    plan = QUERIES["tetragram_counts"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count(" www(.+) ") == 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["w1", "word", "prob", "rank"] and df.count() > 0
