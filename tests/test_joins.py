"""Joins with keys that hold a third of the rows, and the exchanges that joins share."""

import pytest
from pyspark.sql import functions as F

from registry import spark_queries
from wordloom.operators import joins

SF_DIR = "/root/testdata/sf0.001"


def tables(spark, n=600):
    key = "if(id % 3 = 0, 'hot', concat('k', id % 50))"
    left = spark.range(n).selectExpr(f"{key} as k", "id as a").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS k, -1L AS a"))
    right = spark.range(n // 2).selectExpr(f"{key} as k", "id as b").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS k, -1L AS b"))
    return left, right.where("k is null or k <> 'k7'")


@pytest.fixture
def shuffled(spark):
    """No broadcast of a side, partitions as they are."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(tuple, df.select("k", "a", "b").collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("turned", [False, True])
def test_a_third_of_the_rows_on_each_side(spark, shuffled, how, turned):
    left, right = tables(spark)
    if turned:
        left, right = right, left
    plain = left.join(right, ["k"], how)
    got = joins.skew_join(left, right, ["k"], how, partitions=32)
    assert got.columns == plain.columns and rows(got) == rows(plain)

    def largest(df):
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)

    # Nearly all pairs are those of the hot key: one task makes them all, or many share them.
    assert largest(plain) > 0.85 and largest(got) < 0.35


def test_no_hot_key_and_empty_tables(spark):
    left = spark.range(100).selectExpr("id as k", "id as a")
    right = spark.range(50).selectExpr("id as k", "id as b")
    assert rows(joins.skew_join(left, right, ["k"])) == rows(left.join(right, ["k"]))
    empty = right.where("false")
    assert joins.skew_join(left, empty, ["k"]).count() == 0
    assert joins.skew_join(left, empty, ["k"], "left").count() == 100
    assert joins.skew_join(empty, left, ["k"]).count() == 0
    with pytest.raises(ValueError):
        joins.skew_join(left, right, ["k"], "full")


# Exchanges by hash with no side broadcast; the counted tables add none of their own.
EXCHANGES = {
    "top5_bigram_mle": 0, "top5_trigram_mle": 0, "top5_tetragram_mle": 0, "bigram_mle": 0, "trigram_mle": 1, "tetragram_mle": 2,
    "bigram_kn": 3, "trigram_kn": 5, "top3_trigram_kn": 6,
}


@pytest.mark.parametrize("name", EXCHANGES)
def test_counted_tables_are_joined_in_place(spark, shuffled, monkeypatch, name):
    monkeypatch.setattr(spark_queries, "_trained", {})
    plan = spark_queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= EXCHANGES[name]


def test_buckets_hold_what_was_counted(spark, micro):
    for n in (2, 3, 4):
        assert "w1" in micro[n].columns and micro[n].count() > 0
    low, high = micro["contexts2"], micro[2]
    assert sorted(map(tuple, low.drop("n_next").collect())) == sorted(map(tuple, high.collect()))
