import hashlib
import math

import pytest
from pyspark.sql import functions as F

from wordloom.operators import sampling


@pytest.fixture(scope="module")
def docs(spark):
    """One source with a third of the records, one tiny, one without a name."""
    source = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 1 THEN 'tiny' WHEN id % 7 = 0 THEN NULL"
                    " ELSE concat('s', id % 5) END")
    return spark.range(3000).select(F.col("id").alias("doc_id"), source.alias("source"))


def brute(docs, frac, n_test, seed=1234):
    groups = {}
    for r in docs.collect():
        parts = [str(seed)] + ([r.source] if r.source is not None else []) + [str(r.doc_id)]
        key = hashlib.md5("~".join(parts).encode()).hexdigest()
        groups.setdefault(r.source, []).append((key, r.doc_id))
    out = {}
    for members in groups.values():
        for i, (_, doc) in enumerate(sorted(members)[: math.ceil(len(members) * frac)]):
            out[doc] = "test" if i < n_test else "train"
    return out


@pytest.mark.parametrize("digits", [4, 1])
def test_exact_sample(docs, monkeypatch, digits):
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", digits)
    got = {r.doc_id: r.split for r in sampling.sample_train_test(docs, frac=0.2, n_test=20).collect()}
    assert got == brute(docs, 0.2, 20)


def test_two_steps_equal_one(docs):
    sampled = sampling.sample_records(docs, frac=0.3)
    two = {r.doc_id: r.split for r in sampling.train_test_split(sampled, n_test=10).collect()}
    assert two == brute(docs, 0.3, 10)


def test_no_test_records_and_only_test_records(docs):
    none = sampling.sample_train_test(docs, n_test=0)
    assert none.where("split = 'test'").count() == 0 and none.count() == len(brute(docs, 0.2, 0))
    assert sampling.sample_train_test(docs, n_test=10**6).where("split = 'train'").count() == 0


def test_seeds_per_source(docs):
    hot = docs.where("source = 'hot'")
    per_source = sampling.sample_records(hot, seed={"hot": 2345, "tiny": 1})
    assert {r.doc_id for r in per_source.collect()} == set(brute(hot, 0.2, 0, 2345))


def test_text_is_not_shuffled(docs):
    plan = sampling.sample_train_test(docs.withColumn("text", F.lit("x")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
