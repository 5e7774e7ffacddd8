from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.functions.text import tokenize
from wordloom.operators import counts, joins, kneser_ney, mle, ranking
from wordloom.plans import models

SF = "/root/testdata/sf0.001/documents.parquet"
# types, tokens, types that occur once, types that occur twice
GOLDEN = {
    1: (22650, 79225, 14785, 3880),
    2: (57092, 79025, 47352, 6735),
    3: (64155, 78826, 55757, 6447),
    4: (65165, 78629, 57140, 6245),
}


@pytest.fixture(scope="module")
def tables(spark):
    return models.train_counts(spark.read.parquet(SF).select("doc_id", "text"))


def test_golden_cardinalities(tables):
    for n, want in GOLDEN.items():
        freq = counts.FREQ[n]
        row = tables[n].agg(
            F.count("*"), F.sum(freq), F.count_if(F.col(freq) == 1), F.count_if(F.col(freq) == 2)
        ).first()
        assert tuple(row) == want


def test_rollup_equals_direct_counts_and_brute_force(spark):
    texts = ["a b a b 4c a", "a", "", "4c 4d", "b a b", "a b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    tokens = docs.select(tokenize(F.col("text")).alias("tokens"))
    rolled = counts.count_tables(tokens)
    for n in range(1, 5):
        want = Counter()
        for t in texts:
            w = t.split()
            want.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if not w[i][0].isdigit())
        direct = counts.ngram_counts(tokens, n)
        for table in (rolled[n], direct):
            assert {tuple(r)[:-1]: r[-1] for r in table.collect()} == dict(want)
    got = {r.word: r.n_next for r in rolled["contexts1"].collect()}
    assert got == {"a": 1, "b": 1}  # digit-led successors are not in the dictionary


def test_types_that_follow_match_the_direct_counts(tables):
    tri = mle.in_vocabulary(tables[3], ["w1", "w2", "w3"])
    rolled = mle.in_vocabulary(tables["contexts2"], ["w1", "w2"]).where("n_next > 0")
    diff = rolled.select("w1", "w2", "n_next").exceptAll(
        counts.context_types(tri).withColumnRenamed("n_w1w2", "n_next")
    )
    assert diff.count() == 0 and rolled.count() == counts.context_types(tri).count()


def test_kneser_ney_needs_no_precounted_contexts(tables):
    uni = mle.unigram_mle(tables[1])
    a = kneser_ney.bigram_kn(tables[2], uni)
    b = kneser_ney.bigram_kn(tables[2], uni, contexts=tables["contexts1"])
    assert a.exceptAll(b).count() == 0
    a = kneser_ney.trigram_kn(tables[3], tables[2], uni)
    b = kneser_ney.trigram_kn(tables[3], tables[2], uni, contexts=tables["contexts2"])
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_invariants(tables):
    out = models.probabilities(tables)
    assert out[1].agg(F.sum("uni_prob")).first()[0] == pytest.approx(1.0)
    for n, prob in ((2, "prob_mle"), (3, "tri_prob"), (4, "tetra_prob")):
        assert out[n].where((F.col(prob) <= 0) | (F.col(prob) > 1)).count() == 0
        per_context = out[n].groupBy(*counts.words_of(n)[:-1]).agg(F.sum(prob).alias("p"))
        assert per_context.where("p > 1 + 1e-9").count() == 0


def test_word_ids(tables):
    got = [(r.uni_freq, r.word) for r in ranking.index_words(tables[1]).orderBy("word_int").collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1].encode()))
    ids = ranking.index_words(tables[1]).agg(F.min("word_int"), F.max("word_int"), F.count("*")).first()
    assert tuple(ids) == (1, 22650, 22650)


def test_ranking_counts_equals_ranking_probabilities(tables):
    out = models.probabilities(tables)
    cases = [(2, "prob_mle", "prob"), (3, "tri_prob", "prob"), (4, "smooth_prob", "smooth_prob")]
    for n, full, kept in cases:
        fast = models.interpolated_top(tables, n, 5)
        slow = models.ranked_model(out[n], n, 5, full)
        context = counts.words_of(n)[:-1]
        a = fast.select(*context, "word", "rank", F.col(kept).alias("prob"))
        assert a.exceptAll(slow.select(*a.columns)).count() == 0 and a.count() == slow.count()


def test_trim_options(tables):
    from wordloom.functions.words import STOP_WORDS

    top = models.mle_top(tables, 3, trim_context=True)
    assert top.where(F.col("w2").isin(*STOP_WORDS) | F.col("word").isin(*STOP_WORDS)).count() == 0
    first = models.mle_top(tables, 4, trim_on="w1")
    assert first.where(F.col("w1").isin(*STOP_WORDS)).count() == 0
    assert first.where(F.col("word").isin(*STOP_WORDS)).count() > 0
    restricted = tables[1].where("word < 'm'").select("word")
    bi = mle.bigram_mle(tables[2], mle.unigram_mle(tables[1]), vocabulary=restricted)
    assert bi.where("w1 >= 'm' or w2 >= 'm'").count() == 0 and bi.count() > 0


def test_trained_without_record_ids(spark):
    docs = spark.createDataFrame([("a b",), ("a c",)], "text string")
    assert models.train_counts(docs, 2)[2].count() == 2


def test_hot_contexts_are_split(spark, monkeypatch):
    """A third of the n-grams under one context: salted, spread, and the same result."""
    grams = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('w', id)) as w1", "concat('x', id) as w2", "1L as bi_freq"
    )
    lower = grams.groupBy("w1").agg(F.sum("bi_freq").alias("uni_freq"))
    plain = joins.context_join(grams, lower, ["w1"], ["w2"], lower, "uni_freq")
    monkeypatch.setattr(joins, "SALT_ABOVE_BYTES", 0)
    monkeypatch.setattr(joins, "_partitions", lambda df, nbytes: 64)
    hot = joins.hot_keys(lower, ["w1"], "uni_freq", 64).collect()
    assert [(r.w1, r.n_salts) for r in hot] == [("hot", 43)]
    salted = joins.context_join(grams, lower, ["w1"], ["w2"], lower, "uni_freq")
    assert sorted(salted.columns) == sorted(plain.columns)
    assert salted.select(*plain.columns).exceptAll(plain).count() == 0
    assert salted.count() == plain.count() == 3000


def test_models_with_hot_contexts_split(tables, monkeypatch):
    uni = mle.unigram_mle(tables[1])
    plain = kneser_ney.trigram_kn(tables[3], tables[2], uni, contexts=tables["contexts2"])
    want = plain.agg(F.count("*"), F.sum("prob_kn"), F.max("prob_kn")).first()
    monkeypatch.setattr(joins, "SALT_ABOVE_BYTES", 0)
    monkeypatch.setattr(joins, "_partitions", lambda df, nbytes: 500)
    salted = kneser_ney.trigram_kn(tables[3], tables[2], uni, contexts=tables["contexts2"])
    got = salted.agg(F.count("*"), F.sum("prob_kn"), F.max("prob_kn")).first()
    assert tuple(got) == pytest.approx(tuple(want))
    assert want[1] == pytest.approx(7164.92448, abs=1e-5)
