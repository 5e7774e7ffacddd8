"""Every formula on the corpus 'red fox red fox ran / red fox sat / red fox ran'."""

import pytest
from pyspark.sql import functions as F

from wordloom.operators import counts, kneser_ney, mle, ranking
from wordloom.plans import models, predict


def table(df, n, *cols):
    words = ["word"] if n == 1 else [f"w{i}" for i in range(1, n + 1)]
    return {" ".join(row[w] for w in words): [row[c] for c in cols] for row in df.collect()}


def check(got, want):
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-10), key


@pytest.fixture(scope="module")
def uni(micro):
    return mle.unigram_mle(micro[1])


def test_unigrams(micro, uni):
    got = table(ranking.index_words(uni), 1, "uni_freq", "word_int", "uni_prob")
    check(got, {
        "fox": [4, 1, 4 / 11], "red": [4, 2, 4 / 11], "ran": [2, 3, 2 / 11], "sat": [1, 4, 1 / 11],
    })


def test_bigrams(micro, uni):
    smooth = mle.bigram_interpolated(mle.bigram_mle(micro[2], uni))
    check(table(smooth, 2, "bi_freq", "prob_mle", "smooth_mle"), {
        "red fox": [4, 1.0, 0.8409090909],
        "fox ran": [2, 0.5, 0.4659090909],
        "fox red": [1, 0.25, 0.2784090909],
        "fox sat": [1, 0.25, 0.2784090909],
    })
    kn = kneser_ney.bigram_kn_interpolated(kneser_ney.bigram_kn(micro[2], uni))
    check(table(kn, 2, "prob_kn", "smooth_kn"), {
        "red fox": [0.890625, 0.7588778409],
        "fox ran": [0.421875, 0.4073153409],
        "fox red": [0.171875, 0.2198153409],
        "fox sat": [0.171875, 0.2198153409],
    })


def test_trigrams(micro, uni):
    bi = mle.bigram_mle(micro[2], uni)
    smooth = mle.trigram_interpolated(mle.trigram_mle(micro[3], bi))
    check(table(smooth, 3, "tri_freq", "tri_prob", "smooth_prob"), {
        "red fox ran": [2, 0.5, 0.6209090909],
        "red fox red": [1, 0.25, 0.4759090909],
        "red fox sat": [1, 0.25, 0.4759090909],
        "fox red fox": [1, 1.0, 0.7009090909],
    })
    kn = kneser_ney.trigram_kn(micro[3], micro[2], uni)
    check(table(kn, 3, "kn_part1", "kn_part2", "prob_kn"), {
        "red fox ran": [0.8, 0.421875, 0.3375],
        "red fox red": [0.55, 0.171875, 0.09453125],
        "red fox sat": [0.55, 0.171875, 0.09453125],
        "fox red fox": [1.0, 0.890625, 0.890625],
    })


def test_tetragrams(micro, uni):
    tri = mle.trigram_mle(micro[3], mle.bigram_mle(micro[2], uni))
    smooth = mle.tetragram_interpolated(mle.tetragram_mle(micro[4], tri))
    check(table(smooth, 4, "tetra_freq", "tetra_prob", "smooth_prob"), {
        "red fox red fox": [1, 1.0, 0.7113636364],
        "fox red fox ran": [1, 1.0, 0.7863636364],
    })


def test_discounts(micro):
    assert counts.discount(micro[2], "bi_freq").first() == (2, 1, 0.5)
    assert counts.discount(micro[3], "tri_freq").first() == (3, 1, 0.6)
    ones = micro[3].where("tri_freq = 1")
    assert counts.discount(ones, "tri_freq").first() == (3, 0, 1.0)
    twos = micro[3].where("tri_freq = 2")
    assert counts.discount(twos, "tri_freq").first() == (0, 1, 0.0)


def test_type_counts(micro):
    got = {r.word: (r.n_after, r.n_before) for r in counts.continuation_counts(micro[2]).collect()}
    assert got == {"red": (1, 1), "fox": (3, 1), "ran": (0, 1), "sat": (0, 1)}
    got = {(r.w1, r.w2): r.n_w1w2 for r in counts.context_types(micro[3]).collect()}
    assert got == {("red", "fox"): 3, ("fox", "red"): 1}
    got = {r.freq: r.n_types for r in counts.count_of_counts(micro[2], "bi_freq").collect()}
    assert got == {4: 1, 2: 1, 1: 2}


def test_target_lower_order(micro, uni):
    bi = mle.bigram_mle(micro[2], uni)
    smooth = mle.bigram_interpolated(bi, lower_order="target", uni=uni)
    got = table(smooth, 2, "smooth_mle")
    assert got["fox ran"] == pytest.approx([0.75 * 0.5 + 0.25 * 2 / 11])
    tri = mle.trigram_mle(micro[3], bi)
    smooth = mle.trigram_interpolated(tri, lower_order="target", bi=bi, uni=uni)
    got = table(smooth, 3, "smooth_prob")
    assert got["red fox ran"] == pytest.approx([0.58 * 0.5 + 0.28 * 0.5 + 0.14 * 2 / 11])
    tetra = mle.tetragram_mle(micro[4], tri)
    smooth = mle.tetragram_interpolated(tetra, lower_order="target", tri=tri, bi=bi, uni=uni)
    got = table(smooth, 4, "smooth_prob")
    want = 0.4 * 1.0 + 0.3 * 0.5 + 0.2 * 0.5 + 0.1 * 2 / 11
    assert got["fox red fox ran"] == pytest.approx([want])
    with pytest.raises(ValueError):
        mle.bigram_interpolated(bi, lower_order="target")


def test_published_kn_forms(micro, uni):
    got = table(kneser_ney.bigram_kn(micro[2], uni, normalizer="types"), 2, "prob_kn")
    # (2 - .5) / 4 + .5 / 4 * 3 * 1 / 4 types
    assert got["fox ran"] == pytest.approx([1.5 / 4 + 0.5 / 4 * 3 / 4])
    got = table(kneser_ney.trigram_kn(micro[3], micro[2], uni, combine="interpolated"), 3, "prob_kn")
    # (2 - .6) / 4 + .6 / 4 * 3 * part 2
    assert got["red fox ran"] == pytest.approx([1.4 / 4 + 0.6 / 4 * 3 * 0.421875])


def answers(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r.query_id, r.position)):
        out.setdefault(row.query_id, []).append((row.position, row.word, row.order, row.score))
    return out


PHRASES = [(1, "red fox"), (2, "fox red"), (3, "fox"), (4, "ran"), (5, "zzz"), (6, ""), (7, "The red fox!")]


@pytest.fixture(scope="module")
def phrases(spark):
    return spark.createDataFrame(PHRASES, "query_id bigint, text string")


def words(rows):
    return [word for _, word, _, _ in rows]


def test_backoff_trigram(phrases, micro):
    model = models.mle_model(tables=micro, max_n=3, stop_words=())
    got = answers(predict.predict_backoff(phrases, model, 3))
    message = [(1, predict.EMPTY_MESSAGE, 0, None)]
    assert words(got[1]) == ["ran", "red", "sat"]
    assert [o for _, _, o, _ in got[1]] == [3, 3, 3]
    assert got[2] == [(1, "fox", 3, 1.0), (2, "fox", 2, 1.0)]
    assert words(got[3]) == ["ran", "red", "sat"]
    assert got[4] == message and got[6] == message
    assert words(got[5]) == ["fox", "red", "ran"]
    assert got[7] == got[1]


def test_backoff_tetragram(phrases, micro):
    model = models.mle_model(tables=micro, max_n=4, stop_words=())
    got = answers(predict.predict_backoff(phrases, model, 4, stop_words=("red",)))
    assert words(got[1]) == ["ran", "red", "sat"]
    # 'the red fox' has an unknown word, so the trimmed unigrams are used
    assert words(got[7]) == ["fox", "ran", "sat"]
    nth = answers(predict.predict_backoff(phrases, model, 4, oov="nth", stop_words=("red",)))
    assert words(nth[7]) == ["sat"]
    assert words(nth[5]) == ["red"]
    two = phrases.sparkSession.createDataFrame([(1, "x fox"), (2, "red fox red")], phrases.schema)
    nth = answers(predict.predict_backoff(two, model, 4, oov="nth", stop_words=("red",)))
    assert words(nth[1]) == ["ran"]
    # one tetragram, one trigram and one bigram match, all appended
    assert nth[2] == [(1, "fox", 4, 1.0), (2, "fox", 3, 1.0), (3, "fox", 2, 1.0)]


def test_interpolated_predictions(phrases, micro):
    model = models.interpolated_model(tables=micro, stop_words=())
    got = answers(predict.predict_interpolated(phrases, model))
    assert words(got[1]) == ["ran", "red", "sat"]
    assert [s for *_, s in got[1]] == pytest.approx([0.6209090909, 0.4759090909, 0.4759090909])
    # the bigram score beats the trigram score of the same word
    assert got[2] == [(1, "fox", 2, pytest.approx(0.8409090909))]
    assert words(got[4]) == [predict.EMPTY_MESSAGE]
    assert words(got[5]) == [predict.EMPTY_MESSAGE]


def test_a_hot_phrase_is_split(spark, micro, monkeypatch):
    """A third of all phrases end alike: same answers, over many tasks."""
    from wordloom.operators import joins

    hot = "if(id % 3 = 0, 'red fox', if(id % 3 = 1, concat('x', id), 'fox red'))"
    many = spark.range(600).selectExpr("id as query_id", f"{hot} as text")
    model = models.mle_model(tables=micro, max_n=3, stop_words=())
    plain = answers(predict.predict_backoff(many, model, 3))
    monkeypatch.setattr(joins, "SALT_ABOVE_BYTES", 0)
    monkeypatch.setattr(joins, "_partitions", lambda df, nbytes: 64)
    assert answers(predict.predict_backoff(many, model, 3)) == plain
    assert len(plain) == 600 and words(plain[0]) == ["ran", "red", "sat"]
    smooth = models.interpolated_model(tables=micro, stop_words=())
    got = answers(predict.predict_interpolated(many, smooth))
    assert len(got) == 600 and words(got[0]) == ["ran", "red", "sat"]


def test_written_model(spark, micro, phrases):
    model = models.mle_model(tables=micro, max_n=3, stop_words=())
    written = models.save_model(model)
    assert answers(predict.predict_backoff(phrases, written)) == answers(
        predict.predict_backoff(phrases, model)
    )


def test_lookup(spark, micro):
    top = models.mle_top(micro, 2, stop_words=())
    contexts = spark.createDataFrame([("fox",), ("ran",)], "w1 string")
    assert {r.word for r in predict.lookup(top, contexts, ["w1"]).collect()} == {"ran", "red", "sat"}


def test_decode_words(micro):
    out = models.indexed_tables(micro[1], micro[2], micro[3])
    got = {(r.w1, r.w2, r.w3): r.tri_freq for r in models.decode_words(out[3], out[1]).collect()}
    assert got == {tuple(r)[:3]: r.tri_freq for r in micro[3].collect()}


def test_scaled_score(micro):
    top = models.mle_top(micro, 2, stop_words=())
    got = mle.scaled_score(top, mle.BIGRAM_SCALE).where("w1 = 'red'").first()
    assert got.score == pytest.approx(0.2)


def test_indexed_tables(micro):
    out = models.indexed_tables(micro[1], micro[2], micro[3], micro[4])
    ids = {"fox": 1, "red": 2, "ran": 3, "sat": 4}
    got = {tuple(r[:2]): tuple(r[2:]) for r in out[2].collect()}
    assert got[(ids["fox"], ids["ran"])] == (2, 0.5, 4, pytest.approx(4 / 11))
    got = {tuple(r[:3]): tuple(r[3:]) for r in out[3].collect()}
    assert got[(2, 1, 3)] == (2, 4, 0.5) and len(got) == 4
    got = {tuple(r[:4]): tuple(r[4:]) for r in out[4].collect()}
    assert got == {(2, 1, 2, 1): (1, 1.0), (1, 2, 1, 3): (1, 1.0)}
    cut = models.indexed_tables(micro[1], micro[2], micro[3], stop_words=("ran",))
    assert cut[3].count() == 3


def test_kn_model_tables(micro):
    model = models.kn_model(tables=micro, stop_words=())
    top = model["trigram_kn"].where("w1 = 'red'").orderBy("rank").collect()
    assert [r.word for r in top] == ["ran", "red", "sat"]
    assert top[0].prob == pytest.approx(0.3375)
    for name in ("bigram_mle", "bigram_kn", "bigram_kn_interpolated", "trigram_mle",
                 "bigram_mle_interpolated", "trigram_mle_interpolated"):
        assert model[name].groupBy("w1").agg(F.count("*").alias("n")).where("n > 5").count() == 0


def test_named_model_and_phrases_without_text(spark, micro, tmp_path):
    from wordloom.plans import models, predict

    saved = models.save_model(models.mle_model(tables=micro, max_n=3), str(tmp_path), "mle")
    models.save_model(micro, str(tmp_path), "counts")
    other = spark.newSession()
    loaded = models.load_model(other, str(tmp_path), "mle")
    assert loaded.keys() == saved.keys()
    counts = models.load_model(other, str(tmp_path), "counts")
    assert counts.keys() == micro.keys() and counts[2].count() == micro[2].count()
    queries = other.createDataFrame([(1, "red fox"), (2, None), (3, "")], "query_id bigint, text string")
    rows = predict.predict_backoff(queries, loaded, 3).collect()
    answers = {q: [r.word for r in sorted(rows, key=lambda r: r.position) if r.query_id == q] for q in (1, 2, 3)}
    assert answers == {1: ["ran", "red", "sat"], 2: [predict.EMPTY_MESSAGE], 3: [predict.EMPTY_MESSAGE]}
    with pytest.raises(ValueError):
        models.save_model(micro, name="nowhere")
