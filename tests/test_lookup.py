"""Look-up tables, named models, and the folders that stages leave."""

import os

import pytest
from pyspark.sql import functions as F

from wordloom import workspace
from wordloom.operators import joins
from wordloom.plans import lookup, models, predict

PHRASES = [
    (1, "red fox"), (2, "fox red"), (3, "fox"), (4, "ran"), (5, "zzz"), (6, ""), (7, "The red fox!"), (8, None),
    (9, "fox fox"), (10, "red red fox red"), (11, "zzz red fox"), (12, "red fox red fox"),
]


@pytest.fixture(scope="module")
def phrases(spark):
    return spark.createDataFrame(PHRASES, "query_id bigint, text string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ancestors(lines):
    """The nodes above the last line of a plan, the nearest first."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, at = [], depth(lines[-1])
    for line in reversed(lines):
        if depth(line) < at:
            out.append(line)
            at = depth(line)
    return out


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_rows(micro):
    model = models.mle_model(tables=micro, max_n=4, stop_words=())
    got = {(r.key, r.order, r.rank, r.word) for r in lookup.lookup_rows(model).collect()}
    sep = lookup.SEPARATOR
    assert ("fox", 1, 0, "fox") in got and ("fox", 2, 1, "ran") in got
    assert (f"red{sep}fox", 3, 1, "ran") in got and (f"red{sep}fox{sep}red", 4, 1, "fox") in got
    assert len(got) == sum(model[n].count() for n in ("unigrams", 2, 3, 4))


def test_keys_of_contexts(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["x"],), ([],)], "context array<string>")
    sep = lookup.SEPARATOR
    got = {}
    for r in lookup.context_keys(df).collect():
        got.setdefault(tuple(r.context), []).append((r.key, r.wanted))
    assert sorted(got["a", "b", "a"]) == [("a", False), ("a", True), (f"a{sep}b{sep}a", True), ("b", False), (f"b{sep}a", True)]
    assert got["x",] == [("x", True)] and got[()] == [(None, None)]


@pytest.mark.parametrize("oov", ["top3", "nth"])
def test_written_and_plain_models_answer_alike(micro, phrases, oov):
    model = models.mle_model(tables=micro, max_n=4, stop_words=())
    written = models.save_model(model)
    assert "lookup" in written
    for n in (3, 4):
        want = rows(predict.predict_backoff(phrases, model, n, oov))
        assert rows(predict.predict_backoff(phrases, written, n, oov)) == want and len({r[0] for r in want}) == len(PHRASES)


def test_the_model_side_is_not_moved(spark, micro, phrases, no_broadcast, tmp_path):
    model = models.interpolated_model(tables=micro, stop_words=())
    models.save_model(model, str(tmp_path), "smooth")
    loaded = models.load_model(spark.newSession(), str(tmp_path), "smooth")
    for saved in (models.save_model(model), loaded):
        for answer in (
            predict.predict_backoff(phrases, saved, 4),
            predict.predict_interpolated(phrases, saved),
        ):
            text = plan(answer)
            assert text.count("Bucketed: true") == 1, text
            assert "SelectedBucketsCount" in text
            above = ancestors(text[: text.index("Bucketed: true")].splitlines())
            names = above[: next(i for i, line in enumerate(above) if "Join" in line)]
            assert not any("Exchange" in line for line in names), names
    assert rows(predict.predict_interpolated(phrases, loaded)) == rows(predict.predict_interpolated(phrases, model))


def test_hot_keys_meet_few_rows(spark, micro, monkeypatch):
    hot = "if(id % 3 = 0, 'red fox', if(id % 3 = 1, concat('x', id, ' fox'), concat('y', id)))"
    many = spark.range(900).selectExpr("id as query_id", f"{hot} as text")
    saved = models.save_model(models.mle_model(tables=micro, max_n=3, stop_words=()))
    plain = rows(predict.predict_backoff(many, saved, 3))
    monkeypatch.setattr(joins, "SALT_ABOVE_BYTES", 0)
    monkeypatch.setattr(joins, "_partitions", lambda df, nbytes: 64)
    assert rows(predict.predict_backoff(many, saved, 3)) == plain and len({r[0] for r in plain}) == 900


class Failed(Exception):
    pass


def test_a_failed_save_leaves_the_model_as_it_was(spark, micro, phrases, tmp_path, monkeypatch):
    folder = str(tmp_path)
    first = models.mle_model(tables=micro, max_n=3, stop_words=())
    models.save_model(first, folder, "mle")
    want = rows(predict.predict_backoff(phrases, models.load_model(spark, folder, "mle"), 3))

    def fail(*_):
        raise Failed

    other = {**first, "unigrams": first["unigrams"].where("word <> 'fox'")}
    with monkeypatch.context() as patched:
        patched.setattr(models, "write_lookup", fail)
        with pytest.raises(Failed):
            models.save_model(other, folder, "mle")
    assert rows(predict.predict_backoff(phrases, models.load_model(spark, folder, "mle"), 3)) == want
    held = models.load_model(spark, folder, "mle")
    models.save_model(other, folder, "mle")
    # A reader that loaded before keeps its version; the next one gets the new one.
    assert rows(predict.predict_backoff(phrases, held, 3)) == want
    assert models.load_model(spark, folder, "mle")["unigrams"].count() == 3
    assert models.drop_versions(spark, folder, "mle") == 2
    assert sum(name.startswith("version=") for name in os.listdir(f"{folder}/mle")) == 1
    assert models.load_model(spark, folder, "mle")["unigrams"].count() == 3


def test_scratch_is_empty_afterwards(spark, micro, phrases, tmp_path):
    model = models.mle_model(tables=micro, max_n=3, stop_words=())
    with pytest.raises(Failed):
        with workspace.scratch(spark) as folder:
            inner = workspace.shared_folder(spark)
            assert inner == folder
            predict.predict_backoff(phrases, model, 3).write.parquet(str(tmp_path / "answers"))
            assert os.listdir(folder)
            with workspace.scratch(spark) as nested:
                assert nested.startswith(folder)
            raise Failed
    assert not os.path.exists(folder) and workspace.shared_folder(spark) != folder
    assert spark.read.parquet(str(tmp_path / "answers")).select(F.countDistinct("query_id")).first()[0] == len(PHRASES)
