import random
import re

import pytest
from pyspark.sql import functions as F

from wordloom.functions import text, words
from wordloom.plans import models


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r[0] for r in df.coalesce(1).orderBy("i").select(expr(F.col("text"))).collect()]


CLEANING = [
    (" b c d x", " c x"),
    ("x b y c ", "x y "),
    ("see www.foo.com now and then ok", "see ok"),
    ("a <> b <85> <92>s", "a '   's"),
    ("Hi! There? yes. 3.5", "hi there yes 3 5"),
    ("", ""),
]


def test_cleaning_cases(spark):
    assert column(spark, [a for a, _ in CLEANING], text.clean_text) == [b for _, b in CLEANING]


def clean_by_rule(line):
    """The cleaning rules one after the other, on one line."""
    line = line.lower()
    line = re.sub(r"[/@|]", " ", line)
    line = line.replace("-", " ").replace("<>", "'")
    for mark in (r"\.", r"\?", "!"):
        line = re.sub(f"{mark} |{mark}\\Z", " ", line)
    line = line.replace("<85>", " ").replace("<92>", "'").replace("&", " and ")
    line = "".join(c if c.isalnum() or c.isspace() or c in "'<>" else " " for c in line)
    line = re.sub(" www(.+) ", " ", line)
    return re.sub(" [b-hj-z] ", " ", line)


def words_by_rule(cleaned):
    stripped = [w.strip("'<>") for w in cleaned.split()]
    return [w for w in stripped if w and not re.fullmatch("[0-9]+", w)]


def test_one_pass_over_a_record_equals_the_rules_on_each_line(spark):
    rng = random.Random(7)
    parts = [" ", " ", " ", "\n", ".", "?", "!", "a", "b", "c", "é", "7", "45", "'", "<", ">", "-", "/",
             "@", "|", "&", "www", " www.x", "<85>", "<92>", "<>", "_", "word"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(20000)]
    cleaned = ["\n".join(map(clean_by_rule, t.split("\n"))) for t in texts]
    rows = [(t, c, words_by_rule(c)) for t, c in zip(texts, cleaned)]
    df = spark.createDataFrame(rows, "text string, cleaned string, tokens array<string>")
    got = text.clean_text(F.col("text"))
    wrong = df.where((got != F.col("cleaned")) | (text.tokenize(got) != F.col("tokens")))
    assert wrong.collect() == []


def test_query_words_equal_the_rules(spark):
    rng = random.Random(11)
    parts = [" ", " ", "a", "é", "7", "'", "-", "<", ".", "word", "_", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(20))) for _ in range(5000)]
    rows = []
    for t in texts:
        spaced = "".join(c if c.isalnum() or c.isspace() or c in "'-" else " " for c in t.lower())
        words_ = [w.strip("'-") for w in spaced.split()]
        rows.append((t, [w for w in words_ if w and not re.fullmatch("[0-9]+", w)]))
    df = spark.createDataFrame(rows, "text string, tokens array<string>")
    assert df.where(text.tokenize_query(F.col("text")) != F.col("tokens")).collect() == []


def test_long_runs_of_marks(spark):
    """Linear time on junk: a quadratic pattern would not come back."""
    junk = ">" * 400_000 + "x" + "'" * 400_000
    got = column(spark, [junk, "." * 400_000 + "x"], lambda c: text.tokenize(text.clean_text(c)))
    assert got == [["x"], ["x"]]


def test_line_ends(spark):
    got = column(spark, ["one.\r\ntwo.\rthree.\n"], lambda c: text.tokenize(text.clean_text(c)))
    assert got == [["one", "two", "three"]]


def test_tokenize(spark):
    got = column(
        spark,
        ["it's 'quoted' <b> 45 '45' 4th x4 '' <>", "   ", "A  b"],
        text.tokenize,
    )
    assert got == [["it's", "quoted", "b", "4th", "x4"], [], ["a", "b"]]


def test_tokenize_query(spark):
    got = column(spark, ["The well-known, 12 -dash- 'it's' (x_y)!", "99 ..", ""], text.tokenize_query)
    assert got == [["the", "well-known", "dash", "it's", "x", "y"], [], []]


def test_ngrams_and_last_tokens(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.coalesce(1).select(text.ngrams(F.col("t"), 2)).collect()]
    assert got == [[["a", "b"], ["b", "a"]], [], []]
    got = [r[0] for r in df.coalesce(1).select(text.last_tokens(F.col("t"), 2)).collect()]
    assert got == [["b", "a"], ["a"], []]


def test_ngram_strings(spark):
    df = spark.createDataFrame([("red fox ran",)], "gram string")
    row = df.select(*text.split_ngram(F.col("gram"), 3)).select(
        text.prefix_ngram(3).alias("p"), text.suffix_ngram(3).alias("s"),
        text.context_key("w1", "w2").alias("k"), text.word_length(F.col("w3")).alias("l"),
    ).first()
    assert (row.p, row.s, tuple(row.k), row.l) == ("red fox", "fox ran", ("red", "fox"), 3)


def test_context_keys_do_not_collide(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "w1 string, w2 string")
    assert df.select(text.context_key("w1", "w2").alias("k")).distinct().count() == 2


@pytest.mark.parametrize("extra", [0, 12_000])
def test_block_list_bridges_gaps(spark, extra):
    """One result for every length of the list, also for equal, null and keyless records."""
    rows = [(1, "ox bad by ox bad"), (1, "ox bad by ox bad"), (1, "worse fox"), (2, "bad worse"), (3, ""), (4, "by by"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    listed = spark.createDataFrame([("bad",), ("worse",), ("bad",), (None,)], "word string")
    listed = listed.unionByName(spark.range(extra).select(F.concat(F.lit("no"), "id").alias("word")))
    want = [(1, ["ox", "by", "ox"]), (1, ["ox", "by", "ox"]), (1, ["fox"]), (2, []), (3, []), (4, ["by", "by"]), (5, None)]
    got = [tuple(r) for r in models.tokenized(docs, listed).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    keyless = [r.tokens for r in models.tokenized(docs.select("text"), listed).collect()]
    assert sorted(keyless, key=str) == sorted([tokens for _, tokens in want], key=str)


def test_word_lists(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert sorted(words.STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))
    df = spark.createDataFrame([(w,) for w in ["us", "go", "xy", "wtju", "adhd", "the", "word", "4x"]], "word string")
    assert {r.word for r in words.noise_words(df).collect()} == {"xy", "wtju", "adhd", "4x"}
    assert {r.word for r in words.trim_predictions(df, "word").collect()} == {"us", "go", "word"}
    listed = spark.createDataFrame([("word",)], "word string")
    assert words.drop_stop_words(df, "word", listed).count() == 7
    assert words.drop_digit_led(df, "word").count() == 7


@pytest.mark.parametrize("listed", [0, 3, 3000])
def test_listed_words_go_and_other_records_stay_where_they_are(spark, listed, tmp_path):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = [(i, rng.choices(vocabulary, k=rng.randrange(12)), None) for i in range(300)]
    # Equal rows, null tokens, columns with the names used inside.
    rows += [rows[0], rows[0], (None, None, "x"), (None, [], None), (1, ["w0", "zz", "w0"], None)]
    df = spark.createDataFrame(rows, "_row int, tokens array<string>, _suspects string")
    block = [f"w{i}" for i in range(2)] + ["zz", None] if listed == 3 else [f"w{7 * i}" for i in range(listed)]
    words_ = spark.createDataFrame([(w,) for w in block] + [("w0",)] * bool(listed), "word string")
    got = text.remove_listed_features(df, words_, str(tmp_path))
    assert got.columns == df.columns
    gone = set(block)
    want = [(i, None if t is None else [w for w in t if w not in gone], s) for i, t, s in rows]
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("Union") :]
    first = first[: first.index("FileScan")]
    assert "Exchange" not in first and "Join" not in first


def test_the_filter_lets_few_words_through(spark):
    listed = spark.range(20_000).selectExpr("concat('w', id) as word")
    bits, slots = text.word_filter(listed)
    others = spark.range(20_000).selectExpr("if(id < 10000, concat('w', id), concat('x', id)) as word")
    told = others.withColumn("bits", bits).select("word", text.may_be_listed(F.col("word"), F.col("bits"), slots).alias("may"))
    got = told.groupBy(F.col("word").startswith("w").alias("own")).agg(F.count_if("may").alias("n"))
    n = {r.own: r.n for r in got.collect()}
    assert n[True] == 10_000 and n[False] < 200


def test_records_full_of_listed_words_are_looked_up_by_the_few_words_they_keep(spark, tmp_path):
    """Only words that the filter lets through by mistake travel, not the listed ones of each record."""
    rng = random.Random(3)
    rows = [(i, [f"w{rng.randrange(4000)}" for _ in range(400)] + [None]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id int, tokens array<string>")
    listed = spark.range(2000).selectExpr("concat('w', id) as word")
    got = {r.doc_id: r.tokens for r in text.remove_listed_features(df, listed, str(tmp_path)).collect()}
    # A null token is not listed and stays.
    assert got == {i: [w for w in t if w is None or int(w[1:]) >= 2000] for i, t in rows}
    (spared,) = tmp_path.glob("spared_words-*")
    words_ = spark.read.parquet(str(spared)).selectExpr("explode(_spared) as word")
    assert words_.count() < 100 and not words_.join(listed, "word").count()
