"""What is counted for a query, and how often the n-grams move."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry import spark_queries
from wordloom import workspace
from wordloom.operators import counts, joins, mle
from wordloom.plans import models

SF_DIR = "/root/testdata/sf0.001"
# The longest n-grams that a query reads.
ORDERS = {
    "unigram_mle": 1, "trimmed_unigrams": 1, "bigram_kn": 2, "bigram_kn_types": 2, "top5_bigram_mle": 2, "indexed_bigrams": 2,
    "bigram_interpolated_target": 2, "trigram_kn": 3, "scaled_score": 3, "decode_words": 3, "tetragram_mle": 4, "load_model": 4,
}


class Counted(Exception):
    pass


@pytest.mark.parametrize("name", ORDERS)
def test_no_longer_ngrams_are_counted_than_a_query_reads(spark, monkeypatch, name):
    def train(docs, max_n, *more, **named):
        raise Counted(max_n)

    monkeypatch.setattr(spark_queries, "_trained", {})
    monkeypatch.setattr(spark_queries, "_models", {})
    monkeypatch.setattr(models, "train_counts", train)
    with pytest.raises(Counted) as found:
        spark_queries.QUERIES[name](spark, SF_DIR)
    assert found.value.args == (ORDERS[name],)


def test_longer_tables_serve_shorter_orders(spark, monkeypatch):
    made = []
    monkeypatch.setattr(spark_queries, "_trained", {})
    monkeypatch.setattr(models, "train_counts", lambda docs, n: made.append(n) or n)
    assert [spark_queries.trained(spark, SF_DIR, n) for n in (3, 1, 2, 4, 2)] == [3, 3, 3, 4, 3] and made == [3, 4]


def odd_docs(spark):
    """Null and repeated ids, null, empty and equal texts."""
    rows = [(1, "a b a b 4c a"), (1, "a b a b 4c a"), (None, "b a b"), (None, "b a b"), (None, None), (2, ""), (3, None), (4, "4c 4d"), (5, "a")]
    return spark.createDataFrame(rows * 3, "doc_id bigint, text string")


@pytest.mark.parametrize("n", [3, 4])
def test_dealt_texts_give_the_same_tables(spark, n):
    docs = odd_docs(spark)
    plain = counts.count_tables(models.tokenized(docs), n)
    dealt = models.train_counts(docs, n)
    assert list(plain) == list(dealt)
    for key, table in plain.items():
        assert table.columns == dealt[key].columns
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, dealt[key].collect()))
    direct = counts.ngram_counts(models.dealt_tokens(docs, n), n, models.PART)
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, plain[n].collect()))


@pytest.mark.parametrize("n", [3, 4])
def test_ngrams_of_dealt_texts_move_once(spark, n):
    out = spark_queries.QUERIES[{3: "trigram_counts", 4: "tetragram_counts"}[n]](spark, SF_DIR)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("shufflepartitionidpassthrough") == 1
    # Counts of a part come before the n-grams move.
    assert plan.index("Exchange hashpartitioning(w1") < plan.index("partial_count(1)") < plan.index("shufflepartitionidpassthrough")


def test_counting_stage_of_long_ngrams_has_one_hash_exchange(spark, monkeypatch):
    plans = []

    def written(df, name, keys, buckets, folder=None, sort=()):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return df

    monkeypatch.setattr(counts, "materialize_bucketed", written)
    models.train_counts(spark.read.parquet(f"{SF_DIR}/documents.parquet"), 4)
    assert plans[0][0] == "grams4" and plans[0][1].count("Exchange hashpartitioning") == 1


def test_ngrams_move_as_one_text_and_lie_sorted(spark, monkeypatch):
    plans = {}
    written = counts.materialize_bucketed

    def seen(df, name, keys, buckets, folder=None, sort=()):
        plans[name] = (df._jdf.queryExecution().executedPlan().toString(), list(keys), list(sort))
        return written(df, name, keys, buckets, folder, sort)

    monkeypatch.setattr(counts, "materialize_bucketed", seen)
    for n in (2, 4):
        plans.clear()
        docs = odd_docs(spark)
        packed = models.train_counts(docs, n)
        made = dict(plans)
        for order in range(2, n + 1):
            plan, keys, sort = made[f"grams{order}"]
            assert keys == [f"w{i}" for i in range(1, order)] and sort == [*keys, f"w{order}"]
            moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert moves and all("gram#" in line for line in moves)
        assert made[f"contexts{n - 1}"][2] == made[f"contexts{n - 1}"][1]
        expected = counts.count_tables(models.tokenized(docs), n)
        for key, table in expected.items():
            assert sorted(map(tuple, table.collect())) == sorted(map(tuple, packed[key].collect()))


@pytest.mark.parametrize("n", [2, 3, 4])
def test_a_part_sends_a_bucket_one_row_per_frequency(spark, n):
    docs = spark.createDataFrame([(i, " ".join(f"x{(i * k) % 23}y" for k in range(60))) for i in range(40)], "doc_id bigint, text string")
    packed = counts.ngram_positions(models.dealt_tokens(docs, n), n, models.PART).select(models.PART, counts._joined(n))
    packed = packed.groupBy(models.PART, "gram").agg(F.count(F.lit(1)).alias("freq"))
    moved = counts._bundled(packed, n, models.PART, 5)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.index("split(grams") < plan.index("Exchange hashpartitioning") < plan.index("collect_list")
    found = {tuple(r[:n]): r.freq for r in moved.collect()}
    direct = packed.groupBy("gram").agg(F.sum("freq").alias("freq")).collect()
    expected = {tuple((r.gram.split(counts.SEPARATOR) + [None] * n)[:n]): r.freq for r in direct}
    assert found == expected and len(found) < sum(found.values())


@pytest.mark.parametrize("n", [2, 3, 4])
def test_bundled_tables_equal_plain_ones(spark, monkeypatch, n):
    sent = []
    bundled = counts._bundled
    monkeypatch.setattr(counts, "_bundled", lambda *args: sent.append(args[1:]) or bundled(*args))
    docs = odd_docs(spark)
    dealt, plain = models.train_counts(docs, n), counts.count_tables(models.tokenized(docs), n)
    assert [args[0] for args in sent] == [n]
    for key, table in plain.items():
        assert table.columns == dealt[key].columns
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, dealt[key].collect()))


def test_tokens_with_the_separator_are_counted_as_words(spark):
    docs = spark.createDataFrame([(["a\x1fb", "c", "a", "b"],)], "tokens array<string>")
    found = counts.count_tables(docs, 2)[2].collect()
    assert sorted((r.w1, r.w2) for r in found) == [("a", "b"), ("a\x1fb", "c"), ("c", "a")]


def test_partitions_follow_the_size_of_the_corpus(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    monkeypatch.setattr(counts, "estimated_bytes", lambda df: 1 << 30)
    out = counts.ngram_counts(models.dealt_tokens(docs, 3), 3, models.PART)
    assert f", {36 * 8})" in out._jdf.queryExecution().executedPlan().toString()
    assert out.agg(F.sum("tri_freq")).first()[0] == 78826


def moved(df):
    """The hash exchanges of a plan."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [3, 4])
def test_ngrams_meet_their_targets_in_one_move(micro, no_broadcast, n):
    full = models.probabilities(micro, n)
    table = full[n].drop("smooth_prob")
    if n == 3:
        out = mle.trigram_interpolated(table, lower_order="target", bi=full[2], uni=full[1])
    else:
        out = mle.tetragram_interpolated(table, lower_order="target", tri=full[3], bi=full[2], uni=full[1])
    # To the predicted word alone only bigrams go; the longer n-grams find all their targets at once.
    assert moved(out) and not any(f"hashpartitioning(w{n}#" in line for line in moved(out))


def test_a_saved_name_writes_each_table_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(spark_queries, "_models", {})
    monkeypatch.setattr(models, "materialize", lambda *args: written.append(args[1]))
    write = models.write_lookup
    monkeypatch.setattr(models, "write_lookup", lambda model, path: written.append("lookup") or write(model, path))
    loaded = spark_queries.load_model(spark, SF_DIR)
    assert written == ["lookup"]
    again = models.mle_top(spark_queries.trained(spark, SF_DIR, 2), 2)
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, again.select(*loaded.columns).collect()))


@pytest.mark.parametrize("n", [2, 3, 4])
def test_ngrams_of_a_first_word_move_as_one_text(spark, n):
    for docs in (odd_docs(spark), spark.createDataFrame([(i, " ".join(f"x{(i * k) % 23}y" for k in range(60))) for i in range(40)], "doc_id bigint, text string")):
        tokens = models.dealt_tokens(docs, n)
        packed = counts.ngram_counts(tokens, n, models.PART, packed=True)
        plain = counts.ngram_counts(tokens, n, models.PART)
        assert packed.columns == plain.columns and sorted(map(tuple, packed.collect())) == sorted(map(tuple, plain.collect()))
    text = spark_queries.QUERIES["tetragram_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert text.index("split(texts") < text.index("Exchange hashpartitioning(w1") < text.index("collect_list")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_in_buckets_of_a_context_are_not_split(spark, micro, monkeypatch, no_broadcast):
    monkeypatch.setattr(joins, "_partitions", lambda df, nbytes: 64)
    want = sorted(map(tuple, models.probabilities(micro)[4].collect()))
    monkeypatch.setattr(joins, "SALT_ABOVE_BYTES", 0)
    split = models.probabilities(micro)[4]
    assert "salt" not in plan(split) and sorted(map(tuple, split.collect())) == want
    # Joins that move a table anyway still deal its hot keys to several tasks.
    assert "salt" in plan(models.kn_trigrams(micro, mle.unigram_mle(micro[1])))
    assert joins.lies_by(micro[3], ["w1", "w2"]) and not joins.lies_by(micro[3], ["w2", "w3"])
    assert not joins.lies_by(spark.range(3), ["id"])


def test_moved_ngrams_are_not_sorted_for_a_join(micro, monkeypatch, no_broadcast):
    uni = mle.unigram_mle(micro[1])
    kn = models.kn_trigrams(micro, uni)
    assert "ShuffledHashJoin" in plan(kn) and "SortMergeJoin" not in plan(kn)
    want = sorted(map(tuple, kn.collect()))
    monkeypatch.setattr(joins, "HASH_EXPANSION", 1 << 60)
    sorted_kn = models.kn_trigrams(micro, uni)
    assert "ShuffledHashJoin" not in plan(sorted_kn) and sorted(map(tuple, sorted_kn.collect())) == want


def test_small_tables_are_still_broadcast(micro):
    assert "BroadcastHashJoin" in plan(models.probabilities(micro, 2)[2])


def test_bucketed_tables_are_sorted_files_without_dictionaries(spark, tmp_path):
    rows = [(f"w{i * 7 % 50}", f"v{i * 11 % 40}", i) for i in range(500)] + [(None, "v", 1), ("w", None, 2)]
    df = spark.createDataFrame(rows, "a string, b string, n bigint").repartition(3)
    # More buckets than one task keeps files open for.
    out = workspace.write_bucketed(df.coalesce(1), str(tmp_path / "t"), ["a"], 3 * workspace.OPEN_FILES, ["a", "b"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)
    files = list((tmp_path / "t").glob("*.parquet"))
    buckets = {f.name.split("_")[1].split(".")[0] for f in files}
    assert len(buckets) == len(files) > workspace.OPEN_FILES
    for f in files:
        part = pq.ParquetFile(f)
        found = [(r["a"] or "", r["b"] or "") for r in part.read().to_pylist()]
        assert found == sorted(found)
        column = part.metadata.row_group(0).column(0)
        assert column.compression == "ZSTD" and not any("DICTIONARY" in x for x in column.encodings)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_ngrams_are_added_up_as_texts(spark, monkeypatch):
    plans = {}
    written = counts.materialize_bucketed
    monkeypatch.setattr(counts, "materialize_bucketed", lambda df, name, *args: plans.update({name: plan(df)}) or written(df, name, *args))
    models.train_counts(odd_docs(spark), 3)
    keys = [line.split("keys=[")[1].split("]")[0] for line in plans["grams3"].splitlines() if "Aggregate(keys=" in line]
    assert keys and not any("w1#" in key for key in keys)
