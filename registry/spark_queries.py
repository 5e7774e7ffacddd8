"""One Spark query per operator; each reads whole tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.functions import text, words
from wordloom.operators import counts, kneser_ney, mle, ranking, sampling
from wordloom.plans import models, predict
from wordloom.sources import files
from wordloom.sources.files import read_documents
from wordloom.workspace import shared_folder, spread

Query = Callable[[SparkSession, str], DataFrame]

N_TEST = 2
TURNS = 1 << 20

# Frequency tables of a data folder up to some order, counted once per application and written to its work folder.
_trained: dict[tuple[str, str], dict[int, dict[int, DataFrame]]] = {}
_models: dict[tuple[str, str, str], dict] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def trained(spark: SparkSession, sf_dir: str, n: int) -> dict[int, DataFrame]:
    """Frequency tables of orders 1 .. ``n`` at least: no longer n-grams are counted than a query reads."""
    made = _trained.setdefault((spark.sparkContext.applicationId, sf_dir), {})
    held = [order for order in made if order >= n]
    if not held:
        made[n] = models.train_counts(documents(spark, sf_dir), n)
    return made[min(held, default=n)]


def built_model(spark: SparkSession, sf_dir: str, kind: str) -> dict:
    """The top-k tables up to tetragrams: those that were written before, else not written yet."""
    build = models.mle_model if kind == "mle" else models.interpolated_model
    written = _models.get((spark.sparkContext.applicationId, sf_dir, kind))
    return written or build(tables=trained(spark, sf_dir, 4), max_n=4)


def trained_model(spark: SparkSession, sf_dir: str, kind: str) -> dict:
    """The written top-k tables up to tetragrams, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _models:
        _models[key] = models.save_model(built_model(spark, sf_dir, kind))
    return _models[key]


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select((F.col("conv_id") * TURNS + F.col("turn")).alias("query_id"), "text")


def spoken(df: DataFrame) -> DataFrame:
    """Token arrays as text, for a flat result."""
    return df.select(
        "doc_id",
        text.token_count(F.col("tokens")).cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("words"),
    )


# --- corpus ---------------------------------------------------------------------------------


def digested(sampled: DataFrame) -> DataFrame:
    """Sampled records with a checksum in place of their text."""
    return sampled.withColumn("text_md5", F.md5(F.col("text").cast("binary"))).drop("text")


def sample_train_test(spark, sf_dir):
    return digested(sampling.sample_train_test(documents(spark, sf_dir), n_test=N_TEST))


def clean_text(spark, sf_dir):
    docs = spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


def tokenize(spark, sf_dir):
    return spoken(models.tokenized(documents(spark, sf_dir)))


def remove_features(spark, sf_dir):
    """The words of the benchmark passages serve as the block list."""
    passages = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    listed = passages.select(F.explode_outer(text.tokenize(text.clean_text(F.col("text")))).alias("word"))
    return spoken(models.tokenized(documents(spark, sf_dir), listed.distinct()))


def spoken_words(spark, sf_dir) -> DataFrame:
    """All words of all turns, as a long block list."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = F.explode_outer(text.tokenize(text.clean_text(F.col("text")))).alias("word")
    return turns.select(said).distinct()


def remove_features_long(spark, sf_dir):
    return spoken(models.tokenized(documents(spark, sf_dir), spoken_words(spark, sf_dir)))


def blocked_bigram_counts(spark, sf_dir):
    """Bigrams counted after the block list's words are gone, so that they bridge the gaps."""
    listed = spoken_words(spark, sf_dir)
    return counts.ngram_counts(models.tokenized(documents(spark, sf_dir), listed), 2)


def sample_records(spark, sf_dir):
    return digested(sampling.sample_records(documents(spark, sf_dir), frac=0.1, seed=2345))


def tokenize_query(spark, sf_dir):
    tokens = text.tokenize_query(F.col("text"))
    last = text.last_tokens(F.col("tokens"), 3)
    return phrases(spark, sf_dir).select("query_id", tokens.alias("tokens")).select(
        "query_id",
        text.token_count(F.col("tokens")).cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("words"),
        F.array_join(last, " ").alias("last_words"),
    )


def ngram_strings(spark, sf_dir):
    """Trigrams as text, split and pasted again to their prefix and suffix bigrams."""
    tokens = models.tokenized(documents(spark, sf_dir))
    grams = tokens.select(F.explode_outer(text.ngrams(F.col("tokens"), 3)).alias("words"))
    joined = grams.groupBy(F.array_join("words", " ").alias("gram")).agg(F.count("words").alias("n"))
    split = joined.where("n > 0").select("gram", "n", *text.split_ngram(F.col("gram"), 3))
    return split.select(
        "gram", "n", text.prefix_ngram(3).alias("prefix"), text.suffix_ngram(3).alias("suffix")
    )


def counted(n: int) -> Query:
    if n < 3:
        return lambda spark, sf_dir: counts.ngram_counts(models.tokenized(documents(spark, sf_dir)), n)
    return lambda spark, sf_dir: counts.ngram_counts(
        models.dealt_tokens(documents(spark, sf_dir), n), n, models.PART, packed=True
    )


# --- sources and sinks: derived tables are written and read back ---------------------------------


def work_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_lines(spark, sf_dir) -> str:
    """The physical lines of all documents as text files."""
    lines = documents(spark, sf_dir).select(F.explode(F.split("text", r"\r\n|\r|\n")).alias("text"))
    path = work_path(spark, "written_lines")
    files.write_lines(lines, path)
    return path


def read_lines(spark, sf_dir):
    lines = files.read_lines(spark, written_lines(spark, sf_dir))
    return lines.groupBy(F.col("text").alias("line")).agg(F.count("*").alias("n"))


def read_corpus(spark, sf_dir):
    """Every line with the number of its records and of their ids."""
    corpus = files.read_corpus(spark, f"{written_lines(spark, sf_dir)}/*.txt")
    ids = corpus.groupBy("doc_id", F.col("text").alias("line")).agg(F.count("*").alias("n"))
    return ids.groupBy("line").agg(F.sum("n").alias("n"), F.count("*").alias("n_ids"))


def read_ngrams(spark, sf_dir):
    """The bigram counts written as CSV and as Parquet, both read with a given schema."""
    parts = []
    for fmt in ("csv", "parquet"):
        path = work_path(spark, f"bigrams_{fmt}")
        files.write_table(trained(spark, sf_dir, 2)[2], path, fmt)
        table = files.read_ngrams(spark, path, "w1 string, w2 string, bi_freq bigint", fmt=fmt)
        parts.append(table.withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


def read_word_list(spark, sf_dir):
    """The words of all turns as the second column of a CSV file behind a preamble, and read from it."""
    said = F.concat(F.lit('1,"'), "word", F.lit('"')).alias("text")
    head = ("a list", "of words", "", "that are said", "id,word")
    rows = spoken_words(spark, sf_dir).select(F.lit(len(head)).alias("at"), said)
    rows = rows.unionByName(spark.createDataFrame(list(enumerate(head)), "at int, text string"))
    path = work_path(spark, "word_list")
    # A word list is one file: its first lines are told by their place.
    files.write_lines(rows.repartition(1).sortWithinPartitions("at", "text"), path)
    listed = files.read_word_list(spark, path)
    return listed.groupBy("word").agg(F.count("*").alias("n"))


def load_model(spark, sf_dir):
    """The bigram table of a model saved under a name, which is the only time that its tables are written."""
    folder = work_path(spark, "models")
    models.save_model(built_model(spark, sf_dir, "mle"), folder, "mle")
    return models.load_model(spark, folder, "mle")[2]


def context_key(spark, sf_dir):
    """Trigrams grouped by the one column that stands for their context."""
    key = text.context_key("w1", "w2").alias("context")
    grouped = trained(spark, sf_dir, 3)[3].groupBy(key).agg(F.count("*").alias("n_types"), F.sum("tri_freq").alias("freq"))
    return grouped.select("context.w1", "context.w2", "n_types", "freq")


# --- probabilities --------------------------------------------------------------------------


def probability(n: int, *cols: str) -> Query:
    def query(spark, sf_dir):
        table = models.probabilities(trained(spark, sf_dir, n), n)[n]
        return table.select(*counts.words_of(n), *cols)

    return query


def index_words(spark, sf_dir):
    return ranking.index_words(trained(spark, sf_dir, 1)[1])


def target_interpolated(n: int) -> Query:
    """Interpolation with the predicted word's lower orders instead of the context's."""

    def query(spark, sf_dir):
        full = models.probabilities(trained(spark, sf_dir, n), n)
        lower = {"lower_order": "target", "uni": full[1]}
        if n == 2:
            out = mle.bigram_interpolated(full[2].drop("smooth_mle"), **lower)
            return out.select("w1", "w2", F.col("smooth_mle").alias("smooth_prob"))
        table = full[n].drop("smooth_prob")
        if n == 3:
            out = mle.trigram_interpolated(table, bi=full[2], **lower)
        else:
            out = mle.tetragram_interpolated(table, tri=full[3], bi=full[2], **lower)
        return out.select(*counts.words_of(n), "smooth_prob")

    return query


def scaled_score(spark, sf_dir):
    tables = trained(spark, sf_dir, 3)
    parts = []
    for n, scale in ((2, mle.BIGRAM_SCALE), (3, mle.TRIGRAM_SCALE)):
        scored = mle.scaled_score(models.mle_top(tables, n), scale)
        context = text.join_words(*counts.words_of(n)[:-1]).alias("context")
        parts.append(scored.select(context, "word", "prob", "score"))
    return parts[0].unionByName(parts[1])


def trim_stop_words(spark, sf_dir):
    return models.trimmed_counts(trained(spark, sf_dir, 2)[2], 2)


def noise_words(spark, sf_dir):
    return words.noise_words(trained(spark, sf_dir, 1)[1])


def trimmed_unigrams(spark, sf_dir):
    return models.trimmed_unigrams(mle.unigram_mle(trained(spark, sf_dir, 1)[1]))


def joined(spark, sf_dir, n: int) -> DataFrame:
    """N-grams of dictionary words, on which types and discounts are counted."""
    return mle.in_vocabulary(trained(spark, sf_dir, n)[n], counts.words_of(n))


def continuation_counts(spark, sf_dir):
    return counts.continuation_counts(joined(spark, sf_dir, 2))


def context_types(spark, sf_dir):
    return counts.context_types(joined(spark, sf_dir, 3))


def per_order(measure) -> Query:
    def query(spark, sf_dir):
        parts = [
            measure(joined(spark, sf_dir, n), counts.FREQ[n]).withColumn("n", F.lit(n).cast("bigint"))
            for n in (2, 3)
        ]
        return parts[0].unionByName(parts[1])

    return query


def bigram_kn(spark, sf_dir):
    tables = trained(spark, sf_dir, 2)
    return models.kn_bigrams(tables, mle.unigram_mle(tables[1]))


def bigram_kn_interpolated(spark, sf_dir):
    kn = kneser_ney.bigram_kn_interpolated(bigram_kn(spark, sf_dir))
    return kn.select("w1", "w2", "prob_kn", "smooth_kn")


def trigram_kn(spark, sf_dir):
    tables = trained(spark, sf_dir, 3)
    return models.kn_trigrams(tables, mle.unigram_mle(tables[1]))


def bigram_kn_types(spark, sf_dir):
    tables = trained(spark, sf_dir, 2)
    kn = models.kn_bigrams(tables, mle.unigram_mle(tables[1]), normalizer="types")
    return kn.select("w1", "w2", "prob_kn")


def trigram_kn_interpolated(spark, sf_dir):
    tables = trained(spark, sf_dir, 3)
    kn = models.kn_trigrams(tables, mle.unigram_mle(tables[1]), combine="interpolated")
    return kn.select("w1", "w2", "w3", "prob_kn")


# --- model tables ---------------------------------------------------------------------------


def mle_top(n: int, k: int = 5, **trim) -> Query:
    return lambda spark, sf_dir: models.mle_top(trained(spark, sf_dir, n), n, k, **trim)


def top_interpolated(n: int, k: int) -> Query:
    def query(spark, sf_dir):
        top = models.interpolated_top(trained(spark, sf_dir, n), n, k)
        return top.drop("prob").withColumnRenamed("smooth_prob", "prob")

    return query


def top_kn(n: int, k: int, prob: str) -> Query:
    def query(spark, sf_dir):
        scored = trigram_kn(spark, sf_dir) if n == 3 else bigram_kn(spark, sf_dir)
        if prob == "smooth_kn":
            scored = kneser_ney.bigram_kn_interpolated(scored)
        return models.ranked_model(scored, n, k, prob)

    return query


def indexed(n: int) -> Query:
    def query(spark, sf_dir):
        tables = trained(spark, sf_dir, n)
        wanted = {f"c{i}": tables[i] for i in range(2, n + 1)}
        return models.indexed_tables(tables[1], **wanted)[n]

    return query


def decode_words(spark, sf_dir):
    tables = trained(spark, sf_dir, 3)
    out = models.indexed_tables(tables[1], tables[2], tables[3])
    return models.decode_words(out[3], out[1])


# --- prediction -----------------------------------------------------------------------------


def predict_backoff(max_n: int, oov: str = "top3") -> Query:
    def query(spark, sf_dir):
        model = trained_model(spark, sf_dir, "mle")
        return predict.predict_backoff(phrases(spark, sf_dir), model, max_n, oov)

    return query


def predict_interpolated(spark, sf_dir):
    model = trained_model(spark, sf_dir, "interpolated")
    return predict.predict_interpolated(phrases(spark, sf_dir), model)


QUERIES: dict[str, Query] = {
    "sample_train_test": sample_train_test,
    "sample_records": sample_records,
    "clean_text": clean_text,
    "tokenize": tokenize,
    "tokenize_query": tokenize_query,
    "remove_features": remove_features,
    "remove_features_long": remove_features_long,
    "blocked_bigram_counts": blocked_bigram_counts,
    "ngram_strings": ngram_strings,
    "unigram_counts": counted(1),
    "bigram_counts": counted(2),
    "trigram_counts": counted(3),
    "tetragram_counts": counted(4),
    "unigram_mle": probability(1, "uni_freq", "uni_prob"),
    "index_words": index_words,
    "bigram_mle": probability(2, "bi_freq", "uni_freq", "uni_prob", "prob_mle"),
    "trigram_mle": probability(3, "tri_freq", "bi_freq", "tri_prob"),
    "tetragram_mle": probability(4, "tetra_freq", "tri_freq", "tetra_prob"),
    "bigram_interpolated": probability(2, "prob_mle", "uni_prob", "smooth_mle"),
    "trigram_interpolated": probability(3, "tri_prob", "bi_prob", "uni_prob", "smooth_prob"),
    "tetragram_interpolated": probability(
        4, "tetra_prob", "tri_prob", "bi_prob", "uni_prob", "smooth_prob"
    ),
    "bigram_interpolated_target": target_interpolated(2),
    "trigram_interpolated_target": target_interpolated(3),
    "tetragram_interpolated_target": target_interpolated(4),
    "scaled_score": scaled_score,
    "trim_stop_words": trim_stop_words,
    "noise_words": noise_words,
    "trimmed_unigrams": trimmed_unigrams,
    "continuation_counts": continuation_counts,
    "context_types": context_types,
    "count_of_counts": per_order(counts.count_of_counts),
    "discounts": per_order(counts.discount),
    "bigram_kn": bigram_kn,
    "bigram_kn_interpolated": bigram_kn_interpolated,
    "bigram_kn_types": bigram_kn_types,
    "trigram_kn": trigram_kn,
    "trigram_kn_interpolated": trigram_kn_interpolated,
    "top5_bigram_mle": mle_top(2),
    "top5_trigram_mle": mle_top(3),
    "top5_tetragram_mle": mle_top(4),
    "top3_bigram_interpolated": top_interpolated(2, 3),
    "top3_trigram_interpolated": top_interpolated(3, 3),
    "top5_bigram_kn": top_kn(2, 5, "prob_kn"),
    "top5_bigram_kn_interpolated": top_kn(2, 5, "smooth_kn"),
    "top3_trigram_mle": mle_top(3, 3),
    "top3_trigram_kn": top_kn(3, 3, "prob_kn"),
    "indexed_bigrams": indexed(2),
    "indexed_trigrams": indexed(3),
    "indexed_tetragrams": indexed(4),
    "decode_words": decode_words,
    "trim_context_trigram_mle": mle_top(3, trim_context=True),
    "trim_first_tetragram_mle": mle_top(4, trim_on="w1"),
    "read_lines": read_lines,
    "read_corpus": read_corpus,
    "read_ngrams": read_ngrams,
    "read_word_list": read_word_list,
    "load_model": load_model,
    "context_key": context_key,
    "predict_backoff_trigram": predict_backoff(3),
    "predict_backoff_tetragram": predict_backoff(4),
    "predict_backoff_nth": predict_backoff(4, "nth"),
    "predict_interpolated": predict_interpolated,
}
