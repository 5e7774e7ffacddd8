"""Model tables: counts -> probabilities -> trimmed top-k continuations."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.functions.text import clean_text, remove_listed_features, tokenize
from wordloom.functions.words import STOP_WORDS, drop_stop_words, trim_predictions
from wordloom.operators.counts import FREQ, as_contexts, count_tables, words_of
from wordloom.operators.joins import context_join
from wordloom.operators.kneser_ney import bigram_kn, bigram_kn_interpolated, trigram_kn
from wordloom.operators.mle import (
    bigram_interpolated,
    bigram_mle,
    in_vocabulary,
    ratio,
    tetragram_interpolated,
    tetragram_mle,
    trigram_interpolated,
    trigram_mle,
    unigram_mle,
)
from wordloom.operators.ranking import index_words, model_table, top_k, top_ngrams
from wordloom.plans.lookup import has_lookup, read_lookup, write_lookup
from wordloom.workspace import TABLE_OPTIONS, deal, materialize, remove, shared_folder, shuffles_dropped, spread, subfolders

Tables = Mapping[int | str, DataFrame]

# Text files' bytes per word of an n-gram in one counting task, so that its n-grams fit in memory; the task's column.
PART_BYTES = 32 * 1024 * 1024
PART = "_part"


def tokenized(
    docs: DataFrame, block_list: DataFrame | None = None, folder: str | None = None
) -> DataFrame:
    """Clean and tokenise ``docs.text``; a small corpus is first spread over the cores."""
    keys = [name for name in docs.columns if name != "text"]
    wide = spread(docs, *[name for name in keys if name == "doc_id"])
    tokens = wide.select(*keys, tokenize(clean_text(F.col("text"))).alias("tokens"))
    return tokens if block_list is None else remove_listed_features(tokens, block_list, folder)


def dealt_tokens(docs: DataFrame, n: int) -> DataFrame:
    """``tokens`` of ``docs`` (``doc_id``, ``text``), dealt out by the column PART so that a task's n-grams fit in memory."""
    dealt = deal(docs.select("doc_id", "text"), PART_BYTES // n, PART)
    return dealt.select(PART, tokenize(clean_text(F.col("text"))).alias("tokens"))


def train_counts(
    docs: DataFrame,
    max_n: int = 4,
    block_list: DataFrame | None = None,
    folder: str | None = None,
) -> dict[int | str, DataFrame]:
    """Frequency tables of orders 1 .. ``max_n`` of a text corpus, written to ``folder``.

    N-grams are many times the text, so from bigrams on a text with ids is dealt out first and its
    n-grams move once, many as one text.
    """
    keys = ["doc_id"] if "doc_id" in docs.columns else []
    texts = docs.select(*keys, "text")
    if max_n < 2 or block_list is not None or not keys:
        return count_tables(tokenized(texts, block_list), max_n, folder, packed=True)
    return count_tables(dealt_tokens(texts, max_n), max_n, folder, PART, packed=True)


def trimmed_counts(
    counts: DataFrame,
    n: int,
    stop_words: Sequence[str] = STOP_WORDS,
    trim_context: bool = False,
    trim_on: str | None = None,
) -> DataFrame:
    """N-grams that may predict: known words, and no stop or noise word as the last one.

    ``trim_context=True`` also drops contexts whose words after the first are stop or noise words,
    as joining the trimmed lower-order table does. ``trim_on`` names another column to trim.
    """
    words = words_of(n)
    kept = in_vocabulary(counts, words)
    trimmed = words[1:-1] if trim_context else []
    for name in [*trimmed, trim_on or words[-1]]:
        kept = trim_predictions(kept, name, stop_words)
    return kept


def trimmed_unigrams(
    unigrams: DataFrame, stop_words: Sequence[str] | DataFrame = STOP_WORDS
) -> DataFrame:
    """Unigrams without stop words: the fallback list of the tetragram predictor."""
    return drop_stop_words(unigrams, "word", stop_words)


def mle_model(
    docs: DataFrame | None = None,
    max_n: int = 3,
    k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS,
    trim_context: bool = False,
    tables: Tables | None = None,
    folder: str | None = None,
) -> dict[str | int, DataFrame]:
    """Maximum-likelihood model: ``unigrams`` and, per order 2 .. max_n, a top-k table.

    The counts are trimmed and ranked before they are joined with their context's count.
    """
    tables = tables or train_counts(docs, max_n, folder=folder)
    model: dict[str | int, DataFrame] = {"unigrams": unigram_mle(tables[1])}
    for n in range(2, max_n + 1):
        model[n] = mle_top(tables, n, k, stop_words, trim_context)
    return model


def mle_top(
    tables: Tables,
    n: int,
    k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS,
    trim_context: bool = False,
    trim_on: str | None = None,
) -> DataFrame:
    """Top-k next words of each (n-1)-word context by maximum likelihood."""
    best = top_ngrams(trimmed_counts(tables[n], n, stop_words, trim_context, trim_on), n, k)
    context = words_of(n)[:-1]
    names = [F.col(a).alias(b) for a, b in zip(words_of(n - 1), context)]
    lower = as_contexts(tables, n - 1).select(*names, FREQ[n - 1])
    return model_table(
        best.join(lower, context).withColumn("prob", ratio(FREQ[n], FREQ[n - 1])), n, "prob"
    )


def probabilities(tables: Tables, max_n: int = 4) -> dict[int, DataFrame]:
    """Full MLE and interpolated probability tables of every order, untrimmed."""
    out = {1: unigram_mle(as_contexts(tables, 1))}
    if max_n >= 2:
        out[2] = bigram_interpolated(bigram_mle(tables[2], out[1]))
    if max_n >= 3:
        out[3] = trigram_interpolated(trigram_mle(tables[3], out[2], counts=tables[2]))
    if max_n >= 4:
        out[4] = tetragram_interpolated(tetragram_mle(tables[4], out[3], counts=tables[3]))
    return out


def interpolated_top(
    tables: Tables,
    n: int,
    k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS,
    trim_context: bool = False,
    trim_on: str | None = None,
) -> DataFrame:
    """Top-k next words of each context with ``prob`` (MLE) and ``smooth_prob`` (interpolated).

    Both scores grow with the frequency inside a context, so the counts are ranked first and only
    the survivors are joined, one join per lower order.
    """
    best = top_ngrams(trimmed_counts(tables[n], n, stop_words, trim_context, trim_on), n, k)
    uni = unigram_mle(as_contexts(tables, 1))
    if n == 2:
        scored = bigram_interpolated(bigram_mle(best, uni, ranked=True)).withColumn(
            "smooth_prob", F.col("smooth_mle")
        )
        return model_table(scored, n, "prob_mle", "smooth_prob")
    bi = bigram_mle(tables[2], uni)
    if n == 3:
        scored = trigram_interpolated(trigram_mle(best, bi, ranked=True))
        return model_table(scored, n, "tri_prob", "smooth_prob")
    tri = trigram_mle(tables[3], bi, counts=tables[2])
    scored = tetragram_interpolated(tetragram_mle(best, tri, ranked=True))
    return model_table(scored, n, "tetra_prob", "smooth_prob")


def interpolated_model(
    docs: DataFrame | None = None,
    max_n: int = 4,
    k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS,
    trim_context: bool = False,
    trim_on: str | None = None,
    tables: Tables | None = None,
    folder: str | None = None,
) -> dict[str | int, DataFrame]:
    """``mle_model`` up to tetragrams whose tables also carry ``smooth_prob``.

    ``trim_on='w1'`` trims tetragrams on their first word instead of the predicted one.
    """
    tables = tables or train_counts(docs, max_n, folder=folder)
    model: dict[str | int, DataFrame] = {"unigrams": unigram_mle(tables[1])}
    for n in range(2, max_n + 1):
        trimmed_on = trim_on if n == 4 else None
        model[n] = interpolated_top(tables, n, k, stop_words, trim_context, trimmed_on)
    return model


def save_model(model: Mapping, folder: str | None = None, name: str | None = None) -> dict:
    """Write every table of a model, so that predictions read the finished tables.

    A model that predicts also gets its ``lookup`` table, bucketed by context, which predictions join
    without moving it. With a ``name`` the model lies under ``folder/name`` and ``load_model`` finds it
    again, from any application; frequency tables of ``train_counts`` can be kept the same way.

    Every save writes a version of its own and then one row to the list of versions, which makes it
    the current one. A reader sees a whole model whenever it looks, and a save that fails changes
    nothing; ``drop_versions`` clears what is no longer read.
    """
    spark = next(iter(model.values())).sparkSession
    if name is None:
        out = {key: materialize(table, f"model_{key}", folder) for key, table in model.items()}
        if has_lookup(out):
            out["lookup"] = write_lookup(out, f"{folder or shared_folder(spark)}/lookup-{uuid.uuid4().hex}")[0]
        return out
    if folder is None:
        raise ValueError("a named model needs a folder")
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{folder}/{name}/version={version}"
    out = {}
    for key, table in model.items():
        if key != "lookup":
            with shuffles_dropped(spark):
                table.write.options(**TABLE_OPTIONS).parquet(f"{path}/{_table_name(key)}")
            out[key] = spark.read.schema(table.schema).parquet(f"{path}/{_table_name(key)}")
    buckets = write_lookup(out, f"{path}/lookup")[1] if has_lookup(out) else 0
    listed = spark.createDataFrame([(version, [_table_name(key) for key in out], buckets)], VERSIONS)
    listed.coalesce(1).write.mode("append").parquet(f"{folder}/{name}/versions")
    return load_model(spark, folder, name)


VERSIONS = "version string, tables array<string>, buckets int"


def _table_name(key: int | str) -> str:
    return f"order={key}" if isinstance(key, int) else f"table={key}"


def _versions(spark: SparkSession, folder: str, name: str) -> list:
    """The finished versions of a named model, the newest first."""
    listed = spark.read.schema(VERSIONS).parquet(f"{folder}/{name}/versions")
    return sorted(listed.collect(), key=lambda row: row["version"], reverse=True)


def load_model(spark: SparkSession, folder: str, name: str) -> dict[int | str, DataFrame]:
    """The tables of the newest version that ``save_model`` finished under a name."""
    row = _versions(spark, folder, name)[0]
    path = f"{folder}/{name}/version={row['version']}"
    out: dict[int | str, DataFrame] = {}
    for table in row["tables"]:
        kind, key = table.split("=", 1)
        out[int(key) if kind == "order" else key] = spark.read.parquet(f"{path}/{table}")
    if row["buckets"]:
        out["lookup"] = read_lookup(spark, f"{path}/lookup", row["buckets"])
    return out


def drop_versions(spark: SparkSession, folder: str, name: str, keep: int = 1) -> int:
    """Remove all versions of a named model but the ``keep`` newest finished ones; how many went.

    Versions that never were finished go too, so no save may be under way.
    """
    kept = {row["version"] for row in _versions(spark, folder, name)[: max(keep, 1)]}
    gone = 0
    for path in subfolders(spark, f"{folder}/{name}"):
        version = path.rsplit("/", 1)[-1].removeprefix("version=")
        if path.rsplit("/", 1)[-1].startswith("version=") and version not in kept:
            remove(spark, path)
            gone += 1
    return gone


def ranked_model(
    df: DataFrame, n: int, k: int, prob: str, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Trim the predicted word of a probability table and keep the top k of each context."""
    words = words_of(n)
    kept = trim_predictions(df, words[-1], stop_words)
    narrow = kept.select(*words, F.col(prob).alias("prob"))
    return model_table(top_k(narrow, words[:-1], k, "prob", words[-1]), n, "prob")


def kn_bigrams(
    tables: Tables, uni: DataFrame, normalizer: str = "tokens", folder: str | None = None
) -> DataFrame:
    return bigram_kn(tables[2], uni, normalizer, tables.get("contexts1"), folder)


def kn_trigrams(
    tables: Tables,
    uni: DataFrame,
    combine: str = "product",
    normalizer: str = "tokens",
    folder: str | None = None,
) -> DataFrame:
    contexts = tables.get("contexts2")
    return trigram_kn(tables[3], tables[2], uni, combine, normalizer, contexts, folder)


def kn_model(
    docs: DataFrame | None = None,
    stop_words: Sequence[str] = STOP_WORDS,
    normalizer: str = "tokens",
    combine: str = "product",
    tables: Tables | None = None,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Kneser-Ney model tables and the MLE and interpolated ones built beside them."""
    tables = tables or train_counts(docs, 3, folder=folder)
    uni = unigram_mle(tables[1])
    bigrams = materialize(
        bigram_kn_interpolated(kn_bigrams(tables, uni, normalizer, folder)), "bigram_kn", folder
    )
    trigrams = kn_trigrams(tables, uni, combine, normalizer, folder)
    smooth = {
        n: interpolated_top(tables, n, 3, stop_words)
        .drop("prob")
        .withColumnRenamed("smooth_prob", "prob")
        for n in (2, 3)
    }
    return {
        "unigrams": uni,
        "bigrams": bigrams,
        "trigrams": trigrams,
        "bigram_mle": mle_top(tables, 2, 5, stop_words),
        "bigram_mle_interpolated": smooth[2],
        "bigram_kn": ranked_model(bigrams, 2, 5, "prob_kn", stop_words),
        "bigram_kn_interpolated": ranked_model(bigrams, 2, 5, "smooth_kn", stop_words),
        "trigram_mle": mle_top(tables, 3, 3, stop_words),
        "trigram_mle_interpolated": smooth[3],
        "trigram_kn": ranked_model(trigrams, 3, 3, "prob_kn", stop_words),
    }


def indexed_tables(
    c1: DataFrame,
    c2: DataFrame,
    c3: DataFrame | None = None,
    c4: DataFrame | None = None,
    stop_words: Sequence[str] | None = None,
    folder: str | None = None,
) -> dict[int, DataFrame]:
    """Id-encoded frequency tables with their MLE probabilities.

    A longer n-gram takes the ids of its first words from the order below, found by its whole
    context, and only its last word from the dictionary: two joins whatever n. With ``stop_words``
    the trigrams and tetragrams that end in one are left out.
    """
    indexed = materialize(index_words(unigram_mle(c1), folder), "dictionary", folder)
    out = {1: indexed}
    counts = {2: c2, 3: c3, 4: c4}
    # Context columns of the order below, as w1.. with ids and the context's count.
    lower = indexed.select(
        F.col("word").alias("w1"), F.col("word_int").alias("w1_int"), "uni_freq", "uni_prob"
    )
    contexts = lower.select("w1", "uni_freq")
    for n in range(2, 5):
        if counts[n] is None:
            break
        words = words_of(n)
        full = _indexed(counts[n], n, lower, contexts, indexed)
        lower = full.drop(FREQ[n - 1], "uni_prob")
        contexts = counts[n]
        kept = full
        if stop_words is not None and n > 2:
            kept = drop_stop_words(full, words[-1], stop_words)
        out[n] = kept.select(*[f"{w}_int" for w in words], *_measures(n))
    return out


def _indexed(
    counts: DataFrame, n: int, lower: DataFrame, contexts: DataFrame, dictionary: DataFrame
) -> DataFrame:
    words = words_of(n)
    context, last = words[:-1], words[-1]
    known = in_vocabulary(counts, words)
    joined = context_join(known, lower, context, [last], contexts, FREQ[n - 1])
    ids = dictionary.select(F.col("word").alias(last), F.col("word_int").alias(f"{last}_int"))
    freqs = dictionary.select(F.col("word").alias(last), F.col("uni_freq"))
    return context_join(joined, ids, [last], context, freqs, "uni_freq")


def decode_words(encoded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Replace the id columns ``w<i>_int`` of a table by their words."""
    out = encoded
    for name in [c for c in encoded.columns if c.endswith("_int")]:
        word = name.removesuffix("_int")
        ids = dictionary.select(F.col("word_int").alias(name), F.col("word").alias(word))
        freqs = dictionary.select(F.col("word_int").alias(name), "uni_freq")
        others = [c for c in encoded.columns if c.endswith("_int") and c != name]
        salt_by = [c.removesuffix("_int") if c not in out.columns else c for c in others] or [name]
        out = context_join(out, ids, [name], salt_by, freqs, "uni_freq").drop(name)
    return out


def _measures(n: int) -> list[Column]:
    prob = ratio(FREQ[n], FREQ[n - 1])
    if n == 2:
        return [F.col("bi_freq"), prob.alias("bi_prob"), F.col("uni_freq"), F.col("uni_prob")]
    if n == 3:
        return [F.col("tri_freq"), F.col("bi_freq"), prob.alias("tri_prob")]
    return [F.col("tetra_freq"), prob.alias("tetra_prob")]
