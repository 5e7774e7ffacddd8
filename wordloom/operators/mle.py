"""Maximum-likelihood and interpolated probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.functions.text import has_digit_led_word
from wordloom.operators.counts import FREQ, total, words_of
from wordloom.operators.joins import context_join
from wordloom.workspace import estimated_bytes, materialize_bucketed, shuffle_partitions

# Interpolation weights, highest order first.
BIGRAM_WEIGHTS = (0.75, 0.25)
TRIGRAM_WEIGHTS = (0.58, 0.28, 0.14)
TETRAGRAM_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
# Back-off scales of the two lower orders.
BIGRAM_SCALE = 0.2
TRIGRAM_SCALE = 0.3

# Memory bytes of the longer n-grams that meet a table of targets, per byte of the files it is made from.
TARGET_EXPANSION = 8


def ratio(count: str, context_count: str) -> Column:
    return F.col(count).cast("double") / F.col(context_count).cast("double")


def weighted(weights: Sequence[float], *probs: Column) -> Column:
    """Weighted sum, added from left to right."""
    out = F.lit(float(weights[0])) * probs[0]
    for weight, prob in zip(weights[1:], probs[1:]):
        out = out + F.lit(float(weight)) * prob
    return out


def in_vocabulary(
    df: DataFrame, words: Sequence[str], vocabulary: DataFrame | None = None
) -> DataFrame:
    """Keep n-grams whose words are all in the dictionary.

    The dictionary of a corpus is every word of it that does not start with a digit, so for
    n-grams of the same corpus this is a narrow predicate. Pass ``vocabulary(word)`` to restrict
    to some other dictionary; each word is then looked up by a semi join.
    """
    # The null checks add nothing here. Spelled out, they make the filters of all branches that
    # read the same table equal, so that Spark can reuse one exchange for several of them.
    for name in words:
        df = df.where(F.col(name).isNotNull())
    df = df.where(~has_digit_led_word(*words))
    if vocabulary is not None:
        for name in words:
            df = df.join(vocabulary.select(F.col("word").alias(name)), name, "left_semi")
    return df


def unigram_mle(c1: DataFrame) -> DataFrame:
    """Add ``uni_prob``: the word's share of all tokens of the vocabulary."""
    share = F.col("uni_freq").cast("double") / total(c1, "uni_freq").cast("double")
    return c1.withColumn("uni_prob", share)


def bigram_mle(
    c2: DataFrame, uni: DataFrame, vocabulary: DataFrame | None = None, ranked: bool = False
) -> DataFrame:
    """P(w2 | w1), with the first word's frequency and probability alongside.

    ``ranked`` says that the n-grams were already cut to a few per context, here and in the
    longer orders: the join then needs no care for hot contexts.
    """
    first = uni.select(F.col("word").alias("w1"), "uni_freq", "uni_prob")
    known = in_vocabulary(c2, ["w1", "w2"], vocabulary)
    joined = context_join(known, first, ["w1"], ["w2"], first, "uni_freq", not ranked)
    return joined.withColumn("prob_mle", ratio("bi_freq", "uni_freq"))


def trigram_mle(
    c3: DataFrame,
    bi: DataFrame,
    vocabulary: DataFrame | None = None,
    counts: DataFrame | None = None,
    ranked: bool = False,
) -> DataFrame:
    """P(w3 | w1 w2). ``bi`` may be plain bigram counts or the output of ``bigram_mle``; in the
    latter case ``counts`` may name the plain counts, which are cheaper to read again."""
    context = ["w1", "w2"]
    renamed = {"prob_mle": "bi_prob", "uni_prob": "uni_prob"}
    carried = [F.col(c).alias(a) for c, a in renamed.items() if c in bi.columns]
    lower = bi.select(*context, "bi_freq", *carried)
    known = in_vocabulary(c3, [*context, "w3"], vocabulary)
    counts = bi if counts is None else counts
    joined = context_join(known, lower, context, ["w3"], counts, "bi_freq", not ranked)
    return joined.withColumn("tri_prob", ratio("tri_freq", "bi_freq"))


def tetragram_mle(
    c4: DataFrame,
    tri: DataFrame,
    vocabulary: DataFrame | None = None,
    counts: DataFrame | None = None,
    ranked: bool = False,
) -> DataFrame:
    """P(w4 | w1 w2 w3). ``tri`` may be plain trigram counts or the output of ``trigram_mle``."""
    context = ["w1", "w2", "w3"]
    carried = [c for c in ("tri_prob", "bi_prob", "uni_prob") if c in tri.columns]
    lower = tri.select(*context, "tri_freq", *carried)
    known = in_vocabulary(c4, [*context, "w4"], vocabulary)
    counts = tri if counts is None else counts
    joined = context_join(known, lower, context, ["w4"], counts, "tri_freq", not ranked)
    return joined.withColumn("tetra_prob", ratio("tetra_freq", "tri_freq"))


def _join_target(grams: DataFrame, targets: DataFrame, n: int, *probs: str) -> DataFrame:
    """Attach ``probs`` of ``targets``, one row per n-gram, to ``grams`` that end in the n-gram."""
    last = [w for w in ("w1", "w2", "w3", "w4", "word") if w in grams.columns][-n:]
    names = [F.col(w).alias(key) for w, key in zip(words_of(n), last)]
    counts = targets.select(*names, FREQ[n])
    others = [w for w in grams.columns if w in ("w1", "w2", "w3", "w4") and w not in last]
    return context_join(grams, targets.select(*names, *probs), last, others, counts, FREQ[n])


def _targets(tables: Sequence[DataFrame], folder: str | None = None) -> DataFrame:
    """The last of ``tables``, of orders 1, 2 .., with the probabilities of its n-grams' ends as ``target_..``.

    What a longer n-gram takes from the predicted word's lower orders depends on its last words only. So each
    order is joined with the one below it, and the longest n-grams, which are most, move once. Trigrams are
    written in buckets, so that their own shuffles are gone before tetragrams move.
    """
    out = tables[0].select("word", "uni_freq", F.col("uni_prob").alias("target_uni"))
    probs = ["target_uni"]
    for n, own, name in ((2, "prob_mle", "target_bi"), (3, "tri_prob", "target_tri"))[: len(tables) - 1]:
        grams = tables[n - 1].select(*words_of(n), FREQ[n], F.col(own).alias(name))
        joined = _join_target(grams, out, n - 1, *probs)
        probs = [name, *probs]
        out = joined.select(*words_of(n), FREQ[n], *probs)
    if len(tables) < 3:
        return out
    spark = out.sparkSession
    with shuffle_partitions(spark, TARGET_EXPANSION * estimated_bytes(out)):
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = words_of(len(tables))
    return materialize_bucketed(out.repartition(buckets, *keys), "targets", keys, buckets, folder)


def _check(lower_order: str, *tables: DataFrame | None) -> None:
    if lower_order not in ("context", "target"):
        raise ValueError("lower_order is 'context' or 'target'")
    if lower_order == "target" and any(table is None for table in tables):
        raise ValueError("lower_order='target' needs the lower-order tables")


def bigram_interpolated(
    bi: DataFrame,
    weights: Sequence[float] = BIGRAM_WEIGHTS,
    lower_order: str = "context",
    uni: DataFrame | None = None,
) -> DataFrame:
    """Add ``smooth_mle``. By default the unigram term is the context word's own probability;
    ``lower_order='target'`` takes the predicted word's, as textbooks do."""
    _check(lower_order, uni)
    if lower_order == "context":
        return bi.withColumn("smooth_mle", weighted(weights, F.col("prob_mle"), F.col("uni_prob")))
    joined = _join_target(bi, _targets([uni]), 1, "target_uni")
    smooth = weighted(weights, F.col("prob_mle"), F.col("target_uni"))
    return joined.withColumn("smooth_mle", smooth).select(*bi.columns, "smooth_mle")


def trigram_interpolated(
    tri: DataFrame,
    weights: Sequence[float] = TRIGRAM_WEIGHTS,
    lower_order: str = "context",
    bi: DataFrame | None = None,
    uni: DataFrame | None = None,
) -> DataFrame:
    """Add ``smooth_prob`` from the trigram, bigram and unigram probabilities."""
    _check(lower_order, bi, uni)
    probs = ["tri_prob", "bi_prob", "uni_prob"]
    joined = tri
    if lower_order == "target":
        probs = ["tri_prob", "target_bi", "target_uni"]
        joined = _join_target(tri, _targets([uni, bi]), 2, *probs[1:])
    smooth = weighted(weights, *[F.col(p) for p in probs])
    return joined.withColumn("smooth_prob", smooth).select(*tri.columns, "smooth_prob")


def tetragram_interpolated(
    tetra: DataFrame,
    weights: Sequence[float] = TETRAGRAM_WEIGHTS,
    lower_order: str = "context",
    tri: DataFrame | None = None,
    bi: DataFrame | None = None,
    uni: DataFrame | None = None,
) -> DataFrame:
    """Add ``smooth_prob`` from the probabilities of all four orders."""
    _check(lower_order, tri, bi, uni)
    probs = ["tetra_prob", "tri_prob", "bi_prob", "uni_prob"]
    joined = tetra
    if lower_order == "target":
        probs = ["tetra_prob", "target_tri", "target_bi", "target_uni"]
        joined = _join_target(tetra, _targets([uni, bi, tri]), 3, *probs[1:])
    smooth = weighted(weights, *[F.col(p) for p in probs])
    return joined.withColumn("smooth_prob", smooth).select(*tetra.columns, "smooth_prob")


def scaled_score(df: DataFrame, scale: float, prob: str = "prob") -> DataFrame:
    """Add ``score``: the probability times a back-off scale."""
    return df.withColumn("score", F.col(prob) * F.lit(float(scale)))
