"""Word ids and top-k tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from wordloom.operators.counts import FREQ, words_of
from wordloom.workspace import materialize

# monotonically_increasing_id() = partition number << 33 | row number within the partition.
ROW_BITS = 33


def index_words(unigrams: DataFrame, folder: str | None = None) -> DataFrame:
    """Add ``word_int``: 1..V by descending frequency, ties by word.

    A range shuffle on (frequency, word) balances itself whatever the distribution, since words
    are unique. The row ids of the sorted partitions are written down, so the sampled range
    bounds are used once; offsets are then the running sum over one row per partition.
    """
    order = [F.desc("uni_freq"), F.asc("word")]
    parts = int(unigrams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = unigrams.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = materialize(
        ranged.withColumn("row_id", F.monotonically_increasing_id()), "word_order", folder
    )
    part = F.shiftright("row_id", ROW_BITS).alias("part")
    sizes = numbered.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = F.col("row_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # The hint is on one row per shuffle partition, a size fixed by configuration.
    return (
        numbered.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn("word_int", within + F.col("offset") + 1)
        .select(*unigrams.columns, "word_int")
    )


def top_k(df: DataFrame, context: Sequence[str], k: int, by: str, word: str = "word") -> DataFrame:
    """The k best rows of each context by descending ``by``, ties by word, with their ``rank``.

    The rank filter becomes a group limit on both sides of the shuffle, so a hot context sends at
    most k rows per task.
    """
    best_first = Window.partitionBy(*context).orderBy(F.desc(by), F.asc(word))
    ranked = df.withColumn("rank", F.row_number().over(best_first))
    return ranked.where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("bigint"))


def top_ngrams(counts: DataFrame, n: int, k: int) -> DataFrame:
    """The k most frequent n-grams of each context, with their ``rank``.

    Within a context, maximum likelihood and interpolation with the context's lower orders both
    grow with the frequency, so this ranking is theirs. Ranking the counts first keeps only k rows
    of a context for the joins that turn counts into probabilities.
    """
    words = words_of(n)
    return top_k(counts, words[:-1], k, FREQ[n], words[-1])


def model_table(df: DataFrame, n: int, prob: str, *more: str) -> DataFrame:
    """Context words, predicted ``word``, ``prob``, ``rank`` and any further columns."""
    words = words_of(n)
    return df.select(
        *words[:-1], F.col(words[-1]).alias("word"), F.col(prob).alias("prob"), "rank", *more
    )


def head(df: DataFrame, k: int, by: str, word: str = "word") -> DataFrame:
    """The k best rows of a whole table; Spark plans it as a take-ordered, not a sort."""
    return df.orderBy(F.desc(by), F.asc(word)).limit(k)
