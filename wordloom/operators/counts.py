"""N-gram frequency tables and the counts taken on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.functions.words import is_digit_led
from wordloom.workspace import estimated_bytes, materialize, materialize_bucketed, shuffle_partitions

FREQ = {1: "uni_freq", 2: "bi_freq", 3: "tri_freq", 4: "tetra_freq"}

# Stands between the words of an n-gram or a key kept as one text. Cleaning and tokenising turn it into
# white space, so no word has it.
SEPARATOR = "\x1f"
# Stands between n-grams that travel as one text; no word has it either.
GRAM_SEPARATOR = "\x1e"
BUCKET = "_bucket_of_gram"
# Partitions per bucket where n-grams move by BUCKET, so that few buckets meet in one task.
PARTITIONS_PER_BUCKET = 4
# Tasks over which the n-grams of one first word are dealt where they move by it.
FIRST_WORD_SALTS = 16

# Memory bytes per byte of corpus estimate: a row of four words per token, held by two aggregates and a sort.
SHUFFLE_EXPANSION = 36


def words_of(n: int) -> list[str]:
    """Column names of an n-gram: ``word`` for unigrams, else ``w1`` .. ``wn``."""
    return ["word"] if n == 1 else [f"w{i}" for i in range(1, n + 1)]


def _slots(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


def _joined(n: int) -> Column:
    """An n-gram as one text; nulls, which only stand at its end, are left out."""
    return F.concat_ws(SEPARATOR, *_slots(n)).alias("gram")


def _words(n: int) -> list[Column]:
    """The first ``n`` words of ``gram``, null past its end."""
    return [F.get(F.split(F.col("gram"), SEPARATOR), k).alias(slot) for k, slot in enumerate(_slots(n))]


def _place(words: list[Column], buckets: int) -> Column:
    """The number that a table with so many buckets of these words gives them."""
    return F.pmod(F.hash(*words), F.lit(buckets)).alias(BUCKET)


def _bundled(counted: DataFrame, n: int, part: str, buckets: int) -> DataFrame:
    """Counts of packed n-grams inside parts, moved to the buckets of their contexts and added up there.

    What one part sends to one bucket travels as one sorted text per frequency, so it costs its letters
    and not a row per n-gram. BUCKET is the number that a bucketed table gives a context; ``counted`` may have it.
    They are added up as texts too, and become words once they are.
    """
    place = F.col(BUCKET) if BUCKET in counted.columns else _place(_words(n - 1), buckets)
    grams = F.array_join(F.sort_array(F.collect_list("gram")), GRAM_SEPARATOR).alias("grams")
    sent = counted.select(part, place, "gram", "freq").groupBy(part, BUCKET, "freq").agg(grams)
    there = sent.select(BUCKET, "freq", "grams").repartition(PARTITIONS_PER_BUCKET * buckets, BUCKET)
    rows = there.select(BUCKET, "freq", F.explode(F.split("grams", GRAM_SEPARATOR)).alias("gram"))
    added = rows.groupBy(BUCKET, "gram").agg(F.sum("freq").alias("freq"))
    return added.select(*_words(n), "freq")


def _bundled_by_first(counted: DataFrame, n: int, part: str, buckets: int) -> DataFrame:
    """Counts of n-grams inside parts, moved by their first word and added up there.

    The other words of what a part has under a first word travel as one sorted text per frequency. The
    n-grams of a first word are dealt to FIRST_WORD_SALTS tasks by a hash of these other words.
    """
    others = _slots(n)[1:]
    salt = F.pmod(F.hash(*others), F.lit(FIRST_WORD_SALTS)).alias("_salt")
    rest = F.concat_ws(SEPARATOR, *others).alias("rest")
    texts = F.array_join(F.sort_array(F.collect_list("rest")), GRAM_SEPARATOR).alias("texts")
    sent = counted.select(part, "w1", salt, rest, FREQ[n]).groupBy(part, "w1", "_salt", FREQ[n]).agg(texts)
    there = sent.select("w1", "_salt", FREQ[n], "texts").repartition(buckets, "w1", "_salt")
    rows = there.select("w1", "_salt", FREQ[n], F.explode(F.split("texts", GRAM_SEPARATOR)).alias("rest"))
    added = rows.groupBy("w1", "_salt", "rest").agg(F.sum(FREQ[n]).alias(FREQ[n]))
    words = [F.get(F.split("rest", SEPARATOR), k).alias(slot) for k, slot in enumerate(others)]
    return added.select("w1", *words, FREQ[n])


def ngram_positions(docs: DataFrame, n: int, *more: str) -> DataFrame:
    """One row per token: the token and the n-1 that follow it, null past the end of the record, and ``more`` columns.

    Words are picked from the array by index, so no array of n-grams is ever built. Rows with a
    digit-led first word are dropped here, before anything is shuffled. The outer form of the
    explode keeps Catalyst from inferring a ``size(tokens) > 0`` filter below it, which would run
    the whole cleaning chain a second time; the null row of an empty record fails the filter.
    """
    tokens = docs.select(*more, "tokens", F.posexplode_outer("tokens").alias("pos", "w1"))
    following = [F.get("tokens", F.col("pos") + k).alias(f"w{k + 1}") for k in range(1, n)]
    return tokens.where(~is_digit_led(F.col("w1"))).select(*more, "w1", *following)


def ngram_counts(docs: DataFrame, n: int, part: str | None = None, packed: bool = False) -> DataFrame:
    """Frequency table of the n-grams of ``docs.tokens``: partial counts, one shuffle.

    ``part`` is a column by which ``docs`` is dealt out (``workspace.deal``): the partial counts are then
    those of a part, and the shuffle has partitions after the size of the corpus. With ``packed`` the n-grams
    that a part has under a first word move as one text per frequency; it is for tokens without SEPARATOR.
    """
    slots, more = _slots(n), [part] if part else []
    # Tokens are never empty. A plain null check would again be inferred for the token array
    # itself, below the explode, at the price of a second run of the cleaning chain.
    grams = ngram_positions(docs, n, *more).where(F.coalesce(slots[-1], F.lit("")) != "")
    counted = grams.groupBy(*more, *slots).agg(F.count(F.lit(1)).alias(FREQ[n]))
    if part:
        spark = docs.sparkSession
        with shuffle_partitions(spark, SHUFFLE_EXPANSION * estimated_bytes(docs)):
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if packed and n > 1:
            return _bundled_by_first(counted, n, part, buckets)
        counted = counted.select(*slots, FREQ[n]).repartition(buckets, *slots)
        counted = counted.groupBy(*slots).agg(F.sum(FREQ[n]).alias(FREQ[n]))
    return counted.withColumnRenamed("w1", "word") if n == 1 else counted


def count_tables(
    docs: DataFrame,
    max_n: int = 4,
    folder: str | None = None,
    part: str | None = None,
    packed: bool = False,
) -> dict[int | str, DataFrame]:
    """Frequency tables of every order up to ``max_n`` from one pass over the text.

    Only the longest n-grams are counted from tokens, with the short ones at the end of a record
    kept as null-padded rows. Each lower order is the sum over the last word of the order above
    it, so the corpus is read, cleaned and exploded once and the later shuffles move types.
    Each plain table is written out, which is also where a lost executor's work restarts.

    The same sums give the number of different dictionary words that follow an n-gram: besides
    the plain table under n, orders below ``max_n`` come as ``contexts<n>`` with ``n_next``. The
    bigrams' one beside tetragrams is not written but summed where it is read, bucket by bucket.

    The tables are bucketed alike: the plain one by its first n-1 words, its context, and
    ``contexts<n>`` by all of its n words, over the same number of buckets. So the sums over an order,
    its joins with the contexts and its ranks per context find their rows in place. A key has no more
    rows than the vocabulary has words.

    ``part`` is a column by which ``docs`` is dealt out (``workspace.deal``). The n-grams are then counted
    inside each part where they are, and move once, to the bucket of their context; else they move twice,
    as counts by the whole n-gram first.

    ``packed`` lets n-grams be grouped and moved as one text instead of a row of words, which is fewer
    bytes. It is for tokens without SEPARATOR, such as those of ``tokenize`` on cleaned text.
    """
    spark = docs.sparkSession
    tables: dict[int | str, DataFrame] = {}
    with shuffle_partitions(spark, SHUFFLE_EXPANSION * estimated_bytes(docs)):
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        more = [part] if part else []
        padded = ngram_positions(docs, max_n, *more)
        packed = packed and max_n > 1
        keys = ["gram"] if packed else _slots(max_n)
        if packed:
            # While its words are columns the place of an n-gram costs no split.
            place = [_place([F.col(slot) for slot in _slots(max_n - 1)], buckets)] if part else []
            padded = padded.select(*more, *place, _joined(max_n))
            keys = [BUCKET, "gram"] if part else keys
        padded = padded.groupBy(*more, *keys).agg(F.count(F.lit(1)).alias("freq"))
        for n in range(max_n, 0, -1):
            if n < max_n:
                if n in (1, max_n - 1):
                    padded = materialize_bucketed(padded, f"contexts{n}", _slots(n), buckets, folder, _slots(n))
                tables[f"contexts{n}"] = _complete(padded, n, "n_next")
            if n > 1:
                if packed and part and n == max_n:
                    dealt = _bundled(padded, n, part, buckets)
                elif packed:
                    moved = padded.select("gram" if n == max_n else _joined(n), "freq")
                    dealt = moved.repartition(buckets, *_words(n - 1)).select(*_words(n), "freq")
                else:
                    dealt = padded.select(*_slots(n), "freq").repartition(buckets, *_slots(n - 1))
                if part and n == max_n and not packed:
                    dealt = dealt.groupBy(*_slots(n)).agg(F.sum("freq").alias("freq"))
                padded = materialize_bucketed(dealt, f"grams{n}", _slots(n - 1), buckets, folder, _slots(n))
            elif max_n == 1:
                padded = materialize(padded, "grams1", folder)
            tables[n] = _complete(padded, n)
            last = F.col(f"w{n}")
            padded = padded.groupBy(*_slots(n - 1)).agg(
                F.sum("freq").alias("freq"),
                F.count_if(last.isNotNull() & ~is_digit_led(last)).alias("n_next"),
            )
    return tables


def as_contexts(tables: Mapping, n: int) -> DataFrame:
    """The counts of order n as the side that is looked up: bucketed by the whole n-gram, if counted so."""
    return tables[f"contexts{n}"].drop("n_next") if f"contexts{n}" in tables else tables[n]


def _complete(padded: DataFrame, n: int, *more: str) -> DataFrame:
    slots = _slots(n)
    named = [F.col(slot).alias(name) for slot, name in zip(slots, words_of(n))]
    full = padded.where(F.col(slots[-1]).isNotNull())
    return full.select(*named, F.col("freq").alias(FREQ[n]), *more)


def total(df: DataFrame, freq: str) -> Column:
    """Sum of a frequency column as a scalar subquery: one value, no window, no cross join."""
    return df.agg(F.sum(freq).alias("total")).scalar()


def count_of_counts(df: DataFrame, freq: str) -> DataFrame:
    """Histogram of frequencies: how many n-grams occur ``freq`` times."""
    return df.groupBy(F.col(freq).alias("freq")).agg(F.count(F.lit(1)).alias("n_types"))


def ones_and_twos(df: DataFrame, freq: str) -> DataFrame:
    """N1 and N2, the number of n-grams that occur once and twice, as one row."""
    return df.agg(
        F.count_if(F.col(freq) == 1).alias("n1"),
        F.count_if(F.col(freq) == 2).alias("n2"),
    )


def discount(df: DataFrame, freq: str) -> DataFrame:
    """Absolute discount N1 / (N1 + 2 N2) as one row; 0 where no n-gram occurs once."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    rate = F.when(F.col("n1") > 0, n1 / (n1 + 2.0 * n2)).otherwise(F.lit(0.0))
    return ones_and_twos(df, freq).select("n1", "n2", rate.alias("discount"))


def type_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of n-gram types per key; counted map-side first, so a hot key is one row a task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def continuation_counts(bigrams: DataFrame) -> DataFrame:
    """Bigram types that start (``n_after``) and end (``n_before``) with each word."""
    sides = bigrams.select(
        F.explode(
            F.array(
                F.struct(F.col("w1").alias("word"), F.lit(1).alias("first"), F.lit(0).alias("last")),
                F.struct(F.col("w2").alias("word"), F.lit(0).alias("first"), F.lit(1).alias("last")),
            )
        ).alias("side")
    )
    return sides.groupBy("side.word").agg(
        F.sum("side.first").alias("n_after"), F.sum("side.last").alias("n_before")
    )


def context_types(trigrams: DataFrame) -> DataFrame:
    """Trigram types per (w1, w2)."""
    return type_counts(trigrams, ["w1", "w2"], "n_w1w2")
