"""Word lists and the row predicates built on them (all narrow: no join, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The default English stop words shipped with Spark ML's StopWordsRemover.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)

# Two-letter words that are kept, and longer words that count as noise.
KEPT_TWO_LETTER_WORDS = ("us", "go")
NOISE_LITERALS = ("wtju", "adhd")


def is_digit_led(word: Column) -> Column:
    """True where the first character is 0-9.

    Written as a range ('0' <= word < ':', the character after '9') because a range of plain
    comparisons is pushed into the Parquet scan, which a regular expression is not.
    """
    return (word >= F.lit("0")) & (word < F.lit(":"))


def is_stop_word(word: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return word.isin(list(stop_words)) if stop_words else F.lit(False)


def is_noise(word: Column) -> Column:
    """Two-letter words other than the kept ones, and the literal noise words."""
    two_letters = (F.length(word) == 2) & ~word.isin(*KEPT_TWO_LETTER_WORDS)
    return two_letters | word.isin(*NOISE_LITERALS)


def drop_digit_led(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows whose word (by default the first one, ``w1``) starts with a digit."""
    for name in cols or ("w1",):
        df = df.where(~is_digit_led(F.col(name)))
    return df


def drop_stop_words(
    df: DataFrame, word_col: str, stop_words: Sequence[str] | DataFrame = STOP_WORDS
) -> DataFrame:
    """Drop rows whose ``word_col`` is a stop word.

    A Python list becomes a hashed set inside the filter. A DataFrame with a ``word`` column is
    anti-joined instead, and Spark chooses the join from the size it measures.
    """
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select(F.col("word").alias(word_col)).distinct()
        return df.join(listed, word_col, "left_anti")
    return df.where(~is_stop_word(F.col(word_col), stop_words))


def drop_noise(df: DataFrame, word_col: str) -> DataFrame:
    return df.where(~is_noise(F.col(word_col)))


def noise_words(vocabulary: DataFrame) -> DataFrame:
    """The words of the vocabulary that are never predicted because they are noise."""
    return vocabulary.where(is_noise(F.col("word"))).select("word")


def trim_predictions(
    df: DataFrame, word_col: str, stop_words: Sequence[str] | DataFrame = STOP_WORDS
) -> DataFrame:
    """Drop stop words and noise from the predicted word."""
    return drop_noise(drop_stop_words(df, word_col, stop_words), word_col)
