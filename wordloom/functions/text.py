"""Cleaning and tokenising as column expressions; no UDF, so the work stays in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.functions.words import is_digit_led
from wordloom.workspace import materialize

# The patterns of the cleaning chain. A record may hold several physical lines and
# every rule applies per line; the line end is spelled out so that one pass covers all lines.
# Slash, at, pipe and hyphen become spaces together with all other non-text characters. The only
# earlier rules that look at a space are those for sentence marks, so these accept the four as one.
LINE_END = r"(?=[\r\n]|\z)"
SENTENCE_MARKS = [r"\.", r"\?", "!"]
SPACED = "[ /@|-]"
NOT_TEXT = r"[^\p{L}\p{N}\s'<>]"
WEB_ADDRESS = " www(.+) "
SINGLE_LETTER = " [b-hj-z] "
# What lies between two tokens: white space with the outer quotes and angle brackets of both
# neighbours, and any tokens made of digits only. A run of marks is tried once, at its start.
MARKS = "['<>]"
BETWEEN_WORDS = (
    rf"(?:(?<!{MARKS}){MARKS}++)?\s++{MARKS}*+(?:[0-9]++{MARKS}*+\s++{MARKS}*+)*+"
)
# Queries are not cleaned: other punctuation separates words, inner quotes and hyphens stay.
QUERY_PUNCTUATION = r"[^\p{L}\p{N}\s'-]"
QUERY_OUTER_MARKS = r"(?<!\S)['-]+|['-]+(?!\S)"
QUERY_NUMBER = r"(?<!\S)['-]*[0-9]+['-]*(?!\S)"


def clean_text(text: Column) -> Column:
    """The ordered cleaning chain, applied to each physical line of the record."""
    out = F.replace(F.lower(text), F.lit("<>"), F.lit("'"))
    for mark in SENTENCE_MARKS:
        out = F.regexp_replace(out, f"{mark}(?:{SPACED}|{LINE_END})", " ")
    out = F.replace(out, F.lit("<85>"), F.lit(" "))
    out = F.replace(out, F.lit("<92>"), F.lit("'"))
    out = F.replace(out, F.lit("&"), F.lit(" and "))
    out = F.regexp_replace(out, NOT_TEXT, " ")
    out = F.regexp_replace(out, WEB_ADDRESS, " ")
    return F.regexp_replace(out, SINGLE_LETTER, " ")


def tokenize(cleaned: Column) -> Column:
    """Words of cleaned text: outer marks stripped, pure numbers and empty tokens dropped.

    One split does all of it; the spaces around the text make its two ends like any other place.
    """
    padded = F.concat(F.lit(" "), F.lower(cleaned), F.lit(" "))
    return F.array_remove(F.split(padded, BETWEEN_WORDS), "")


def tokenize_query(text: Column) -> Column:
    """Words of a query phrase, which is not cleaned: hyphens inside a word stay."""
    spaced = F.regexp_replace(F.lower(text), QUERY_PUNCTUATION, " ")
    bare = F.regexp_replace(spaced, f"{QUERY_NUMBER}|{QUERY_OUTER_MARKS}", "")
    return F.array_remove(F.split(bare, r"\s+"), "")


def remove_features(tokens: Column, words: Sequence[str]) -> Column:
    """Drop block-list words before n-grams are formed, so an n-gram bridges the gap."""
    if not words:
        return tokens
    return F.filter(tokens, lambda word: ~word.isin(list(words)))


# Bits of the filter that tells which words may be listed, per listed word and at most; and its hashes.
FILTER_BITS_PER_WORD, FILTER_BITS, FILTER_HASHES = 16, 1 << 26, 4


def _filter_bits(code: Column, slots: int) -> list[Column]:
    """Places in the filter, as (slot of 64 bits, bit) pairs, of a word with this ``xxhash64``; ``slots`` is a power of two."""
    low, high = code.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(code, 32).bitwiseOR(F.lit(1))
    out = []
    for turn in range(FILTER_HASHES):
        at = low + F.lit(turn) * high if turn else low
        slot = F.shiftright(at, 6).bitwiseAND(F.lit(slots - 1)).cast("int")
        out.append(F.struct(slot.alias("slot"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit")))
    return out


def word_filter(listed: DataFrame) -> tuple[Column, int]:
    """A Bloom filter of ``listed.word`` as one array of 64-bit slots, and its number of slots.

    Its size follows the number of words up to FILTER_BITS (8 MB); beyond that it lets more words
    through, which costs time and no result.
    """
    slots = 1
    while slots * 64 < min(listed.count() * FILTER_BITS_PER_WORD, FILTER_BITS):
        slots *= 2
    each = listed.select(F.explode(F.array(*_filter_bits(F.xxhash64("word"), slots))).alias("x"))
    filled = each.groupBy("x.slot").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("x.bit"))).alias("bits"))
    every = listed.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    rows = every.join(filled, "slot", "left").select("slot", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("slot", "bits")))
    return rows.agg(ordered.alias("rows")).select(F.col("rows")["bits"].alias("bits")).scalar(), slots


def may_be_listed(word: Column, bits: Column, slots: int) -> Column:
    return _holds(F.xxhash64(word), bits, slots)


def _holds(code: Column, bits: Column, slots: int) -> Column:
    out = F.lit(True)
    for x in _filter_bits(code, slots):
        out = out & (F.getbit(F.get(bits, x["slot"]), x["bit"]) == 1)
    return out


def remove_listed_features(docs: DataFrame, words: DataFrame, folder: str | None = None) -> DataFrame:
    """``remove_features`` on ``docs.tokens`` for a ``words(word)`` table, whatever its length.

    Records are written once, with a row id, so that records with equal columns, or none but the
    tokens, stay apart, and with a mark for each token that a Bloom filter of the list lets through. A
    record without any is done: it is neither joined nor moved. The different words among the marked
    tokens are looked up in the list, which is written too, so that Spark knows its size. The others
    lose their marked tokens in place, but for the few words that the list turns out not to hold.
    So a token costs the same however many listed words its record has. Null tokens stay null.
    """
    row, marks, suspects, held_bits = (
        next(name for name in (base + "_" * i for i in range(99)) if name not in docs.columns)
        for base in ("_row", "_marks", "_suspects", "_bits")
    )
    listed = words.select("word").where(F.col("word").isNotNull()).distinct()
    listed = materialize(listed, "block_list", folder)
    bits, slots = word_filter(listed)
    # Each word is hashed once. The filter is an argument, used once, so that Spark puts it in place and no
    # record carries a copy; the row id keeps the cleaning chain in a projection of its own.
    codes = F.transform("tokens", lambda word: F.xxhash64(word))
    marked = F.transform(F.array(held_bits), lambda held: F.transform(codes, lambda code: _holds(code, held, slots)))
    kept = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(held_bits, bits)
    kept = kept.withColumn(marks, F.get(marked, F.lit(0))).drop(held_bits)
    found = F.array_distinct(F.filter("tokens", lambda word, at: F.get(F.col(marks), at) & word.isNotNull()))
    kept = materialize(kept.withColumn(suspects, found), "records", folder)
    clean = kept.where(F.coalesce(F.size(suspects), F.lit(0)) <= 0).select(*docs.columns)
    rest = kept.where(F.size(suspects) > 0)
    held = rest.select(row, F.explode(suspects).alias("word"))
    innocent = held.select("word").distinct().join(listed, "word", "left_anti")
    innocent = materialize(innocent, "unlisted_words", folder)
    spared = held.join(innocent, "word").groupBy(row).agg(F.collect_list("word").alias("_spared"))
    spared = materialize(spared, "spared_words", folder)
    left = F.filter(
        "tokens",
        lambda word, at: ~F.get(rest[marks], at) | F.coalesce(F.array_contains(spared["_spared"], word), word.isNull()),
    )
    joined = rest.join(spared, row, "left")
    joined = joined.select(*[left.alias(c) if c == "tokens" else rest[c] for c in docs.columns])
    return clean.unionByName(joined)


def ngrams(tokens: Column, n: int) -> Column:
    """All n-grams of a token array, each an array of n words; empty if there are too few."""
    size = F.size(tokens)
    starts = F.sequence(F.lit(1), size - (n - 1))
    grams = F.transform(starts, lambda start: F.slice(tokens, start, n))
    return F.when(size >= n, grams).otherwise(F.array().cast("array<array<string>>"))


def last_tokens(tokens: Column, n: int) -> Column:
    """The last n tokens, or all of them if there are fewer."""
    size = F.size(tokens)
    return F.slice(tokens, F.greatest(size - (n - 1), F.lit(1)), n)


def token_count(tokens: Column) -> Column:
    return F.size(tokens)


def word_length(word: Column) -> Column:
    return F.length(word)


def split_ngram(gram: Column, n: int) -> list[Column]:
    """The n words of a space-joined n-gram as columns ``w1`` .. ``wn``."""
    parts = F.split(gram, " ")
    return [F.get(parts, F.lit(i)).alias(f"w{i + 1}") for i in range(n)]


def join_words(*words: str) -> Column:
    return F.concat_ws(" ", *words)


def prefix_ngram(n: int) -> Column:
    """The first n-1 words of an n-gram row, joined by a space."""
    return join_words(*[f"w{i}" for i in range(1, n)])


def suffix_ngram(n: int) -> Column:
    """The last n-1 words of an n-gram row, joined by a space."""
    return join_words(*[f"w{i}" for i in range(2, n + 1)])


def context_key(*words: str) -> Column:
    """The context as one column. A struct of words, which cannot collide as pasted ids do."""
    return F.struct(*words)


def has_digit_led_word(*words: str) -> Column:
    """True where any of the named word columns starts with a digit."""
    flags = [is_digit_led(F.col(word)) for word in words]
    out = flags[0]
    for flag in flags[1:]:
        out = out | flag
    return out
