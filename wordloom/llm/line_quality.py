"""Quality rules from words and lines of a text, and from how many documents share its lines.

DataFrame operations only. Per-text counts are expressions on one row: window hashes are sorted
inside the row, so that a long text costs n log n. Across documents, lines are normalised and
hashed; how many documents of a host hold each is counted with partial sums before the one
shuffle; lines above the limit are taken out and a document that loses too much is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.workspace import materialize

# The six bytes that separate words, and the symbols that are counted.
_SPACES = " \t\n\x0b\x0c\r"
_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line of a host is boilerplate if more of its documents hold it than this many, however many the
# host has: documents that are added to a host acquit no line.
LINE_DOCUMENTS = 20
# A document is depleted if lines that are no boilerplate hold fewer words, or a smaller share.
LEFT_WORDS = 25
LEFT_SHARE = 0.25


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def window_hashes(tokens: Column) -> Column:
    """One hash per window of three words; none for a shorter text."""
    last = F.size(tokens) - 2
    hashes = F.transform(
        F.sequence(F.lit(0), last - 1),
        lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)),
    )
    return F.when(last > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def repeat_words(hashes: Column) -> Column:
    """Words that lie in a window of three that occurs twice or more in the text.

    In most texts all windows differ, and nothing more is done. Else windows are sorted by hash
    within the row; equal neighbours mark their places, and each place covers three words, of which
    every word counts once.
    """
    placed = F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(1), F.size(hashes)).alias("at"))
    ordered = F.sort_array(placed)
    sorted_hashes = F.sort_array(hashes)
    # The two shifted arrays are zipped, which keeps every step linear.
    nothing = F.array(F.lit(None).cast("bigint"))
    before = F.concat(nothing, F.slice(sorted_hashes, F.lit(1), F.size(hashes) - 1))
    after = F.concat(F.slice(sorted_hashes, F.lit(2), F.size(hashes) - 1), nothing)
    near = F.arrays_zip(ordered.alias("w"), before.alias("b"), after.alias("a"))
    again = F.filter(
        near, lambda x: x["w"]["h"].eqNullSafe(x["b"]) | x["w"]["h"].eqNullSafe(x["a"])
    )
    places = F.sort_array(F.transform(again, lambda x: x["w"]["at"]))
    # Places in order: each adds as many words as it lies beyond the one before, three at most.
    total = F.aggregate(
        places,
        F.struct(F.lit(-9).alias("last"), F.lit(0).alias("sum")),
        lambda acc, at: F.struct(
            at.cast("int").alias("last"), (acc["sum"] + F.least(at - acc["last"], F.lit(3))).cast("int").alias("sum")
        ),
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(total["sum"])


def line_hash(line: Column) -> Column:
    """Case, digits and spacing do not make another line."""
    return F.xxhash64(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]+", "0"), _SPACE, " "))


def host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("null"))


def text_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of each text, and of its lines: normalised hash, words, times."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        host_key(F.col(host_col)).alias("host"),
        text.alias("text"),
    )
    rows = rows.withColumn("tokens", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, _SPACES, "")) > 0)
    rows = rows.withColumn("lines", lines).withColumn("windows", window_hashes(F.col("tokens")))
    plain = F.transform(
        F.col("lines"),
        lambda line: F.struct(line_hash(line).alias("line"), F.size(words(line)).alias("words")),
    )
    return rows.select(
        "doc_id",
        "host",
        F.xxhash64("text").alias("text_hash"),
        F.size("tokens").cast("bigint").alias("n_words"),
        F.length(F.translate("text", _SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("windows")).cast("bigint").alias("n_repeat_words"),
        plain.alias("lines"),
    )


def boilerplate(texts: DataFrame, least: int = LINE_DOCUMENTS) -> DataFrame:
    """``host, line``: lines that more than ``least`` documents of their host hold.

    ``texts`` has one row per different text of a host, with the number of its documents. Lines are
    made different within the row first, and counts are added up map-side before the shuffle.
    """
    own = F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line")
    counted = texts.select("host", "documents", own).groupBy("host", "line").agg(F.sum("documents").alias("n"))
    return counted.where(F.col("n") > F.lit(least)).select("host", "line")


def with_losses(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` of ``text_counts`` with ``lines_lost, words_lost`` and ``marks``, the hashes of their boilerplate."""
    # Equal texts of a host hold the same lines: they are looked up once and count as often as they occur.
    different = rows.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"), F.count("*").alias("documents"))
    different = materialize(different, "different_texts")
    common = materialize(boilerplate(different, least), "boilerplate")
    each = different.select("host", "text_hash", F.explode("lines").alias("x")).select(
        "host", "text_hash", F.col("x.line").alias("line"), F.col("x.words").alias("words")
    )
    lost = each.join(common, ["host", "line"]).groupBy("host", "text_hash")
    lost = lost.agg(
        F.count("*").alias("lines_lost"), F.sum("words").alias("words_lost"), F.collect_set("line").alias("marks")
    )
    return rows.join(lost, ["host", "text_hash"], "left")


def verdict() -> tuple[Column, Column, Column]:
    """Words left, failure by the base rules, depletion, for rows of ``with_losses``."""
    left = F.col("n_words") - F.coalesce("words_lost", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (left < LEFT_WORDS) | (left < F.lit(LEFT_SHARE) * F.col("n_words"))
    return left, failed, depleted


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least: int = LINE_DOCUMENTS,
) -> DataFrame:
    """Counts and verdict of every row.

    ``doc_id, n_words, word_chars`` (code points in words), ``n_symbols, n_dup_lines`` (lines with
    a word that equal an earlier one), ``n_repeat_words`` (words in windows of three found twice or
    more), ``base_failed`` (fewer than MIN_WORDS words, or over MAX_REPEAT_PERCENT of them
    repeated), ``n_lines``, ``n_boilerplate_lines``, ``left_words`` and ``kept``: not base_failed and
    not depleted by the loss of boilerplate lines.

    Null and empty texts have no words and fail. Null hosts are one host. Every row is a document, so
    each copy of a text counts; a text with more copies in its host than ``least`` loses all lines. Rows
    that repeat an id are judged each by its own text, equal rows alike. Other columns are not looked at. An empty table
    gives an empty one.
    """
    rows = materialize(text_counts(docs, id_col, text_col, host_col), "line_counts")
    judged = with_losses(rows, least)
    left, failed, depleted = verdict()
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce("lines_lost", F.lit(0)).cast("bigint").alias("n_boilerplate_lines"),
        left.cast("bigint").alias("left_words"),
    )


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least: int = LINE_DOCUMENTS,
) -> DataFrame:
    """The rows that ``judge`` keeps, all columns as they are but the text, which loses its boilerplate lines.

    A line goes with the line break that ends it; all other line breaks and blank lines stay. Null
    and empty texts fail and go. Null hosts are one host. Equal rows stay or go together. Null ids
    stay null, other columns may have any names. An empty table gives an empty one.
    """
    host, text_hash, marks = (
        next(name for name in (base + "_" * i for i in range(99)) if name not in docs.columns)
        for base in ("__host", "__hash", "__marks")
    )
    rows = materialize(text_counts(docs, id_col, text_col, host_col), "line_counts")
    _, failed, depleted = verdict()
    # One row per text: verdict and losses are those of the text and its host.
    judged = with_losses(rows, least).where(~failed & ~depleted).dropDuplicates(["host", "text_hash"])
    kept = judged.select(
        F.col("host").alias(host), F.col("text_hash").alias(text_hash), F.col("marks").alias(marks)
    )
    text = F.col(f"`{text_col}`")
    own = F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(marks, line_hash(line)))
    left = F.when(F.col(marks).isNull(), text).otherwise(F.array_join(own, "\n")).alias(text_col)
    keyed = docs.withColumns(
        {host: host_key(F.col(host_col)), text_hash: F.xxhash64(F.coalesce(text, F.lit("")))}
    ).join(kept, [host, text_hash])
    return keyed.select(*[left if name == text_col else F.col(f"`{name}`") for name in docs.columns])
