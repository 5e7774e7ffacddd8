"""Documents that hold benchmark items, also with other numbers, names or units put in.

DataFrame operations only. Texts of both sides become templates: numbers, names and units turn into
typed placeholders, case and punctuation go. Windows of five template words are hashed and
joined. Matches of a document and an item that lie on one diagonal (place in the document less
place in the item) must agree in their slots: one value of the item always stands for the same
value of the document. Of the diagonals that do, the words covered must be most of the item.

A text has three templates: names are the capitalised words inside sentences; or all capitalised
words, as a sentence may begin with a name; or none, which finds copies whatever their case. A
window that matches by any of them counts. A capitalised word that begins a sentence stands for
another one only if both are names: words that the texts have in lower case more often than
capitalised inside a sentence are none.

Documents are read once and only matching windows leave the scan; the words behind placeholders are
looked up in a second read, and only where a matching item has any. Words are counted in a third,
and only if words that begin sentences differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.workspace import materialize

WINDOW = 5
COVERAGE = 0.8
# Benchmark windows up to this number are broadcast, more are joined by a shuffle.
BROADCAST_WINDOWS = 500_000

# Placeholders are characters of the private use area: number, name, unit.
NUMBER, NAME, UNIT = "", "", ""
# A capitalised word in the middle of a sentence.
_NAMED = r"(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}[\p{L}'-]*"
_NUMBERED = r"[0-9][0-9.,:/]*"
# Units that are told behind a number.
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mi mile miles mg g kg t lb lbs oz ml l s sec min h hr hours "
    "minutes seconds days weeks months years usd eur dollars euros cents percent w kw v a hz khz mhz c f"
).split()
_STRIPPED = rf"[^\p{{L}}\p{{N}}{NUMBER}-{UNIT}\s]+"


# Marks around a name inside a sentence, around any other capitalised word, and behind either.
_INNER, _FIRST, _BEHIND = "\ue010", "\ue011", "\ue012"
_UNMARKED_CAPITAL = rf"(?<![\p{{L}}\p{{N}}'{_INNER}-])\p{{Lu}}\p{{Ll}}[\p{{L}}'-]*"
_MARKED_MEASURE = rf"{NUMBER}( ?)([{_INNER}{_FIRST}]?)(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})\b"
_STRIPPED_BUT_MARKS = rf"[^\p{{L}}\p{{N}}{NUMBER}-{UNIT}{_INNER}-{_BEHIND}\s]+"


def marked(text: Column) -> Column:
    """The text with numbers, units and punctuation settled and capitalised words marked, in one go.

    Marks of the text itself go first.
    """
    out = F.translate(text, _INNER + _FIRST + _BEHIND, "")
    out = F.regexp_replace(out, _NAMED, f"{_INNER}$0{_BEHIND}")
    out = F.lower(F.regexp_replace(out, _UNMARKED_CAPITAL, f"{_FIRST}$0{_BEHIND}"))
    out = F.regexp_replace(out, _NUMBERED, NUMBER)
    out = F.regexp_replace(out, _MARKED_MEASURE, f"{NUMBER}$1$2{UNIT}")
    return F.regexp_replace(out, _STRIPPED_BUT_MARKS, "")


def _split(text: Column) -> Column:
    """Words with a letter or digit."""
    return F.array_remove(F.split(text, r"\s+"), "")


def templates(made: Column) -> list[Column]:
    """The three templates of a ``marked`` text: ``words, capital, plain``. They agree in their places."""
    inner = F.regexp_replace(made, f"{_INNER}[^{_BEHIND}]*{_BEHIND}", NAME)
    every = F.regexp_replace(made, f"[{_INNER}{_FIRST}][^{_BEHIND}]*{_BEHIND}", NAME)
    return [
        _split(F.translate(inner, _FIRST + _BEHIND, "")).alias("words"),
        _split(every).alias("capital"),
        _split(F.translate(made, _INNER + _FIRST + _BEHIND, "")).alias("plain"),
    ]


def with_templates(rows: DataFrame, text: Column, *columns: str) -> DataFrame:
    """The columns and the three templates of ``text``, marked once."""
    return rows.select(*columns, marked(text).alias("marked")).select(*columns, *templates(F.col("marked")))


def plain_words(text: Column) -> Column:
    """The words themselves, place by place those of the template."""
    return _split(F.regexp_replace(F.lower(text), _STRIPPED, ""))


def window_hash(words: str, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(WINDOW)])


def document_windows(tokens: DataFrame) -> DataFrame:
    """``doc_id, text_hash, doc_at, window``: each window by the different hashes its templates give it.

    Windows are rows before they are hashed, so that hashing is compiled; templates that agree in a
    window, as most do, give one row. The outer form of the explode keeps the optimizer from adding
    a filter on the size below the projections, in which every window makes the words of its text anew.
    """
    at = F.col("doc_at")
    each = tokens.select("doc_id", "text_hash", "words", "capital", "plain", F.posexplode_outer("words").alias("doc_at", "word"))
    each = each.where(at + WINDOW <= F.size("words"))
    each = each.select("doc_id", "text_hash", "doc_at", *[window_hash(w, at).alias(f"of_{w}") for w in ("words", "capital", "plain")])
    one = (F.col("of_words") == F.col("of_capital")) & (F.col("of_words") == F.col("of_plain"))
    several = F.array_distinct(F.array("of_words", "of_capital", "of_plain"))
    hashes = F.when(one, F.array("of_words")).otherwise(several)
    return each.select("doc_id", "text_hash", "doc_at", F.explode_outer(hashes).alias("window"))


def has_slot(word: Column) -> Column:
    return word.rlike(f"[{NUMBER}-{UNIT}]")


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, n_words, item_at, window, slots``: every window of every item."""
    given = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    items = with_templates(given, F.col("text"), "item_id")
    n_words = F.size("words").alias("n_words")
    made = []
    for name in ("words", "capital", "plain"):
        places = F.when(n_words >= WINDOW, F.sequence(F.lit(0), n_words - WINDOW))
        each = items.select("item_id", n_words, F.col(name).alias("words"), F.explode_outer(places).alias("item_at"))
        inside = F.slice("words", F.col("item_at") + 1, F.lit(WINDOW))
        window = window_hash("words", F.col("item_at")).alias("window")
        made.append(
            each.where("item_at is not null").select(
                "item_id", "n_words", "item_at", window, F.exists(inside, has_slot).alias("slots")
            )
        )
    return made[0].unionByName(made[1]).unionByName(made[2]).distinct()


def covered(places: Column) -> Column:
    """Words that windows at these places cover, each once."""
    return F.aggregate(
        F.sort_array(F.array_distinct(places)),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda acc, at: F.struct(
            at.cast("int").alias("last"),
            (acc["sum"] + F.least(at - acc["last"], F.lit(WINDOW))).cast("int").alias("sum"),
        ),
    )["sum"]


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and benchmark item that it holds.

    ``doc_id``, ``text_hash`` (tells rows that repeat an id), ``item_id``, ``n_words`` and
    ``n_covered`` words of the item, ``n_changed`` (slots that hold another value than in the item).
    A document holds an item if windows with consistent slots cover at least ``coverage`` of its
    words, wherever they stand.

    Null texts hold nothing and null items are not looked for; items of fewer than WINDOW words
    cannot be told from ordinary speech and are not looked for either. Repeated rows and repeated
    items give the row once. Null ids stay null. Other columns are not looked at. Empty tables give
    no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    windows = materialize(benchmark_windows(benchmark, item_id_col, item_text_col), "benchmark_windows")
    small = windows.count() <= BROADCAST_WINDOWS

    each = document_windows(with_templates(keyed, F.col("text"), "doc_id", "text_hash"))
    met = each.join(F.broadcast(windows) if small else windows, "window")
    met = materialize(met.drop("window"), "matches")

    # Diagonals whose item has placeholders in a matching window need the words behind them.
    diagonal = (F.col("doc_at") - F.col("item_at")).alias("diagonal")
    pair = ["doc_id", "text_hash", "item_id"]
    lines = met.groupBy(*pair, "n_words", diagonal).agg(
        F.collect_set("item_at").alias("places"), F.collect_set(F.when(~F.col("slots"), F.col("item_at"))).alias("literal")
    )
    # Places that match word by word, too, need no look at what stands behind placeholders.
    slots = (F.size(F.array_except("places", "literal")) > 0).alias("slots")
    lines = lines.select(*pair, "n_words", "diagonal", "places", slots)
    # Diagonals of a pair that together cover too little cannot matter; nor can their slots.
    whole = F.flatten(F.collect_list("places"))
    wide = lines.groupBy(*pair, "n_words").agg(whole.alias("all"), F.bool_or("slots").alias("any_slots"))
    wide = wide.where(covered(F.col("all")) >= F.lit(coverage) * F.col("n_words"))
    settled = wide.where(~F.col("any_slots")).select(
        *pair, "n_words", covered(F.col("all")).alias("n_covered"), F.lit(0).alias("n_changed")
    )
    # Null ids must meet: they are joined through a key that holds them.
    open_pairs = wide.where("any_slots").select(F.struct(*pair).alias("key"))
    open_lines = lines.withColumn("key", F.struct(*pair)).join(open_pairs, "key", "left_semi").drop("key")
    open_lines = materialize(open_lines, "open_lines")
    return settled.unionByName(_with_slots(open_lines, keyed, benchmark, item_id_col, item_text_col, coverage))


def common_words(words: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``words`` (column ``word``) that ``texts`` have in lower case more often than as names."""
    cased = F.array_remove(F.split(F.regexp_replace("text", _STRIPPED, ""), r"\s+"), "")
    lower = F.transform(
        F.filter(cased, lambda w: w == F.lower(w)), lambda w: F.struct(w.alias("word"), F.lit(1).alias("more"))
    )
    names = F.transform(
        F.regexp_extract_all("text", F.lit(_NAMED), F.lit(0)),
        lambda w: F.struct(F.regexp_replace(F.lower(w), _STRIPPED, "").alias("word"), F.lit(-1).alias("more")),
    )
    each = texts.select(F.explode_outer(F.concat(lower, names)).alias("x")).select("x.word", "x.more")
    counted = each.groupBy("word").agg(F.sum("more").alias("more")).where("more > 0").select("word")
    return counted.join(words, "word", "left_semi")


def _with_slots(
    lines: DataFrame, keyed: DataFrame, benchmark: DataFrame, item_id_col: str, item_text_col: str, coverage: float
) -> DataFrame:
    """Decide pairs with placeholders by the values that these hold on each diagonal."""
    item_texts = benchmark.where(F.col(item_text_col).isNotNull())
    items = item_texts.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    items = items.select("item_id", marked(F.col("text")).alias("made"), plain_words(F.col("text")).alias("item_words"))
    inner, template, _ = templates(F.col("made"))
    items = items.select("item_id", inner.alias("inner"), template.alias("template"), "item_words")
    held = keyed.select(
        F.struct("doc_id", "text_hash").alias("key"),
        templates(marked(F.col("text")))[0].alias("doc_inner"),
        plain_words(F.col("text")).alias("doc_words"),
    )
    needed = lines.select(F.struct("doc_id", "text_hash").alias("key")).distinct()
    held = held.join(needed, "key", "left_semi").dropDuplicates(["key"])
    rows = lines.withColumn("key", F.struct("doc_id", "text_hash")).join(held, "key").join(items, "item_id")
    spots = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (WINDOW - 1)))))
    found = lambda i: F.get("doc_words", i + F.col("diagonal"))
    # Names that begin a sentence on either side and differ.
    doubtful = F.filter(
        spots,
        lambda i: F.get("template", i).contains(NAME)
        & ~F.get("item_words", i).eqNullSafe(found(i))
        & ~(F.get("inner", i).contains(NAME) & F.get("doc_inner", i + F.col("diagonal")).contains(NAME)),
    )
    values = F.transform(
        F.filter(spots, lambda i: has_slot(F.get("template", i))),
        lambda i: F.struct(i.alias("at"), F.get("item_words", i).alias("given"), found(i).alias("found")),
    )
    # Repeated items are several rows of one id, told by their words.
    line = F.struct("doc_id", "text_hash", "item_id", "diagonal", F.xxhash64("item_words", "template").alias("item_hash"))
    rows = rows.select(
        "doc_id", "text_hash", "item_id", "n_words", "places", line.alias("line"), values.alias("values"),
        F.transform(doubtful, lambda i: F.struct(i.alias("at"), F.get("item_words", i).alias("a"), found(i).alias("b"))).alias("doubtful"),
    )
    rows = materialize(rows.dropDuplicates(["line"]), "slot_values")
    asked = rows.select("line", F.explode("doubtful").alias("x"))
    asked = asked.select("line", "x.at", F.explode(F.array("x.a", "x.b")).alias("word"))
    if not asked.isEmpty():
        texts = keyed.select("text").unionByName(item_texts.select(F.col(item_text_col).alias("text")))
        common = materialize(common_words(asked.select("word").distinct(), texts), "common_words")
        wrong = asked.join(common, "word").groupBy("line").agg(F.collect_set("at").alias("wrong"))
        rows = rows.join(wrong, "line", "left").withColumn("wrong", F.coalesce("wrong", F.array().cast("array<int>")))
        inside = lambda p: lambda at: (at >= p) & (at < p + WINDOW)
        rows = rows.withColumn("places", F.filter("places", lambda p: ~F.exists("wrong", inside(p))))
        rows = rows.withColumn(
            "values", F.filter("values", lambda v: F.exists("places", lambda p: (v["at"] >= p) & (v["at"] < p + WINDOW)))
        ).where(F.size("places") > 0)
    values = F.transform("values", lambda v: F.struct(v["given"].alias("given"), v["found"].alias("found")))
    rows = rows.withColumn("values", F.array_distinct(values))
    consistent = F.size("values") == F.size(F.array_distinct(F.col("values")["given"]))
    rows = rows.where(consistent)
    changed = F.filter("values", lambda v: ~v["given"].eqNullSafe(v["found"]))
    out = rows.groupBy("doc_id", "text_hash", "item_id", "n_words").agg(
        covered(F.flatten(F.collect_list("places"))).alias("n_covered"),
        F.size(F.array_distinct(F.flatten(F.collect_list(changed)))).alias("n_changed"),
    )
    return out.where(F.col("n_covered") >= F.lit(coverage) * F.col("n_words"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no benchmark item.

    Null and empty texts hold none and stay, null ids and repeated rows are judged by their text, and an
    id that stands for several texts loses only those with an item. Other columns may have any names.
    An empty table gives an empty one, an empty benchmark drops nothing.
    """
    found = leaks(docs, benchmark, id_col, text_col, **options)
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    found = materialize(found, "leaks")
    text_hash = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = docs[id_col].eqNullSafe(found["__id"]) & (text_hash == found["__hash"])
    return docs.join(found, same, "left_anti")
