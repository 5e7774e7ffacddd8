"""Secrets by pattern, and random-looking strings by a battery of randomness tests.

DataFrame operations only. Three patterns give the base spans. Beside them every run of 16 or more
encoding characters is a candidate. Its encoding is inferred, and three tests ask whether it could
be drawn evenly from that encoding's alphabet: chi-squared uniformity of the symbols, number of
runs above and below the middle, and serial correlation. Each gives a deviate, and the sum of their
squares is small for random strings and large for ordinary words.

Letter strings are ordinary if their words are lower-case but for a first capital. With capitals
inside they are candidates like any other.

What is small enough is a matter of false discoveries, and of length, as short words can look
random by accident. Ordinary letter strings of the corpus that are no longer than the candidate's
length class tell how often that happens: their share with as small a sum is the candidate's
p-value. The Benjamini-Hochberg step over all candidates then sets the limit. It works on a
histogram of fixed size, so only that is gathered from the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.workspace import materialize

# The patterns of the base spans, in the order of the kinds.
ASSIGN = (
    r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGNED = 6

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
# Lower ends of the length classes after the first.
CLASSES = (20, 24, 32, 48, 96)
# Sums of squares are counted in steps of a quarter; all from 100 on are one bin.
BINS, STEPS = 400, 4.0
FALSE_DISCOVERIES = 0.05

_LOWER36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# Name, pattern that infers it (the first that fits), alphabet, whether case is set aside.
ENCODINGS = (
    ("plain", r"^(?!.*[A-Za-z][A-Z])[A-Za-z+/_-]+$", "abcdefghijklmnopqrstuvwxyz+/_-", True),
    ("digits", r"^[0-9+/_-]+$", "0123456789+/_-", True),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", True),
    ("base32", r"^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567", True),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", _LOWER36, True),
    ("base62", r"^[0-9A-Za-z]+$", _BASE62, False),
    ("base64", "", _BASE64, False),
)
PLAIN, DIGITS = 0, 1


def places(text: Column, pattern: str) -> Column:
    """``start, end, match`` of every leftmost, non-overlapping match, in code points.

    What lies between the matches and the matches themselves add up to the text, so their lengths
    tell all positions.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    kind = "array<struct<start:int,end:int,match:string>>"
    made = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda acc, pair: F.struct(
            (acc["at"] + F.length(pair["gap"]) + F.length(pair["match"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct(
                    (acc["at"] + F.length(pair["gap"])).alias("start"),
                    (acc["at"] + F.length(pair["gap"]) + F.length(pair["match"])).alias("end"),
                    pair["match"].alias("match"),
                ),
            ).alias("out"),
        ),
    )["out"]
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast(kind))


def spans_of(found: Column, order: int) -> Column:
    """Matches as ``start, order, end``, which sorts as the spans are to be listed."""
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"))
    )


def encoding_of(token: Column) -> Column:
    """Number of the encoding whose pattern fits first."""
    out = F.lit(len(ENCODINGS) - 1)
    for number in reversed(range(len(ENCODINGS) - 1)):
        out = F.when(token.rlike(ENCODINGS[number][1]), F.lit(number)).otherwise(out)
    return out


def symbols(token: Column, encoding: Column) -> Column:
    """Places of the token's characters in the alphabet of its encoding, from 0."""
    plain = F.lower(token)
    # The two letters of the other base64 alphabet stand for the same values.
    wide = F.translate(token, "-_", "+/")

    def listed(alphabet: str, folded: bool) -> Column:
        source = plain if folded else wide
        return F.transform(F.split(source, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))

    out = listed(*ENCODINGS[-1][2:])
    for number in reversed(range(len(ENCODINGS) - 1)):
        out = F.when(encoding == number, listed(*ENCODINGS[number][2:])).otherwise(out)
    return out


def deviation(values: Column, size: Column) -> Column:
    """Sum of squared deviates of the three tests for symbols 0 .. size - 1."""
    n = F.size(values).cast("double")
    k = size.cast("double")
    counts = F.transform(
        F.array_distinct(values), lambda v: F.size(F.filter(values, lambda x: x == v)).cast("double")
    )
    squares = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c)
    chi = k / n * squares - n
    ninth = F.lit(2.0) / (F.lit(9.0) * (k - 1.0))
    uneven = F.greatest((F.pow(chi / (k - 1.0), F.lit(1.0 / 3.0)) - (F.lit(1.0) - ninth)) / F.sqrt(ninth), F.lit(0.0))

    pairs = F.arrays_zip(
        F.slice(values, F.lit(1), F.size(values) - 1).alias("a"), F.slice(values, F.lit(2), F.size(values) - 1).alias("b")
    )
    half = k / 2.0
    changes = F.size(F.filter(pairs, lambda p: (p["a"] >= half) != (p["b"] >= half))).cast("double")
    runs = (changes - (n - 1.0) / 2.0) / F.sqrt((n - 1.0) / 4.0)

    middle = (k - 1.0) / 2.0
    product = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["a"] - middle) * (p["b"] - middle))
    serial = product / (k * k - 1.0) * 12.0 / F.sqrt(n - 1.0)
    return uneven * uneven + runs * runs + serial * serial


def candidates(text: Column) -> Column:
    """``start, end, class, encoding, bin`` of every run of encoding characters but plain numbers."""
    found = F.transform(
        places(text, CANDIDATE),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("token"), encoding_of(x["match"]).alias("encoding")),
    )
    found = F.filter(found, lambda x: x["encoding"] != DIGITS)
    sizes = F.array(*[F.lit(len(alphabet)) for _, _, alphabet, _ in ENCODINGS])
    return F.transform(
        F.transform(
            found,
            lambda x: F.struct(
                x["start"].alias("start"), x["end"].alias("end"), x["encoding"].alias("encoding"),
                symbols(x["token"], x["encoding"]).alias("values"),
            ),
        ),
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            sum([(F.size(x["values"]) >= low).cast("int") for low in CLASSES], F.lit(0)).alias("class"),
            x["encoding"].alias("encoding"),
            F.least(F.floor(deviation(x["values"], F.get(sizes, x["encoding"])) * STEPS), F.lit(BINS)).cast("int").alias("bin"),
        ),
    )


def discoveries(found: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``class, bin`` of the candidates that are discoveries, from rows ``class, encoding, bin``.

    All tables here have at most classes times bins rows, whatever the corpus. Where no ordinary
    string is short enough to compare with, nothing can be claimed.
    """
    cells = found.groupBy("class", "bin").agg(
        F.count_if(F.col("encoding") == PLAIN).alias("plain"), F.count_if(F.col("encoding") != PLAIN).alias("n")
    )
    cells = materialize(cells, "test_histogram")
    own = cells.where("n > 0").select("class", "bin", "n")
    # A candidate is compared with the ordinary strings of its own and of all shorter classes.
    longer = F.explode(F.sequence(F.col("class"), F.lit(len(CLASSES)))).alias("class")
    below = cells.where("plain > 0").select(longer, F.col("bin").alias("b"), "plain")
    below = below.groupBy("class", "b").agg(F.sum("plain").alias("plain"))
    every = own.select("class", F.col("bin").alias("b"), "n").join(below, ["class", "b"], "full")
    every = every.select("class", "b", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("plain", F.lit(0)).alias("plain"))
    upto = Window.partitionBy("class").orderBy("b")
    whole = Window.partitionBy("class")
    p = (F.sum("plain").over(upto) + 1.0) / (F.sum("plain").over(whole) + 1.0)
    rated = every.withColumn("p", p).where("n > 0")
    # Benjamini-Hochberg: the greatest p that is at most rate times its rank over the number of all.
    rank = F.sum("n").over(Window.orderBy("p"))
    total = F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = rated.withColumn("passes", F.col("p") <= F.lit(rate) * rank / total)
    limit = F.max(F.when(F.col("passes"), F.col("p"))).over(
        Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return ranked.withColumn("limit", limit).where("p <= limit").select("class", F.col("b").alias("bin"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``doc_id, base, random`` of every row: arrays of ``start, order, end``.

    Positions are code points, ends exclusive. ``base`` holds the matches of the patterns: an
    assignment of MIN_ASSIGNED characters or more, an access key, a long run of lower-case hex;
    ``order`` is the place in KINDS. ``random`` holds the discoveries that overlap no base span.
    Null and empty texts have none. Rows that repeat an id are scanned each by itself; null ids stay
    null. Other columns are not looked at. An empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # A text without the four plain beginnings has no assignment; looking for them is cheap.
    low = F.lower("text")
    begun = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    assigned = F.when(begun, places(F.col("text"), ASSIGN))
    assigned = F.filter(assigned, lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= MIN_ASSIGNED)
    accessed = F.when(F.contains("text", F.lit("AKIA")), places(F.col("text"), ACCESS))
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    base = F.array_sort(
        F.concat(
            F.coalesce(spans_of(assigned, 0), none),
            F.coalesce(spans_of(accessed, 1), none),
            spans_of(places(F.col("text"), HEX), 2),
        )
    )
    made = rows.select("doc_id", base.alias("base"), candidates(F.col("text")).alias("candidates"))
    # The texts are read once; what follows works on spans.
    made = materialize(made, "scanned")
    found = discoveries(made.select(F.explode("candidates").alias("c")).select("c.class", "c.encoding", "c.bin"), rate)
    good = found.agg(F.collect_set(F.col("class") * 1000 + F.col("bin"))).scalar()
    made = made.withColumn("good", good)
    hits = F.filter(
        "candidates",
        lambda c: (c["encoding"] != PLAIN)
        & F.array_contains(F.col("good"), c["class"] * 1000 + c["bin"])
        & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    return made.select("doc_id", "base", spans_of(hits, 3).alias("random"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """The digest of ``scan``: counts by kind, checksum of the base spans, all spans as text."""
    found = scan(docs, id_col, text_col, rate)

    def number(order: int) -> Column:
        return F.size(F.filter("base", lambda s: s["order"] == order)).cast("bigint")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("bigint").alias("n_random"),
    )
