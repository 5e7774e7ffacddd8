"""Personal data: base patterns, and further spans that boosted trees tell from their surroundings.

DataFrame operations only; the trees are Spark's own, fitted on a table of bounded size. Four
patterns with their checks give the base spans, which always stay. Beside them generators propose
spans that may overlap: addresses with a written-out at sign or dots, quads with guarded dots, digit
blocks inside longer runs of numbers, phone numbers cut out of them or without their plus sign. Each
proposal is described by its format (size, groups, brackets, the check of its kind) and its context
(the characters around it, a telling word before it).

Base spans are the labels: a proposal counts as personal data if it is a base span itself. All
descriptions are small numbers, so proposals of the corpus collapse to cells, at most CELLS of them
whatever the corpus, with their counts. The trees are fitted on the cells of three quarters of the
documents, and their scores are calibrated per kind on the other quarter. Proposals of cells whose
calibrated share reaches PRECISION become spans where no base span lies.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.workspace import materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The base patterns. A match can only begin where a run of its characters begins or
# where the match before it ended, which is said first; so no run is tried at each of its characters.
BASE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
# A text without this has no match.
NEEDED = ("@", ".", None, "+")
QUAD = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"

_DOT, _AT = r"(?:\.|\x20?[\[({]\x20?(?:\.|dot)\x20?[\])}]\x20?)", r"(?:@|\x20?[\[({]\x20?(?:@|at)\x20?[\])}]\x20?)"
# The generators: kind and pattern.
GENERATORS = (
    (EMAIL, rf"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++{_AT}[a-z0-9-]++(?:{_DOT}[a-z0-9-]++)*+"),
    (IP, rf"(?i)(?<![0-9])[0-9]{{1,3}}+(?:{_DOT}[0-9]{{1,3}}+){{3}}+(?![0-9])"),
    (CARD, r"(?<![0-9])[0-9]{13,19}+(?![0-9])"),
    (CARD, r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){2}[\x20.-][0-9]{1,7}(?![0-9])"),
    (PHONE, r"\+[0-9]{1,3}+[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    (PHONE, r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"),
)
CONTEXT = 32
# Words that tell the kind of what follows.
TELLING = (
    r"mail|contact|kontakt|correo|courriel", r"\bip\b|host|server|address|adresse", r"card|visa|karte|carte|tarjeta|credit",
    r"phone|tel|call|fax|mobil|fon\b",
)
# Lower ends of the size classes after the first: characters of an address, digits of all else.
SIZES = {EMAIL: (8, 12, 16, 20, 26, 34, 48), None: (9, 10, 11, 12, 13, 16, 17)}
# Features and their number of values; their product bounds the cells.
FEATURES = {"kind": 4, "size": 8, "groups": 6, "brackets": 2, "tail": 6, "valid": 2, "before": 6, "after": 6, "told": 2}
CELLS = 331_776

FOLDS = 4
PRECISION = 0.9
# Held-out proposals that must score as high before a score says anything.
SUPPORT = 20
TREES, DEPTH, LEAF = 15, 4, 0.01


def digits(token: Column) -> Column:
    return F.regexp_replace(token, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of ``number`` pass the Luhn check."""
    values = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 1, F.when(v > 4, v * 2 - 9).otherwise(v * 2)).otherwise(v))
    return F.aggregate(doubled, F.lit(0), lambda acc, v: acc + v) % 10 == 0


def passes(kind: int, token: Column) -> Column:
    """The check of a kind; ``token`` has plain dots and at signs."""
    count = F.length(digits(token))
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        return token.rlike(QUAD)
    if kind == CARD:
        return count.between(13, 19) & luhn(digits(token))
    return count.between(9, 15)


def found(text: Column, pattern: str, needed: str | None) -> Column:
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return every if needed is None else F.when(F.contains(text, F.lit(needed)), every)


def located(text: Column, matches: Column, pattern: str) -> Column:
    """``start, end, match, before, after`` of every match, in code points.

    What lies between the matches and the matches themselves add up to the text, so their lengths
    tell all positions.
    """
    between = F.split(text, pattern, -1)
    number = F.size(matches)
    rows = F.arrays_zip(
        F.slice(between, F.lit(1), number).alias("gap"), matches.alias("match"),
        F.slice(between, F.lit(2), number).alias("next"),
    )
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
    none = F.array().cast(kind)
    made = F.aggregate(
        rows,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, row: F.struct(
            (acc["at"] + F.length(row["gap"]) + F.length(row["match"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct(
                    (acc["at"] + F.length(row["gap"])).alias("start"),
                    (acc["at"] + F.length(row["gap"]) + F.length(row["match"])).alias("end"),
                    row["match"].alias("match"),
                    F.right(row["gap"], F.lit(CONTEXT)).alias("before"),
                    F.left(row["next"], F.lit(1)).alias("after"),
                ),
            ).alias("out"),
        ),
    )["out"]
    return F.when(number > 0, made).otherwise(none)


def character(c: Column) -> Column:
    """Class of a neighbouring character: none, space, letter, digit, other, sign of assignment."""
    return (
        F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}_]"), 2).when(c.rlike("[0-9]"), 3)
        .when(c.rlike("[=:]"), 5).otherwise(4)
    )


def described(kind: int, match: Column, before: Column, after: Column) -> Column:
    """The cell of a proposal: its features as digits of one number."""
    plain = match
    if kind in (EMAIL, IP):
        plain = F.regexp_replace(F.regexp_replace(match, f"(?i){_AT}", "@"), f"(?i){_DOT}", ".")
    size = F.length(plain) if kind == EMAIL else F.length(digits(plain))
    groups = F.regexp_replace(plain, r"[^0-9]+", " ") if kind != EMAIL else F.regexp_replace(plain, r"[^.]", "")
    number = F.length(groups) if kind == EMAIL else F.size(F.split(F.trim(groups), " "))
    tail = F.length(F.regexp_extract(plain, "[A-Za-z]*$" if kind == EMAIL else "[0-9]*$", 0))
    valid = plain.rlike(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$") if kind == EMAIL else passes(kind, plain)
    values = {
        "kind": F.lit(kind),
        "size": sum([(size >= low).cast("int") for low in SIZES.get(kind, SIZES[None])], F.lit(0)),
        "groups": F.least(number, F.lit(5)),
        "brackets": F.contains(plain, F.lit("(")).cast("int"),
        "tail": F.least(tail, F.lit(5)),
        "valid": valid.cast("int"),
        "before": character(F.right(before, F.lit(1))),
        "after": character(after),
        "told": F.lower(before).rlike(TELLING[kind]).cast("int"),
    }
    cell = F.lit(0)
    for name, count in FEATURES.items():
        cell = cell * count + values[name]
    return cell.cast("int")


def features(cell: Column) -> dict[str, Column]:
    """The features of a cell."""
    out, rest = {}, cell
    for name, count in reversed(FEATURES.items()):
        out[name] = (rest % count).cast("double")
        rest = F.floor(rest / count)
    return out


def span_key(x: Column) -> Column:
    """A span as one number."""
    length = x["end"] - x["start"]
    return F.shiftleft(x["start"].cast("bigint"), 32) + F.shiftleft(length.cast("bigint"), 2) + x["order"]


def is_base(x: Column) -> Column:
    """Whether a proposal is a base span of its row; ``keys`` must be a column of a table as written."""
    return F.array_contains(F.col("keys"), span_key(x))


def checked(kind: int, spans: Column) -> Column:
    """The spans that pass the check of their kind, as ``order, start, end``."""
    good = F.filter(spans, lambda x: passes(kind, x["match"]))
    return F.transform(good, lambda x: F.struct(F.lit(kind).alias("order"), x["start"].alias("start"), x["end"].alias("end")))


def proposed_by(kind: int, spans: Column) -> Column:
    """Spans of a generator as ``order, start, end, cell``."""
    return F.transform(spans, lambda x: F.struct(
        F.lit(kind).alias("order"), x["start"].alias("start"), x["end"].alias("end"),
        described(kind, x["match"], x["before"], x["after"]).alias("cell"),
    ))


def proposals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, base, keys, proposed`` of every row.

    ``base`` are the base spans as ``order, start, end``, by kind and start, and ``keys`` the same as
    numbers. ``proposed`` are the generators' spans with their cells.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    sources = [(kind, pattern, NEEDED[kind]) for kind, pattern in enumerate(BASE)]
    sources += [(kind, pattern, "+" if pattern.startswith(r"\+") else None) for kind, pattern in GENERATORS]
    # Matches first and positions from them: a pattern is split on only where it matches.
    matches = [found(F.col("text"), pattern, needed).alias(f"m{i}") for i, (_, pattern, needed) in enumerate(sources)]
    rows = rows.select("doc_id", "text", *matches)
    placed = [located(F.col("text"), F.col(f"m{i}"), pattern) for i, (_, pattern, _) in enumerate(sources)]
    base = [checked(kind, placed[kind]) for kind in range(len(BASE))]
    proposed = [proposed_by(kind, spans) for (kind, *_), spans in zip(sources[len(BASE) :], placed[len(BASE) :])]
    rows = rows.select("doc_id", F.concat(*base).alias("base"), F.concat(*proposed).alias("proposed"))
    return rows.select("doc_id", F.array_sort("base").alias("base"), F.transform("base", span_key).alias("keys"), "proposed")


def cell_counts(proposed: DataFrame) -> DataFrame:
    """``cell, n, known`` for learning and ``n_held, known_held`` for calibration; at most CELLS rows."""
    held = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    labelled = F.transform("proposed", lambda x: F.struct(x["cell"].alias("cell"), is_base(x).alias("known")))
    each = proposed.select(held.alias("held"), F.explode(labelled).alias("x")).select("held", "x.cell", "x.known")
    # Partial counts in the tasks: a shuffled row is a cell, not a proposal.
    return each.groupBy("cell").agg(
        F.count_if(~F.col("held")).alias("n"),
        F.count_if(~F.col("held") & F.col("known")).alias("known"),
        F.count_if("held").alias("n_held"),
        F.count_if(F.col("held") & F.col("known")).alias("known_held"),
    )


def weighted_cells(cells: DataFrame, n: str, known: str) -> DataFrame:
    """Two rows per cell, known and unknown, with their number as weight."""
    both = F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col(known).cast("double").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col(n) - F.col(known)).cast("double").alias("weight")),
    ))
    return cells.withColumn("x", both).select("*", "x.label", "x.weight").drop("x").where("weight > 0")


def chosen_cells(cells: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> DataFrame:
    """``cell`` of those whose proposals are personal data by the calibrated score."""
    names = list(FEATURES)
    columns = features(F.col("cell"))
    wide = cells.coalesce(1).select("*", *[columns[name].alias(name) for name in names])
    wide = VectorAssembler(inputCols=names, outputCol="features").transform(wide)
    learnt = weighted_cells(wide, "n", "known")
    # A kind weighs as much as any other, however many proposals it has.
    share = F.col("weight") / F.sum("weight").over(Window.partitionBy("kind"))
    learnt = learnt.withColumn("weight", share)
    totals = learnt.agg(F.count_if(F.col("label") == 1).alias("yes"), F.count_if(F.col("label") == 0).alias("no")).first()
    none = cells.select("cell").where(F.lit(False))
    if not totals["yes"] or not totals["no"]:
        return none
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, weightCol="weight", minWeightFractionPerNode=LEAF)
    score = F.get(vector_to_array("probability"), F.lit(1))
    scored = trees.fit(learnt).transform(wide).select("cell", "kind", "n_held", "known_held", score.alias("score"))
    # Scores that few held-out proposals reach are rated like the highest one that enough reach.
    upto = Window.partitionBy("kind").orderBy(F.desc("score"))
    scored = materialize(scored.withColumn("reached", F.sum("n_held").over(upto)), "scored_cells")
    levels = scored.where(F.col("reached") >= support).groupBy("kind").agg(F.max("score").alias("level"))
    rated = scored.join(levels, "kind").withColumn("score", F.least("score", "level"))
    out = none
    for row in levels.select("kind").collect():
        own = rated.where(F.col("kind") == row["kind"]).coalesce(1)
        calibrated = IsotonicRegression(featuresCol="score", weightCol="weight")
        calibrated = calibrated.fit(weighted_cells(own, "n_held", "known_held"))
        out = out.unionByName(calibrated.transform(own).where(F.col("prediction") >= precision).select("cell"))
    return out


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION, support: int = SUPPORT
) -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of ``order, start, end`` by kind and start.

    Positions are code points, ends exclusive; ``order`` is the place in KINDS. ``base`` are the
    matches of the patterns that pass their checks. ``added`` are proposals whose calibrated score
    reaches ``precision`` and that overlap no base span; of those that overlap each other the first
    stays, of equal starts the longest. With fewer than ``support`` held-out proposals of a kind
    nothing is added to it.

    Null and empty texts have no spans. Rows that repeat an id are read each by itself; null ids stay
    null. Other columns are not looked at. An empty table gives an empty one.
    """
    # The texts are read once; what follows works on spans.
    made = materialize(proposals(docs, id_col, text_col), "proposed_spans")
    cells = materialize(cell_counts(made), "proposal_cells")
    chosen = materialize(chosen_cells(cells, precision, support), "chosen_cells")
    made = made.withColumn("chosen", chosen.agg(F.collect_set("cell")).scalar())
    hits = F.filter(
        "proposed",
        lambda x: F.array_contains(F.col("chosen"), x["cell"])
        & ~is_base(x)
        & ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    # Sorted by start, the longest first; a span that begins inside the last one kept goes.
    ordered = F.array_sort(F.transform(hits, lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("low"), x["order"].alias("order")
    )))
    kind = "array<struct<order:int,start:int,end:int>>"
    apart = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda acc, x: F.when(x["start"] < acc["at"], acc).otherwise(F.struct(
            (-x["low"]).alias("at"),
            F.array_append(acc["out"], F.struct(x["order"].alias("order"), x["start"].alias("start"), (-x["low"]).alias("end"))).alias("out"),
        )),
    )["out"]
    return made.select("doc_id", "base", F.array_sort(apart).alias("added"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with every span of ``personal_data`` replaced by its kind in brackets.

    All columns stay as they are but the text; null texts stay null. Rows are matched to their spans
    by a number given once to the written table, so repeated rows and null ids are no matter.
    """
    row, spans = (next(name for name in (base + "_" * i for i in range(99)) if name not in docs.columns) for base in ("row", "spans"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered_documents")
    found_spans = personal_data(numbered.select(F.col(row), F.col(text_col).alias("__text")), row, "__text", **options)
    marks = F.array(*[F.lit(f"[{name.upper()}]") for name in KINDS])
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["order"].alias("order"))))
    joined = numbered.join(found_spans.select(F.col("doc_id").alias(row), every.alias(spans)).where(F.size(spans) > 0), row, "left")
    text = F.col(text_col)
    pieces = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.concat(acc["out"], F.array(
                F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0))),
                F.when(x["start"] >= acc["at"], F.get(marks, x["order"])).otherwise(F.lit("")),
            )).alias("out"),
        ),
    )
    whole = F.concat(F.array_join(pieces["out"], ""), F.substring(text, pieces["at"] + 1, F.length(text)))
    cleaned = F.when(F.col(spans).isNull(), text).otherwise(whole)
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The digest of ``personal_data``: base spans by kind, their checksum, all spans as text."""
    spans = personal_data(docs, id_col, text_col, **options)

    def number(order: int) -> Column:
        return F.size(F.filter("base", lambda s: s["order"] == order)).cast("bigint")

    return spans.select(
        "doc_id",
        *[number(order).alias(f"n_{name}") for order, name in enumerate(KINDS)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
