"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every document of a source expects ``rate = target / source size`` copies. Documents are put in a
fixed order, their expectations are summed up, one random offset per source is added, and a
document is emitted once for every whole number that its part of the sum crosses: ``rate`` copies
on average, never more than its next whole number. Neighbours in the order are alike in size, so
the words taken stray from the target by little.

The order is (size class, a digit of a hash, size, id). All rows are sorted by source and this order
over ranges that balance themselves, a place is the number of rows in the ranges before plus the one
inside the range, and a source's prefix sums are places less the place of its first row. So a source
with a third of all rows, or copies of one text, are spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.workspace import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SEED = "mix-1"
# monotonically_increasing_id() = partition number << 33 | row number within the partition.
ROW_BITS = 33
# The six bytes that separate words.
_SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words that the six ASCII white-space bytes separate; null texts have none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{_SPACE}|{_SPACE}$", "")
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, _SPACE))).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    Weights go to the sources in the order of their names' code points, null last, and repeat. The
    targets sum up to ``share`` of all sizes and are proportional to the weights, but none exceeds
    ``most`` times its source's size; what is cut off goes to the others by weight. With the caps
    in the order of cap per weight, a source is capped exactly if its own ratio does not exceed what a
    unit of weight gets once all sources before it are capped. Works on rows of sources only, of
    which one task can hold all; ``share`` must not exceed ``most``.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place)
    rows = sizes.select("source", "source_size", weight.alias("weight"))
    cap = F.lit(float(most)) * F.col("source_size")
    rows = rows.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    # Sources from here on get the level of the first one that is not capped.
    open_level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(every)
    target = F.when(F.col("level") >= F.col("ratio"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("weight") * open_level["level"])
    )
    return rows.select("source", "source_size", target.alias("target"))


def size_class(size: Column) -> Column:
    """Number of digits and the first two of them: at most 90 classes for each further digit."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")


def offset(source: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the source's name and the seed alone."""
    name = F.coalesce(F.concat(F.lit("="), source), F.lit("null"))
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, n_copies`` of every row of ``docs``.

    A document is emitted ``n_copies`` times. Null texts have size 0; a source of size 0 has target
    0 and gives nothing. Null is a source of its own, and so is the empty name. Rows that repeat an
    id are documents of their own: equal rows may differ in copies, but the copies of all of them
    together are the same in each run. Null ids come first within their cell. Other columns are not
    looked at. An empty table gives an empty one.
    """
    key = F.col(id_col).cast("bigint")
    rows = docs.select(key.alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    digit = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")), 1, 1)
    rows = rows.withColumn("class", size_class(F.col("size"))).withColumn("digit", digit)
    # The texts are read once; sizes, counts and ranks come from these few numbers per row.
    rows = materialize(rows, "sizes")

    # Null sources are told from named ones by a flag, as joins would drop them.
    flagged = rows.withColumn("unnamed", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    order = ["unnamed", "name", "class", "digit", "size", "doc_id"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that agree in all of these are dealt out by the last.
    placed = flagged.withColumn("deal", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(parts, *order, "deal").sortWithinPartitions(*order, "deal")
    # Written once, so that the sampled range bounds are used once.
    placed = materialize(placed.drop("deal").withColumn("row_id", F.monotonically_increasing_id()), "places")
    part = F.shiftright("row_id", ROW_BITS)
    within = F.col("row_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    # One row per range and source in it: what lies before in the source.
    pieces = placed.groupBy("unnamed", "name", part.alias("part")).agg(
        F.count("*").alias("n"), F.min(within).alias("first"), F.sum("size").alias("words")
    )
    pieces = materialize(pieces, "pieces")
    before = Window.partitionBy("unnamed", "name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    sources = pieces.groupBy("unnamed", "name").agg(F.sum("words").alias("source_size"))
    sources = sources.select(
        F.when(~F.col("unnamed"), F.col("name")).alias("source"), F.col("source_size")
    )
    targets = source_targets(sources, weights, share, most)
    targets = targets.select(
        F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name"),
        "source_size", "target",
    )
    known = pieces.select("unnamed", "name", "part", earlier.alias("earlier")).join(targets, ["unnamed", "name"])

    ranked = placed.withColumn("part", part).withColumn("rank", within).join(known, ["unnamed", "name", "part"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.col("earlier") + F.col("rank")
    start = offset(F.col("source"), seed)
    crossed = F.floor(start + rate * upto) - F.floor(start + rate * (upto - 1))
    return ranked.select(
        "doc_id", "source", "size", "source_size", "target", crossed.cast("bigint").alias("n_copies")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, each as often as ``copies`` says.

    Rows are matched by id, source and size. Among rows equal in all three the copies are added up
    and dealt out evenly, the first ones in the order of their texts getting one more. Null texts have
    no words and null sources are one source, as in ``copies``. Other columns may have any names. An
    empty table gives an empty one.
    """
    counted = copies(docs, id_col, text_col, source_col, **options)
    keys = ["__id", "__source", "__size"]
    counted = counted.groupBy(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size")
    ).agg(F.sum("n_copies").alias("__copies"), F.count("*").alias("__rows"))
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(id_col).cast("bigint").alias("__id"),
        F.col(source_col).alias("__source"),
        word_count(F.col(text_col)).alias("__size"),
    )
    match = [whole[k].eqNullSafe(counted[k]) for k in keys]
    both = whole.join(counted, match).select(*[whole[k] for k in keys], "__row", "__copies", "__rows")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("__row")))
    # Nearly all rows are the only ones of their key, and need no rank.
    alone = both.where("__rows = 1").select("__row", F.col("__copies").alias("__times"))
    several = both.where("__rows > 1").withColumn("__place", place)
    extra = (F.col("__place") <= F.col("__copies") % F.col("__rows")).cast("bigint")
    several = several.select("__row", (F.floor(F.col("__copies") / F.col("__rows")) + extra).alias("__times"))
    repeated = alone.unionByName(several).where("__times > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("__times").cast("int"))).alias("__n")
    out = repeated.select("__row", times)
    return out.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
