"""Exact, seeded per-source samples of a corpus, without sorting or shuffling its text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.workspace import materialize

# Hex digits of the random key that form a bucket: 65,536 buckets a source.
BUCKET_DIGITS = 4

Seed = int | Mapping[str, int]


def sampling_key(seed: Seed, by: str, id_col: str) -> Column:
    """The random order of a source's records: a digest of seed, source and record id."""
    if isinstance(seed, Mapping):
        value = F.lit(None).cast("string")
        for source, number in seed.items():
            value = F.when(F.col(by) == source, F.lit(str(number))).otherwise(value)
    else:
        value = F.lit(str(seed))
    return F.md5(F.concat_ws("~", value, F.col(by), F.col(id_col).cast("string")))


def sample_size(frac: float) -> Column:
    return F.ceil(F.col("n_records").cast("double") * F.lit(frac)).cast("bigint")


def rank_cuts(
    df: DataFrame, by: str, id_col: str, seed: Seed, ranks: Mapping[str, Column]
) -> DataFrame:
    """Per source, the (key, id) found at each named rank of the random order, as ``cut_<name>``.

    ``ranks`` are expressions over ``n_records``. Only keys are read. Counting by (source, key
    prefix) is combined map-side and yields at most 65,536 rows a source; running sums over those
    tell which bucket holds the rank, and only that bucket's records are ranked. A source with a
    third of all records is thus never gathered in one task.
    """
    keyed = df.select(
        F.col(by).alias("source"), F.col(id_col).alias("id"), sampling_key(seed, by, id_col).alias("key")
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    buckets = keyed.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    source = Window.partitionBy("source")
    upto = source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = buckets.withColumn("upto", F.sum("n").over(upto)).withColumn(
        "n_records", F.sum("n").over(source)
    )
    named = F.explode(
        F.array(*[F.struct(F.lit(k).alias("name"), v.alias("rank")) for k, v in ranks.items()])
    )
    wanted = running.select("source", "bucket", "upto", "n", named.alias("cut"))
    wanted = wanted.select(
        "source",
        "bucket",
        F.col("cut.name").alias("name"),
        (F.col("cut.rank") - (F.col("upto") - F.col("n"))).alias("local_rank"),
    ).where((F.col("local_rank") >= 1) & (F.col("local_rank") <= F.col("n")))
    wanted = materialize(wanted, "cut_buckets").alias("w")
    inside = keyed.alias("k").join(
        wanted,
        F.col("k.source").eqNullSafe(F.col("w.source")) & (F.col("k.bucket") == F.col("w.bucket")),
    ).select("k.source", "k.bucket", "k.key", "k.id", "w.name", "w.local_rank")
    order = Window.partitionBy("source", "bucket", "name").orderBy("key", "id")
    found = inside.withColumn("position", F.row_number().over(order)).where(
        F.col("position") == F.col("local_rank")
    )
    cuts = found.groupBy("source").agg(
        *[F.max(F.when(F.col("name") == k, F.struct("key", "id"))).alias(f"cut_{k}") for k in ranks]
    )
    return materialize(cuts.withColumnRenamed("source", "cut_source"), "cuts")


def _within(df: DataFrame, by: str, id_col: str, seed: Seed, cuts: DataFrame) -> DataFrame:
    """Attach to each record its source's cuts, and its own place in the random order as ``here``.

    The cuts are a written table of one row per source, so Spark broadcasts them if that table is
    small, and the text passes through a narrow filter.
    """
    here = F.struct(sampling_key(seed, by, id_col).alias("key"), F.col(id_col).alias("id"))
    keyed = df.withColumn("here", here)
    return keyed.join(cuts, F.col(by).eqNullSafe(F.col("cut_source")))


def sample_records(
    df: DataFrame, by: str = "source", frac: float = 0.2, seed: Seed = 1234, id_col: str = "doc_id"
) -> DataFrame:
    """Exactly ``ceil(frac * N)`` records of each source, without replacement."""
    cuts = rank_cuts(df, by, id_col, seed, {"sample": sample_size(frac)})
    return _within(df, by, id_col, seed, cuts).where(F.col("here") <= F.col("cut_sample")).select(*df.columns)


def train_test_split(
    sampled: DataFrame,
    n_test: int = 100,
    by: str = "source",
    seed: Seed = 1234,
    id_col: str = "doc_id",
) -> DataFrame:
    """Add ``split``: the first ``n_test`` records of each source's random order are the test set.

    A source with fewer records than that has no training records.
    """
    size = F.least(F.lit(n_test).cast("bigint"), F.col("n_records"))
    cuts = rank_cuts(sampled, by, id_col, seed, {"test": size})
    return _mark(_within(sampled, by, id_col, seed, cuts), sampled.columns)


def sample_train_test(
    df: DataFrame,
    by: str = "source",
    frac: float = 0.2,
    n_test: int = 100,
    seed: Seed = 1234,
    id_col: str = "doc_id",
) -> DataFrame:
    """``train_test_split(sample_records(df))`` with both cuts found in one pass over the keys."""
    sample = sample_size(frac)
    ranks = {"sample": sample, "test": F.least(F.lit(n_test).cast("bigint"), sample)}
    cuts = rank_cuts(df, by, id_col, seed, ranks)
    within = _within(df, by, id_col, seed, cuts).where(F.col("here") <= F.col("cut_sample"))
    return _mark(within, df.columns)


def _mark(within: DataFrame, columns: list[str]) -> DataFrame:
    is_test = F.col("cut_test").isNotNull() & (F.col("here") <= F.col("cut_test"))
    return within.select(*columns, F.when(is_test, "test").otherwise("train").alias("split"))
