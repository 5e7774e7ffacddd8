"""Joins of many rows per key with one row per key, where one key may hold much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.operators.counts import total, type_counts
from wordloom.workspace import TARGET_PARTITION_BYTES, UNKNOWN_BYTES, estimated_bytes, max_partitions

# Below this a third of the rows still fits one task, and the join is left to Spark as it is.
SALT_ABOVE_BYTES = 4 * 1024**3
# A key is hot if it holds at least this share of the frequency total, so there are at most
# 1 / HOT_SHARE hot keys, whatever the size of the data: that bounds what is broadcast.
HOT_SHARE = 1e-4
# Memory bytes of a hashed row per byte of the files it comes from.
HASH_EXPANSION = 10


def _partitions(df: DataFrame, nbytes: int) -> int:
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if nbytes >= UNKNOWN_BYTES:
        return configured
    return max(configured, min(nbytes // TARGET_PARTITION_BYTES, max_partitions(df.sparkSession)))


def hot_keys(counts: DataFrame, keys: Sequence[str], freq: str, partitions: int) -> DataFrame:
    """Keys with a large share of the frequency, and over how many tasks each is to be split.

    The number of n-grams under a context is at most the context's frequency, so the frequency
    table itself tells the hot contexts and no pass over the n-grams is needed.
    """
    share = F.col(freq).cast("double") / total(counts, freq).cast("double")
    split = F.ceil(share * F.lit(2 * partitions)).cast("int")
    hot = counts.where(share >= F.lit(HOT_SHARE)).select(*keys, split.alias("n_salts"))
    return hot.where(F.col("n_salts") > 1)


def lies_by(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the table at the left end of a plan is bucketed by ``keys``, so that a join by them finds it in place."""
    found = df._jdf.queryExecution().optimizedPlan().collectLeaves().apply(0)
    if found.nodeName() != "LogicalRelation" or found.catalogTable().isEmpty():
        return False
    spec = found.catalogTable().get().bucketSpec()
    return spec.isDefined() and spec.get().bucketColumnNames().mkString(",") == ",".join(keys)


def hashed(lower: DataFrame) -> DataFrame:
    """``lower`` with the hint to join it by a hash of its rows, so that neither side is sorted.

    There is no hint for a table that Spark would broadcast, nor for one whose partitions, dealt out by
    keys with one row each, would not fit in memory.
    """
    spark = lower.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    broadcast = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(lower._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    fits = estimated_bytes(lower) * HASH_EXPANSION <= partitions * TARGET_PARTITION_BYTES
    return lower.hint("shuffle_hash") if fits and size > broadcast else lower


def context_join(
    grams: DataFrame,
    lower: DataFrame,
    keys: Sequence[str],
    salt_by: Sequence[str],
    counts: DataFrame,
    freq: str,
    split_hot: bool = True,
) -> DataFrame:
    """Inner join of ``grams`` (many rows per key) with ``lower`` (one row per key).

    ``counts`` holds ``keys`` and their ``freq``, an upper bound of the rows per key. In a large
    join each hot key is split over a number of tasks in proportion to its share: its rows get a
    salt from ``salt_by``, and its ``lower`` row is repeated per salt. ``split_hot=False`` is for
    ``grams`` with few rows under any key. A table that lies in buckets of the keys is not split, as that
    would move all of it: a key's rows are in one bucket, and no more than the vocabulary has words.
    """
    keys = list(keys)
    if not split_hot:
        return grams.join(lower, keys)
    nbytes = estimated_bytes(grams)
    if nbytes < SALT_ABOVE_BYTES or lies_by(grams, keys):
        return grams.join(hashed(lower), keys)
    hot = F.broadcast(hot_keys(counts, keys, freq, _partitions(grams, nbytes)))
    n_salts: Column = F.coalesce("n_salts", F.lit(1))
    salt = F.pmod(F.xxhash64(*salt_by), n_salts).cast("int")
    left = grams.join(hot, keys, "left").withColumn("salt", salt).drop("n_salts")
    repeated = F.explode(F.sequence(F.lit(0), n_salts - 1))
    right = lower.join(hot, keys, "left").withColumn("salt", repeated).drop("n_salts")
    return left.join(hashed(right), [*keys, "salt"]).drop("salt")


def _shares(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` with their share of the rows (``name``) where it is hot; counted in the tasks first."""
    known = df.select(*keys)
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    counts = type_counts(known, list(keys), name)
    share = F.col(name).cast("double") / total(counts, name).cast("double")
    return counts.select(*keys, share.alias(name)).where(F.col(name) >= F.lit(HOT_SHARE))


def skew_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", partitions: int | None = None
) -> DataFrame:
    """Join of any two tables, where one key may hold much of either or of both.

    Hot keys are measured on both sides: at most 1 / HOT_SHARE of each, whatever the data. The rows
    of a hot key are dealt to a grid of tasks, the left ones to its rows and the right ones to its
    columns, in proportion to the numbers on either side; each left row meets each right row in one
    cell. A ``left`` join splits the left rows only, as every one of them has to see all of the right.

    Cells are told by a hash of the whole row, so that a repeated task deals alike; rows that are
    equal in all columns stay together. Null keys match nothing. All other columns must differ in
    name, as in any join by key columns. Empty tables join as usual.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    keys = list(keys)
    parts = partitions or _partitions(left, max(estimated_bytes(left), estimated_bytes(right)))
    hot = _shares(left, keys, "_l").join(_shares(right, keys, "_r"), keys, "full")
    of_left, of_right = F.coalesce("_l", F.lit(HOT_SHARE)), F.coalesce("_r", F.lit(HOT_SHARE))
    cells = F.ceil(F.greatest(of_left, of_right) * F.lit(2.0 * parts))
    if how == "left":
        rows, columns = F.ceil(of_left * F.lit(2.0 * parts)), F.lit(1)
    else:
        rows = F.least(F.greatest(F.round(F.sqrt(cells * of_left / of_right)), F.lit(1.0)), cells)
        columns = F.ceil(cells / rows)
    hot = hot.select(*keys, rows.cast("int").alias("_rows"), columns.cast("int").alias("_columns"))
    hot = F.broadcast(hot.where((F.col("_rows") > 1) | (F.col("_columns") > 1)))

    def dealt(df: DataFrame, own: str, other: str, place: str, copies: str) -> DataFrame:
        salt = F.pmod(F.xxhash64(*df.columns), F.coalesce(own, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        salted = df.join(hot, keys, "left").withColumn(place, salt).withColumn(copies, every)
        return salted.drop("_rows", "_columns")

    a = dealt(left, "_rows", "_columns", "_i", "_j")
    b = dealt(right, "_columns", "_rows", "_j", "_i")
    return a.join(b, [*keys, "_i", "_j"], how).drop("_i", "_j")
