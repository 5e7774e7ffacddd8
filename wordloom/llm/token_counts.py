"""Exact histogram of encoded lengths, and what its suffix sums tell for every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm import encoding
from wordloom.llm.shipping import ship
from wordloom.workspace import materialize

# Lengths share a bucket of this many values; buckets are summed first, then lengths inside one.
BUCKET = 512
ROWS = 4096


def _lengths(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            _, counts = encoding.encoder(path).encode(whole.slice(start, ROWS).column(0))
            values, times = np.unique(counts, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.int64()), pa.array(times, pa.int64())], names=["length", "n_docs"]
            )


def length_histogram(
    docs: DataFrame, text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """``length``, ``n_docs``: how many texts have each encoded length; a null text has length 0."""
    ship(docs.sparkSession)
    path = tokenizer or encoding.default_path()
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(
        lambda batches: _lengths(batches, path), "length bigint, n_docs bigint"
    )
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """Totals for every context limit that is a length of the histogram, by suffix sums.

    ``docs_at_least`` and ``tokens_at_least`` are sums over this and all greater lengths;
    ``tokens_truncated`` is the total if every text is cut after ``length`` ids, and
    ``docs_truncated`` how many texts that cuts; ``tokens_total`` is the uncut total. ``quantile``
    is the share of texts of at most this length. Between two lengths the cut total grows by
    ``docs_at_least`` of the greater one for each further id, so any limit can be answered.

    The sums are taken over buckets of lengths and then inside each bucket, so no task sees more
    than the buckets or one bucket's lengths. An empty histogram gives an empty table.
    """
    bucket = F.floor(F.col("length") / BUCKET)
    rows = histogram.withColumn("bucket", bucket).withColumn("n_ids", F.col("length") * F.col("n_docs"))
    sums = rows.groupBy("bucket").agg(F.sum("n_docs").alias("docs"), F.sum("n_ids").alias("ids"))
    later = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("bucket")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sums = sums.select(
        "bucket",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("ids").over(later), F.lit(0)).alias("ids_later"),
        F.sum("docs").over(every).alias("docs_total"),
        F.sum("ids").over(every).alias("tokens_total"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("length"))
    docs_from = F.sum("n_docs").over(inside) + F.col("docs_later")
    ids_from = F.sum("n_ids").over(inside) + F.col("ids_later")
    out = rows.join(sums, "bucket").select(
        "length", "n_docs", docs_from.alias("docs_at_least"), ids_from.alias("tokens_at_least"),
        "docs_total", "tokens_total",
    )
    longer = F.col("docs_at_least") - F.col("n_docs")
    shorter_ids = F.col("tokens_total") - F.col("tokens_at_least")
    return out.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        longer.alias("docs_truncated"),
        (shorter_ids + F.col("length") * F.col("docs_at_least")).alias("tokens_truncated"),
        "tokens_total",
        ((F.col("docs_total") - longer) / F.col("docs_total")).alias("quantile"),
    )


def token_counts(
    docs: DataFrame, text_col: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """The context table of ``docs``; the histogram is written once and read twice."""
    return context_table(materialize(length_histogram(docs, text_col, tokenizer), "lengths"))


def truncated_total(contexts: DataFrame, limit: int) -> int:
    """Total ids if every text is cut after ``limit``, for any limit, from the context table."""
    above = contexts.where(F.col("length") >= limit).agg(F.max("docs_at_least")).first()[0] or 0
    below = contexts.where(F.col("length") < limit)
    return int(below.agg(F.sum(F.col("length") * F.col("n_docs"))).first()[0] or 0) + above * limit
