"""Text, CSV and Parquet sources and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from wordloom.workspace import estimated_bytes, materialize, shared_folder


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """UTF-8 text lines as ``(source, text)``; NULs are skipped, source is the file's stem."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths)
    return lines.select(
        F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("source"),
        F.translate("value", "\x00", "").alias("text"),
    )


# Lines that a file may have before its ids run into those of the next one.
LINES_PER_FILE = 1 << 40
# Blocks whose offsets are broadcast at once: a path and two numbers each, some 60 MB.
BLOCKS_PER_GROUP = 400_000


def read_corpus(spark: SparkSession, glob: str, folder: str | None = None) -> DataFrame:
    """All text files of a glob as ``(doc_id, source, text)``, one line a record.

    The id is made of the file's place among the sorted paths and the line's number in the file, so
    it depends neither on how Spark splits the files nor on the cluster. The lines are written once
    with the id of their row; rows of one block are consecutive, so a block's first row and the
    number of lines in the blocks before it give every line's number. Only these few numbers per
    block travel: they are broadcast, for BLOCKS_PER_GROUP blocks at a time, and the text is never
    shuffled. Files are dealt to as many groups as that takes, and a group's lines are read alone.
    """
    given = spark.read.text(glob)
    # Files are dealt to groups, each with few enough blocks for its offsets to be broadcast.
    groups = -(-block_estimate(given) // BLOCKS_PER_GROUP)
    lines = given.select(
        F.pmod(F.xxhash64("_metadata.file_path"), F.lit(groups)).cast("int").alias("group"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("source"),
        F.translate("value", "\x00", "").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    path = f"{folder or shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    lines.write.partitionBy("group").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    blocks = lines.groupBy("group", "path", "block").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    blocks = blocks.select("group", "path", "block", "first", before)
    # One row per file; the driver lists as many when it plans the scan.
    files = blocks.select("path").distinct()
    files = files.select("path", (F.row_number().over(Window.orderBy("path")) - 1).cast("bigint").alias("file"))
    places = materialize(blocks.join(files, "path"), "blocks", folder)
    # Of a row, only the shift from its row number to its id is needed.
    shift = F.col("file") * LINES_PER_FILE + F.col("before") - F.col("first")
    # One file may have more blocks than a group should; its offsets are joined as Spark sees fit.
    sizes = {x["group"]: x["count"] for x in places.groupBy("group").count().collect()}
    out = None
    for group in range(groups):
        own = places.where(F.col("group") == group).select("path", "block", shift.alias("shift"))
        own = F.broadcast(own) if sizes.get(group, 0) <= 2 * BLOCKS_PER_GROUP else own
        numbered = lines.where(F.col("group") == group).join(own, ["path", "block"])
        numbered = numbered.select((F.col("shift") + F.col("row")).alias("doc_id"), "source", "text")
        out = numbered if out is None else out.unionByName(numbered)
    return out


def block_estimate(df: DataFrame) -> int:
    """At most so many blocks the files of a scan are cut into: one per file, and one per split."""
    spark = df.sparkSession
    # Splits are as long as the setting, or shorter where the files do not fill the cores.
    longest = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    least = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    cores = spark.sparkContext.defaultParallelism
    nbytes, n_files = estimated_bytes(df), len(df.inputFiles())
    split = min(longest, max(least, -(-(nbytes + n_files * least) // cores)))
    return max(1, n_files + -(-nbytes // max(split, 1)))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet corpus as ``(doc_id, source, text)``; other columns are never scanned."""
    return spark.read.parquet(path).select("doc_id", "source", "text")


def read_word_list(spark: SparkSession, path: str, skip: int = 4, col: int = 1) -> DataFrame:
    """One column of a CSV file that has ``skip`` preamble lines before its header line.

    The row id directly above the scan of one file numbers its first lines from 0, whatever the
    number of splits, so preamble and header are the ids up to ``skip``.
    """
    fields = ", ".join(f"c{i} string" for i in range(col + 1))
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    rows = lines.where((F.col("line") > skip) & (F.trim("value") != ""))
    word = F.trim(F.from_csv("value", fields)[f"c{col}"])
    return rows.select(word.alias("word")).where(F.col("word") != "")


def read_ngrams(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    cols: Sequence[str] | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """A typed n-gram table, optionally only some of its columns."""
    reader = spark.read.schema(schema)
    table = reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)
    return table.select(*cols) if cols else table


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a stage's table; CSV gets a header and no row names."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)


def write_lines(df: DataFrame, path: str, col: str = "text", mode: str = "errorifexists") -> None:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
