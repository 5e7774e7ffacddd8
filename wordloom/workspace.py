"""Stage hand-off: tables written to the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# Most shuffle partitions of one stage, unless the setting below says otherwise: beyond some number
# bookkeeping costs more than the spill of larger partitions.
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_PARTITIONS_SETTING = "spark.wordloom.maxShufflePartitions"
UNKNOWN_BYTES = 1 << 60

# How hand-off tables, mostly of n-grams, are written: nearly all their strings differ, so a dictionary is built in vain, and sorted
# they share their beginnings, which the second version of Parquet's pages stores once.
TABLE_OPTIONS = {"compression": "zstd", "parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"}
# Files of buckets that one task keeps open; rows of further buckets are sorted by bucket first.
OPEN_FILES = 16

_local_folders: dict[str, str] = {}
# Folders of the runs that are open, the innermost last, by application.
_scratch: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    app = spark.sparkContext.applicationId
    if _scratch.get(app):
        return _scratch[app][-1]
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/wordloom/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="wordloom-")
    return _local_folders[app]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies; one that is not there is no error."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under ``path``."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = there.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().toString() for x in store.listStatus(there) if x.isDirectory()]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Hand-off tables that are made inside go when it ends, whether or not it fails.

    What is made inside must be written, or not needed, by then: a lazy result still reads them.
    """
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    _scratch.setdefault(app, []).append(folder)
    try:
        yield folder
    finally:
        _scratch[app].remove(folder)
        remove(spark, folder)


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a table and read it back.

    It cuts the lineage, survives lost executors, and gives Spark the true size of the table, so
    that its own broadcast threshold decides about later joins.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.options(**TABLE_OPTIONS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, folder: str | None = None, sort: Sequence[str] = ()
) -> DataFrame:
    """``materialize`` in buckets of ``keys``: joins, groups and ranks by these keys then move nothing.

    ``df`` should already be dealt out by the keys, over as many partitions, which makes one file a
    bucket.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    return write_bucketed(df, path, keys, buckets, sort)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` in buckets and read it back as a table that knows them.

    Only catalog tables can be bucketed; the entry is dropped again, the files are not its own. Rows are sorted
    by ``sort`` alone and then go to the open file of their bucket: the writer's own sort works out the bucket of
    two rows each time it compares them.
    """
    table = f"wordloom_{uuid.uuid4().hex}"
    rows = df.sortWithinPartitions(*sort) if sort else df
    writer = rows.write.format("parquet").options(**TABLE_OPTIONS).bucketBy(buckets, *keys)
    with shuffles_dropped(df.sparkSession), _setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
        writer.option("path", path).saveAsTable(table)
    return _taken(df.sparkSession, table)


@contextmanager
def _setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind, rather than until the driver collects garbage."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def read_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The table that ``write_bucketed`` left in ``path``, with its buckets, in any application."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    table = f"wordloom_{uuid.uuid4().hex}"
    by = ", ".join(f"`{key}`" for key in keys)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return _taken(spark, table)


def _taken(spark: SparkSession, table: str) -> DataFrame:
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of the files a plan reads, all columns counted.

    Spark's estimate for the plan as a whole multiplies the sides of a join; the sum over the
    tables is nearer to what a look-up join yields.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small input two partitions per core; leave a large one as it was scanned.

    One small Parquet file is one row group and so one task. A scan that already fills the
    cluster is returned untouched: the corpus text is never shuffled at scale.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) >= slots * TARGET_PARTITION_BYTES:
        return df
    return df.repartition(2 * slots, *keys)


def deal(df: DataFrame, nbytes: int, part: str) -> DataFrame:
    """``df`` dealt over tasks of about ``nbytes`` of its files, with the task's number as column ``part``.

    Groups that have ``part`` among their keys are then made without moving rows. Rows that are equal in
    all columns stay together, so one of the columns should be an id.
    """
    spark = df.sparkSession
    size = estimated_bytes(df)
    wanted = min(-(-size // nbytes), max_partitions(spark)) if size < UNKNOWN_BYTES else 0
    parts = max(2 * spark.sparkContext.defaultParallelism, wanted)
    number = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")
    return df.withColumn(part, number).repartitionById(parts, part)


def max_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_PARTITIONS_SETTING, str(MAX_SHUFFLE_PARTITIONS)))


@contextmanager
def shuffle_partitions(spark: SparkSession, shuffled_bytes: int) -> Iterator[None]:
    """Raise (never lower) the shuffle partition count so that a partition fits in memory.

    Spark reports a plan of unknown size as practically infinite; the count then stays as set.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    known = shuffled_bytes < UNKNOWN_BYTES
    most = max_partitions(spark)
    wanted = min(-(-shuffled_bytes // TARGET_PARTITION_BYTES), most) if known else 0
    spark.conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
