"""Hand-off tables: what they leave on disk."""

from __future__ import annotations

import time

from wordloom.workspace import materialize, materialize_bucketed


def shuffle_files(spark) -> set[str]:
    """The shuffle files that this process holds, by name."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_a_written_table_keeps_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id", "id % 10 as k").repartition(4, "k")
    plain = materialize(rows, "plain", str(tmp_path))
    bucketed = materialize_bucketed(rows, "bucketed", ["k"], 4, str(tmp_path))
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    # The frames are still in use, so nothing here has been collected as garbage.
    assert not shuffle_files(spark) - before
    assert rows.count() == plain.count() == bucketed.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_bucketed_tables_are_written_with_zstd(spark, tmp_path):
    materialize_bucketed(spark.range(10).repartition(2, "id"), "bucketed", ["id"], 2, str(tmp_path))
    assert list(tmp_path.glob("bucketed-*/*.zstd.parquet"))
