import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("wordloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """The hand-computable corpus and its frequency tables."""
    from wordloom.plans.models import train_counts

    rows = [(1, "a", "red fox red fox ran"), (2, "a", "red fox sat"), (3, "a", "red fox ran")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    return train_counts(docs, 4)
