"""Makes this package importable in the Python workers of executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source to Spark once per application; Spark brings it to every executor.

    The archive is made on the driver and sent by Spark's own file service, so no folder has to be
    shared and an executor that joins later gets it too.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="wordloom-source-"), "wordloom_source.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(os.path.join(ROOT, "wordloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, ROOT))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
