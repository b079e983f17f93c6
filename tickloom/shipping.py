"""Makes the package importable in Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the workers, once for each application: functions in tasks refer to them by name."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tickloom"), "zip", root, "tickloom")
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
